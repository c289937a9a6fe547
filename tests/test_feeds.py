"""Feeds by header, whole texts, and repeated keys."""

import pytest

from sitewarden.operators.filters import filter_sites_by_iso, last_n_days
from sitewarden.operators.merge import merge_latest, update_matched
from sitewarden.sources.hazards import read_fires
from sitewarden.sources.sites import read_sites_json
from sitewarden.streaming.fires import named_lines

VIIRS = "latitude,longitude,bright_ti4,scan,track,acq_date,acq_time,satellite,instrument,confidence,version,bright_ti5,frp,daynight\n10.5,20.5,300.1,0.4,0.4,2024-05-01,905,N,VIIRS,n,2.0NRT,280,1.5,D\n"
MODIS = "daynight,frp,confidence,satellite,acq_time,acq_date,brightness,longitude,latitude\nN,2.5,77,Aqua,1330,2024-05-02,310.5,-20,-10\n"


def test_fire_files_of_one_folder_keep_their_own_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text(VIIRS)
    (tmp_path / "b.csv").write_text(MODIS)
    (tmp_path / "c.csv").write_text(MODIS.split("\n")[0] + "\n")
    rows = {r.satellite: r for r in read_fires(spark, str(tmp_path)).collect()}
    assert set(rows) == {"N", "Aqua"}
    assert (rows["N"].lat, rows["N"].lon, rows["N"].brightness, rows["N"].acq_time) == (10.5, 20.5, 300.1, 545)
    assert (rows["Aqua"].lat, rows["Aqua"].lon, rows["Aqua"].frp, rows["Aqua"].confidence) == (-10.0, -20.0, 2.5, 77)
    whole = spark.read.text(str(tmp_path), wholetext=True)
    assert {(r.latitude, r.frp, r.daynight) for r in named_lines(whole).collect()} == {("10.5", "1.5", "D"), ("-10", "2.5", "N")}


def test_long_code_lists_are_kept(spark, tmp_path):
    (tmp_path / "s.json").write_text('[{"id_number": "1", "site": "%s", "iso_code": "BY, EE, FI, LV, LT, MD, NO, RU, SE, UA", "latitude": "1", "longitude": "2"}]' % ("n" * 700))
    sites = read_sites_json(spark, str(tmp_path))
    row = filter_sites_by_iso(sites, ["UA"]).first()
    assert len(row.name) == 700


def test_days_window_has_no_hidden_limit(spark):
    days = spark.sql("select explode(sequence(date'2024-01-01', date'2024-01-31')) as acq_date")
    assert last_n_days(days, 15).count() == 15
    with pytest.raises(ValueError):
        last_n_days(days, 15, max_days=10)


def test_repeated_keys_need_an_order(spark):
    current = spark.createDataFrame([(1, "a")], "k int, v string")
    new = spark.createDataFrame([(1, "b", 1), (2, "c", 2), (2, "d", 3)], "k int, v string, o int")
    assert sorted(map(tuple, merge_latest(current, new, ["k"], order="o").collect())) == [(1, "b"), (2, "d")]
    with pytest.raises(Exception, match="repeated key"):
        merge_latest(current, new.drop("o"), ["k"]).collect()
    with pytest.raises(Exception, match="repeated key"):
        update_matched(current, new, ["k"], ["v"]).collect()
    assert merge_latest(current, new.drop("o").limit(1), ["k"]).count() == 1
