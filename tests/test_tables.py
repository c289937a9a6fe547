import datetime as dt
import json
import math
import random

import pytest
from pyspark.sql import functions as F

from sitewarden.functions.geodesy import WGS84_F, geodesic_m
from sitewarden import session
from sitewarden.operators import neardup
from sitewarden.operators import quality as ql
from sitewarden.operators import reports as rp
from sitewarden.operators.filters import filter_sites_by_iso, first_per_key
from sitewarden.operators.merge import merge_latest, update_matched
from sitewarden.operators.neardup import drop_near_duplicates
from sitewarden.session import new_path
from sitewarden.sources import climate as cl
from sitewarden.sources import hazards as hz
from sitewarden.sources import sinks
from sitewarden.sources import sites as st
from sitewarden.streaming.fires import daily_counts, start_fires

FIRES = "ord bigint, satellite string, acq_date date, acq_time int, lon double, lat double"


def metres(a, b):
    s = math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    t = math.sin(math.radians(b[0] - a[0]) / 2) ** 2
    h = s + math.cos(math.radians(a[1])) * math.cos(math.radians(b[1])) * t
    return 2 * 6371008.8 * math.asin(math.sqrt(h))


def test_near_duplicates_follow_arrival_order(spark):
    """Chains of detections and a third of all rows in one place, against the row-by-row rule."""
    rng = random.Random(2)
    day = dt.date(2024, 1, 1)
    rows = [(i, "A", day, 60, 10.0 + i * 0.0009, 0.0) for i in range(12)]
    rows += [(100 + i, "A", day, 60, 10.02 + rng.uniform(0, 0.004), rng.uniform(0, 0.004)) for i in range(150)]
    rows += [(400 + i, "B", day, 60, 20.0, 45.0) for i in range(100)]
    rows += [(600, "A", day, 61, 10.0, 0.0), (601, "A", day, 60, 179.9999, 89.9999), (602, "A", day, 60, -0.1, 89.9999)]
    rng.shuffle(rows)
    rows = [(i, *r[1:]) for i, r in enumerate(rows)]
    stored = [(9000, "B", day, 60, 20.0005, 45.0)]
    kept = []
    for r in rows:
        same = [k for k in kept + stored if k[1:4] == r[1:4]]
        if not any(metres(k[4:], r[4:]) <= 100 for k in same):
            kept.append(r)
    new, old = spark.createDataFrame(rows, FIRES), spark.createDataFrame(stored, FIRES)
    got = drop_near_duplicates(new, old, method="haversine").select("ord").collect()
    assert sorted(r.ord for r in got) == sorted(k[0] for k in kept)
    assert drop_near_duplicates(new.limit(0)).count() == 0
    # blocks of a few radii: chains cross many borders
    tiny = drop_near_duplicates(new, old, method="haversine", block_km=0.3).select("ord").collect()
    assert sorted(r.ord for r in tiny) == sorted(k[0] for k in kept)


def test_long_chains_take_few_rounds(spark, monkeypatch):
    """10,000 detections, each within reach of the one before: every second one stays, and the rounds are few."""
    day = dt.date(2024, 1, 1)
    rounds = []
    one_round = neardup._one_round
    monkeypatch.setattr(neardup, "_one_round", lambda *a: rounds.append(a[-1]) or one_round(*a))
    chain = [(i, "A", day, 60, -45.0 + i * 0.0007, 0.0) for i in range(10_000)]
    got = drop_near_duplicates(spark.createDataFrame(chain, FIRES)).select("ord").collect()
    assert sorted(r.ord for r in got) == list(range(0, 10_000, 2))
    assert len(rounds) < 10


def test_incomplete_detections_stay(spark):
    day = dt.date(2024, 1, 1)
    rows = [(1, None, day, 60, 1.0, 1.0), (2, None, day, 60, 1.0, 1.0), (3, "A", day, 60, None, 1.0), (4, "A", day, 60, 1.0, 1.0), (5, "A", day, 60, 1.0, 1.0), (6, "A", None, 60, 1.0, 1.0)]
    got = drop_near_duplicates(spark.createDataFrame(rows, FIRES)).select("ord").collect()
    assert sorted(r.ord for r in got) == [1, 2, 3, 4, 6]


@pytest.mark.parametrize("method", ["spheroid", "haversine"])
def test_distance_of_the_walk_is_that_of_the_columns(spark, method):
    rng = random.Random(4)
    pairs = [(la, lo, la + rng.uniform(-0.01, 0.01), lo + rng.uniform(-0.01, 0.01)) for la, lo in [(rng.uniform(-89, 89), rng.uniform(-180, 180)) for _ in range(50)]]
    frame = spark.createDataFrame([*pairs, (10.0, 20.0, 10.0, 20.0), (0.0, 179.9999, 0.0, -179.9999)], "a double, b double, c double, d double")
    rows = frame.select("*", geodesic_m(F.col("a"), F.col("b"), F.col("c"), F.col("d"), method).alias("m")).collect()
    block = neardup._Block(100.0, method)
    for r in rows:
        lat = [math.atan((1 - WGS84_F) * math.tan(math.radians(x))) if method == "spheroid" else math.radians(x) for x in (r.a, r.c)]
        assert block.metres(lat[0], math.radians(r.b), lat[1], math.radians(r.d)) == pytest.approx(r.m, abs=1e-6)


def test_merge_keeps_what_is_not_updated(spark):
    cur = spark.createDataFrame([(1, "a", 5, 1.0), (2, "b", 6, 2.0)], "k int, name string, link int, lon double")
    new = spark.createDataFrame([(2, "B1", 9.0, 1), (2, "B2", 9.5, 2), (3, "C", 7.0, 1)], "k int, name string, lon double, ord int")
    got = {r.k: (r.name, r.link, r.lon) for r in merge_latest(cur, new, ["k"], ["name"], order="ord").collect()}
    assert got == {1: ("a", 5, 1.0), 2: ("B2", 6, 2.0), 3: ("C", None, 7.0)}
    upd = spark.createDataFrame([(2, 8, "x"), (4, 9, "y")], "k int, link int, extra string")
    after = {r.k: (r.link, r.extra) for r in update_matched(cur, upd, ["k"], ["link", "extra"]).collect()}
    assert after == {1: (5, None), 2: (8, "x")}


def test_versions(spark, tmp_path):
    base = str(tmp_path / "t")
    assert sinks.read_current(spark, base) is None
    sinks.write_version(spark.range(3), base)
    sinks.write_version(spark.range(5), base)
    assert sinks.versions(spark, base) == [1, 2] and sinks.read_current(spark, base).count() == 5
    (tmp_path / "t" / "v=3").mkdir()  # a write that failed
    assert sinks.read_current(spark, base).count() == 5
    assert sinks.write_version(spark.range(7), base).endswith("v=4") and sinks.read_current(spark, base).count() == 7


def test_merge_rewrites_only_touched_partitions(spark, tmp_path):
    base = str(tmp_path / "climate")
    schema = "site_id bigint, event_date date, source string, temp_max_c double"
    day = dt.date(2024, 1, 1)
    first = spark.createDataFrame([(1, day, "open_meteo", 1.0), (2, day, "nasa_power", 2.0)], schema)
    sinks.merge_partitions(base, first, ["source"], sinks.upsert_climate)
    before = sorted(f.name for f in (tmp_path / "climate" / "source=nasa_power").glob("*.parquet"))
    second = spark.createDataFrame([(1, day, "open_meteo", 5.0), (3, day, "open_meteo", 3.0)], schema)
    sinks.merge_partitions(base, second, ["source"], sinks.upsert_climate)
    got = {(r.site_id, r.source): r.temp_max_c for r in spark.read.parquet(base).collect()}
    assert got == {(1, "open_meteo"): 5.0, (3, "open_meteo"): 3.0, (2, "nasa_power"): 2.0}
    assert before == sorted(f.name for f in (tmp_path / "climate" / "source=nasa_power").glob("*.parquet"))


def test_first_copy_claims_the_id_even_when_bad(spark):
    rows = [(1, 7, 95.0, 0.0, "Cultural"), (2, 7, 10.0, 0.0, "Cultural"), (3, 8, 10.0, 0.0, "Ruins")]
    df = spark.createDataFrame(rows, "ord int, whc_id int, lat double, lon double, category string")
    valid, offenders = ql.validate_sites(df)
    assert [r.whc_id for r in valid.collect()] == [8]
    assert {(r.issue, r.whc_id, r.records) for r in offenders.collect()} == {
        ("duplicate_whc_id", 7, 1), ("invalid_geometry", 7, 1), ("invalid_category", 8, 1),
    }
    report = ql.site_report(df).first()
    assert (report.total_records, report.valid_records, report.invalid_records) == (3, 1, 2)
    assert first_per_key(df, ["whc_id"], ["ord"]).count() == 2


def test_date_gaps(spark):
    d = dt.date
    rows = [(1, "s", d(2024, 1, 1)), (1, "s", d(2024, 1, 2)), (1, "s", d(2024, 1, 20)), (2, "s", d(2024, 1, 10))]
    df = spark.createDataFrame(rows, "site_id int, source string, event_date date")
    per = {r.site_id: r for r in ql.date_gap_report(df).collect()}
    assert (per[1].num_large_gaps, per[1].largest_gap_days) == (1, 18) and per[2].largest_gap_days == 0
    whole = ql.date_gap_report(df, ()).first()
    assert (whole.total_records, whole.num_large_gaps, whole.largest_gap_days) == (4, 2, 10)


def test_reports_on_odd_input(spark, cities):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "a double, b double")
    assert rp.correlation(df, ["a", "b"]).first().r is None
    assert rp.histogram(df, "b", 4).agg(F.sum("n")).first()[0] == 3
    bins = rp.histogram(df, "a", 4).collect()
    assert [r.n for r in bins] == [1, 0, 1, 1]
    empty = spark.createDataFrame([], "composite_risk_score double, risk_level string, is_anomaly boolean")
    assert list(rp.dashboard_stats(empty).first()) == [0, 0.0, 0, 0]
    assert [r.n for r in rp.value_counts(cities, "category", order=["Mixed", "Cultural"]).collect()] == [0, 5]
    assert {r.name for r in filter_sites_by_iso(cities, ["VA", "GB"]).collect()} == {"Rome", "London"}
    assert filter_sites_by_iso(cities, None).count() == 5


XML = """<query>
<row><id_number>1</id_number><site>A &amp; B</site><category>Cultural</category><date_inscribed>1980</date_inscribed>
<states>Italy</states><iso_code>IT,VA</iso_code><danger>1</danger><area_hectares>x</area_hectares>
<geolocations><poi><latitude>41.9</latitude><longitude>12.5</longitude></poi><poi><latitude>1</latitude><longitude>1</longitude></poi></geolocations></row>
<row><id_number>2</id_number><name>Second</name><category>Odd</category><latitude>0</latitude><longitude>0</longitude></row>
<row><id_number>3</id_number><site>No place</site></row>
<row><site>No id</site><latitude>1</latitude><longitude>2</longitude></row>
</query>"""


def test_sites_xml_and_json(spark, tmp_path):
    xml = tmp_path / "s.xml"
    xml.write_text(XML)
    got = {r.whc_id: r for r in st.read_sites_xml(spark, str(xml)).collect()}
    assert set(got) == {1, 2}
    assert (got[1].name, got[1].lat, got[1].lon, got[1].in_danger, got[1].area_hectares) == ("A & B", 41.9, 12.5, True, 0.0)
    assert got[2].name == "Second" and got[2].category is None and got[2].lat == 0.0
    data = tmp_path / "s.json"
    data.write_text(json.dumps([
        {"id_number": 1, "site": "Z", "latitude": 0, "longitude": 5, "danger": "x", "category": "Odd"},
        {"id": "2", "name": "Y", "latitude": "3", "longitude": "4", "date_inscribed": "soon"},
        {"id": "3", "name": "W", "latitude": "3", "longitude": "4", "danger": "yes", "category": "Odd"},
    ]))
    assert st.read_sites_json(spark, str(data)).count() == 3
    strict = st.read_sites_json(spark, str(data), strict_reference=True).collect()
    assert [(r.whc_id, r.in_danger, r.category) for r in strict] == [(3, True, "Odd")]
    empty = tmp_path / "e.xml"
    empty.write_text("<query><row><site>x</site></row></query>")
    assert st.read_sites(spark, str(empty), str(data)).count() == 3


def test_quake_collection(spark, tmp_path):
    def feature(i, coords, **props):
        return {"id": i, "properties": props, "geometry": {"coordinates": coords}}

    doc = {"features": [
        feature("a", [1.5, 2.5, 10.0], mag=5.1, time=1675645200000, place="X" * 400, tsunami=1),
        feature("b", [1.5, 2.5], mag=4, time=1675645200000, place=None),
        feature("c", [1.5, 2.5], mag=4, place="no time"),
        feature("d", [1.5, 2.5], time=1675645200000),
    ]}
    path = tmp_path / "q.json"
    path.write_text(json.dumps(doc))
    got = {r.usgs_id: r for r in hz.read_quakes(spark, str(path)).collect()}
    assert set(got) == {"a", "b"} and len(got["a"].place_desc) == 400 and got["a"].tsunami
    assert got["b"].depth_km is None and got["b"].place_desc is None and not got["b"].tsunami
    assert got["a"].event_time == dt.datetime(2023, 2, 6, 1, 0)


def test_fire_csv_of_both_sensors(spark, tmp_path):
    (tmp_path / "v").mkdir()
    (tmp_path / "m").mkdir()
    (tmp_path / "v" / "a.csv").write_text(
        "latitude,longitude,bright_ti4,acq_date,acq_time,confidence,frp,daynight\n"
        "1.0,2.0,330.5,2024-01-05,7,nominal,3.5,N\n1.0,2.0,330.5,bad,7,nominal,3.5,N\nx,2.0,1,2024-01-05,7,h,3,N\n"
    )
    (tmp_path / "m" / "a.csv").write_text(
        "latitude,longitude,brightness,acq_date,acq_time,confidence,frp\n1.0,2.0,300,2024-01-05,1330,85,\n"
    )
    v = hz.read_fires(spark, str(tmp_path / "v"), "VIIRS").collect()
    assert [(r.satellite, r.brightness, r.confidence, r.acq_time, r.day_night) for r in v] == [("VIIRS", 330.5, 50, 7, "N")]
    m = hz.read_fires(spark, str(tmp_path / "m"), "MODIS").first()
    assert (m.brightness, m.confidence, m.frp, m.acq_time, m.day_night) == (300.0, 85, None, 810, "D")


def test_climate_payloads(spark, tmp_path):
    meteo = tmp_path / "o.json"
    meteo.write_text("\n".join([
        json.dumps({"site_id": 1, "daily": {"time": ["2024-01-01", "2024-01-02"], "temperature_2m_max": [1.0, None]}}),
        json.dumps({"site_id": 2, "error": True, "reason": "x"}),
        json.dumps({"site_id": 3}),
    ]))
    rows = cl.read_open_meteo(spark, str(meteo)).orderBy("event_date").collect()
    assert [(r.site_id, r.temp_max_c, r.precipitation_mm) for r in rows] == [(1, 1.0, None), (1, None, None)]
    power = tmp_path / "p.json"
    power.write_text(json.dumps({
        "site_id": 1, "geometry": {"coordinates": [2.0, 1.0, 0.0]},
        "properties": {"parameter": {"T2M": {"20240101": 5.0, "20240102": "-999"}, "RH2M": {"20240102": 80, "20240103": 1}}},
    }))
    rows = cl.read_nasa_power(spark, str(power)).orderBy("event_date").collect()
    assert [(r.temp_mean_c, r.humidity_pct, r.lat) for r in rows] == [(5.0, None, 1.0), (None, 80.0, 1.0)]


def test_stream_drops_repeats_across_runs(spark, tmp_path):
    head = "latitude,longitude,bright_ti4,brightness,confidence,frp,acq_date,acq_time,daynight,satellite\n"
    row = "1.0,2.0,330.5,,nominal,3.5,2024-01-05,{t},N,S\n"
    landing = tmp_path / "landing"
    landing.mkdir()
    args = (spark, str(landing), str(tmp_path / "table"), str(tmp_path / "check"))
    (landing / "a.csv").write_text(head + row.format(t=7) * 3 + row.format(t=8))
    start_fires(*args).awaitTermination()
    (landing / "b.csv").write_text(head + row.format(t=8) + row.format(t=9))
    start_fires(*args).awaitTermination()
    got = daily_counts(spark.read.parquet(str(tmp_path / "table"))).collect()
    assert [(r.day_night, r.detections) for r in got] == [("N", 3)]


def test_versions_change_by_a_merge_and_old_ones_stay(spark):
    base = new_path(spark, "versions")
    with pytest.raises(ValueError):
        sinks.next_version(spark, base, lambda c: c)
    sinks.write_version(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), base)
    new = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    after = sinks.next_version(spark, base, lambda c: merge_latest(c, new, ["k"], ["v"]))
    assert {(r.k, r.v) for r in after.collect()} == {(1, "a"), (2, "B"), (3, "C")}
    assert sinks.versions(spark, base) == [1, 2]
    assert {(r.k, r.v) for r in spark.read.parquet(f"{base}/v=1").collect()} == {(1, "a"), (2, "b")}


@pytest.mark.parametrize("root, refused", [("/tmp/x", True), ("file:/tmp", True), ("file:///var/tmp/y", True), ("/tmpfolder", False), ("file:/mnt/shared", False)])
def test_temporary_folders_of_one_machine_are_told(spark, root, refused):
    assert session._of_one_machine(spark, root) is refused
