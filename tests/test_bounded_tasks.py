"""Memory of a task follows no file and no table."""

import csv
import json

from sitewarden.plans.fixtures import climate, urban_raw
from sitewarden.plans.queries_source import one_document
from sitewarden.session import by_key
from sitewarden.streaming.fires import _STEP_LINES, _by_first_line, start_fires


def test_a_document_is_a_stream_without_a_sort(spark):
    objects = spark.range(1000, numPartitions=7).selectExpr("to_json(struct(id, 'a, \"b\"' as t)) as value")
    document = one_document(objects, '{"head": [1], "features": [', "]}")
    assert "Sort" not in document._jdf.queryExecution().executedPlan().toString()
    found = json.loads(" ".join(r.value for r in document.collect()))
    assert found["features"][0] == {} and sorted(f["id"] for f in found["features"][1:]) == list(range(1000))


def test_fire_lines_are_read_a_few_at_a_time():
    drawn = []

    def lines():
        for i in range(30_000):
            drawn.append(i)
            yield "latitude, Frp" if i == 0 else "" if i < 9000 else f"{i},"

    found = []
    for batch in _by_first_line(csv.reader(lines())):
        found.append(batch.num_rows)
        assert len(drawn) <= _STEP_LINES * len(found) + 1
    assert sum(found) == 21_000 and max(found) <= _STEP_LINES


def test_a_streamed_file_is_one_task_s_whatever_its_size(spark, tmp_path):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    (tmp_path / "in").mkdir()
    first = [f"{i / 100:.2f},20.5,2024-05-01,905,N,D" for i in range(300)]
    second = [f'N,Aqua,1330,"2024-05-02",{-i / 100:.2f},-20' for i in range(200)]
    (tmp_path / "in" / "a.csv").write_text("\n".join(["latitude,longitude,acq_date,acq_time,satellite,daynight", *first, ""]))
    (tmp_path / "in" / "b.csv").write_bytes("\r\n".join(["daynight,satellite,acq_time,acq_date,latitude,longitude", *second]).encode())
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        start_fires(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted(r.lat for r in rows if r.satellite == "N") == [i / 100 for i in range(300)]
    assert sorted(-r.lat for r in rows if r.satellite == "Aqua" and r.lon == -20.0 and r.acq_time == 810) == [i / 100 for i in range(200)]


def test_climate_days_are_grouped_in_partitions_of_bounded_rows(spark, tmp_path):
    rows = spark.range(3000).selectExpr("id % 50 as l_suppkey", "id % 7 as l_linenumber", "date_add(date'2024-01-01', cast(id % 90 as int)) as l_shipdate", "id % 50 as l_quantity", "id as l_extendedprice")
    rows.write.parquet(str(tmp_path / "lineitem.parquet"))
    plan = climate(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert plan.rindex("HashAggregate") < plan.index("REPARTITION_BY_NUM")
    dealt = by_key(rows, ["l_suppkey", "l_shipdate"], 300)
    assert dealt.rdd.getNumPartitions() == 10 and dealt.count() == 3000
    assert by_key(rows.where("false"), ["l_suppkey"]).count() == 0


def test_features_are_dealt_over_tasks(spark, tmp_path):
    rows = spark.range(0, 120_001, numPartitions=1).selectExpr("id as c_custkey", "'BUILDING' as c_mktsegment", "'c' as c_name")
    rows.write.parquet(str(tmp_path / "customer.parquet"))
    assert urban_raw(spark, str(tmp_path)).rdd.getNumPartitions() == 3
