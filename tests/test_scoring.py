import math

import pytest
from pyspark.sql import functions as F

from sitewarden.constants import RISK_WEIGHTS, SCORE_COLUMNS
from sitewarden.functions import scalars as fn
from sitewarden.operators import exposure as ex
from sitewarden.operators.scaling import check_weights, composite, log_minmax, merge_scores

SCHEMA = "site_id bigint, " + ", ".join(f"{c} double" for c in SCORE_COLUMNS)


def test_weights():
    check_weights(RISK_WEIGHTS)
    check_weights({"a": 1.00001})
    with pytest.raises(ValueError):
        check_weights({"a": 1.00002})
    with pytest.raises(ValueError):
        check_weights({"a": 0.5, "b": 0.4})


def test_composite_and_levels(spark):
    rows = [(i, *[v] * 6) for i, v in enumerate((0.1, 0.3, 0.6, 0.9, 0.0, 1.0, 0.25, 0.5, 0.75))]
    rows.append((99, 0.4, None, 0.8, None, 0.2, 1.0))
    got = {r.site_id: r for r in composite(spark.createDataFrame(rows, SCHEMA), coverage=True).collect()}
    assert [got[i].risk_level for i in range(4)] == ["low", "medium", "high", "critical"]
    assert got[4].composite_risk_score == 0.0 and got[5].composite_risk_score == pytest.approx(1.0)
    assert got[99].composite_risk_score == pytest.approx(0.4 * 0.25 + 0.8 * 0.2 + 0.2 * 0.1 + 0.1)
    assert got[99].score_coverage == 4 and got[99].fire_risk_score == 0.0
    with pytest.raises(ValueError):
        composite(spark.createDataFrame([(1, 0.5)], "site_id bigint, fire_risk_score double"))


def test_level_bins_are_right_closed(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 0.25, 0.5, 0.75, 1.0, 1.01, -0.1)], "s double")
    assert [r[0] for r in df.select(fn.risk_level(F.col("s"))).collect()] == [
        "low", "low", "medium", "high", "critical", None, None,
    ]


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ([0.0, 9.0, 99.0], [0.0, 0.5, 1.0]),
        ([0.0, 0.0], [0.0, 0.0]),
        ([None, None], [0.0, 0.0]),
        ([5.0, 5.0], [0.0, 0.0]),
        ([0.0, None, 3.0], [0.0, None, 1.0]),
    ],
)
def test_log_minmax(spark, raw, want):
    df = spark.createDataFrame(list(enumerate(raw)), "i int, v double")
    got = [r.s for r in log_minmax(df, "v", "s").orderBy("i").collect()]
    assert got == [w if w is None else pytest.approx(w) for w in want]


def test_merge_scores_is_a_full_outer_merge(spark):
    a = spark.createDataFrame([(1, 0.1), (2, 0.2)], "site_id bigint, a double")
    b = spark.createDataFrame([(2, 0.5), (3, None)], "site_id bigint, b double")
    got = {r.site_id: (r.a, r.b) for r in merge_scores([a, b]).collect()}
    assert got == {1: (0.1, 0.0), 2: (0.2, 0.5), 3: (0.0, 0.0)}


def test_climate_row_with_one_measure_counts_as_extreme_only(spark, cities):
    days = [(1, 10.0 + i % 3, 1.0 + i % 2) for i in range(20)]
    rows = [*days, (1, None, 500.0), (2, 5.0, 5.0)]
    climate = spark.createDataFrame(rows, "site_id bigint, temp_max_c double, precipitation_mm double")
    got = {r.site_id: r for r in ex.climate_extremes(cities, climate).collect()}
    assert (got[1].extreme_days, got[1].total_days) == (1, 20) and got[1].anomaly_ratio == pytest.approx(0.05)
    assert (got[2].extreme_days, got[2].total_days) == (0, 1)
    assert got[3].anomaly_ratio == 0.0


def test_fire_without_power_counts_but_adds_nothing(spark, cities):
    fires = spark.createDataFrame(
        [(None, 80, 12.3155, 45.4408), (10.0, 50, 12.3155, 45.4408)], "frp double, confidence int, lon double, lat double"
    )
    venice = {r.site_id: r for r in ex.fire_exposure(cities, fires).collect()}[1]
    assert venice.fire_count == 2 and venice.total_fire_risk == pytest.approx(10 * 0.5 / 0.1)


def test_coastal(spark, cities):
    df = spark.createDataFrame([(None,), (-3.0,), (0.0,), (4.0,), (10.0,), (80.0,)], "e double")
    assert [r[0] for r in df.select(fn.coastal_score(F.col("e"))).collect()] == [0.0, 1.0, 1.0, 0.6, 0.0, 0.0]
    assert ex.coastal_scores(cities).first().is_coastal is False
    late = cities.withColumns({"elevation_m": F.lit(None).cast("double"), "coastal_risk_score": F.lit(1.7)})
    row = ex.coastal_scores(late).first()
    assert (row.elevation_m, row.is_coastal, row.coastal_risk_score) == (0.0, False, 1.0)


def test_confidence_and_clock(spark):
    df = spark.createDataFrame(
        [(None,), ("low",), ("Nominal",), ("HIGH",), ("77",), ("12.9",), ("?",)], "c string"
    )
    assert [r[0] for r in df.select(fn.normalize_confidence(F.col("c"))).collect()] == [0, 30, 50, 80, 77, 12, 50]
    clock = spark.createDataFrame([("5",), ("1330",), ("2400",), ("1275",), ("x",)], "t string")
    assert [r[0] for r in clock.select(fn.to_minutes(F.col("t"))).collect()] == [5, 810, None, None, None]
    assert math.isclose(sum(RISK_WEIGHTS.values()), 1.0)
