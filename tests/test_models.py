import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sitewarden.constants import SCORE_COLUMNS
from sitewarden.operators.density import gaussian_kde
from sitewarden.operators.filters import feature_matrix
from sitewarden.operators.isolation import attach_anomalies, isolation_forest
from sitewarden.operators.quantiles import quantiles, quantiles_by_rank, to_long

SCHEMA = "site_id bigint, " + ", ".join(f"{c} double" for c in SCORE_COLUMNS)


@pytest.fixture(scope="module")
def normal(spark):
    rng = np.random.default_rng(42)
    x = rng.normal(0.5, 0.1, (100, 6))
    x[0] = 0.95
    return spark.createDataFrame([(i, *map(float, row)) for i, row in enumerate(x)], SCHEMA).cache()


def test_forest_finds_the_outlier_and_repeats(normal):
    first = {r.site_id: r for r in isolation_forest(normal).collect()}
    again = {r.site_id: r for r in isolation_forest(normal.repartition(13)).collect()}
    assert first == again
    assert sum(r.is_anomaly for r in first.values()) == 10
    assert min(first.values(), key=lambda r: r.isolation_forest_score).site_id == 0
    flagged = [r.isolation_forest_score for r in first.values() if r.is_anomaly]
    others = [r.isolation_forest_score for r in first.values() if not r.is_anomaly]
    assert np.mean(flagged) < np.mean(others)


def test_contamination_sets_the_share(normal):
    counts = [isolation_forest(normal, trees=50, contamination=c).where("is_anomaly").count() for c in (0.05, 0.2)]
    assert counts == [5, 20]


def test_constant_input_flags_nothing(spark):
    same = spark.createDataFrame([(i, *[0.5] * 6) for i in range(50)], SCHEMA)
    rows = isolation_forest(same, trees=20).collect()
    assert not any(r.is_anomaly for r in rows) and {r.isolation_forest_score for r in rows} == {0.0}


def test_features_and_flags(spark, normal):
    bare = spark.createDataFrame([(1, None)], "site_id bigint, fire_risk_score double")
    assert list(feature_matrix(bare).select(*SCORE_COLUMNS).first()) == [0.0] * 6
    scores = normal.limit(3).withColumn("risk_level", F.lit("low"))
    forest = scores.select("site_id", F.lit(-0.1).alias("isolation_forest_score"), F.lit(True).alias("is_anomaly"))
    assert {r.risk_level for r in attach_anomalies(scores, forest).collect()} == {"low"}


def brute_kde(points, h):
    p = np.array(points)
    d2 = ((p[:, None, :] - p[None, :, :]) ** 2).sum(-1)
    return np.exp(-d2 / (2 * h * h)).sum(1) / (len(p) * 2 * math.pi * h * h)


@pytest.mark.parametrize("box_points", [144, 20])
def test_kde_equals_brute_force(spark, box_points):
    """With 20 points per box the crowded boxes are condensed; the sparse rest is exact."""
    rng = random.Random(5)
    points = [(rng.gauss(0, 900), rng.gauss(0, 700)) for _ in range(500)]
    points += [(rng.uniform(-20000, 20000), rng.uniform(-20000, 20000)) for _ in range(200)]
    points += points[:50]
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(points)], "id bigint, x double, y double")
    rows = gaussian_kde(df, 1000.0, box_points=box_points).orderBy("id").collect()
    assert len(rows) == len(points)
    want = brute_kde(points, 1000.0)
    assert max(abs(r.density_score / w - 1) for r, w in zip(rows, want, strict=True)) < 1e-9


@pytest.mark.parametrize("n", [1, 2, 7, 5000])
def test_quantiles_by_rank_are_exact(spark, n):
    rng = random.Random(n)
    rows = [(rng.choice([1.0, 2.0, rng.gauss(0, 1)]), rng.expovariate(1) ** 4) for _ in range(n)]
    df = spark.createDataFrame(rows, "a double, b double").repartition(5)
    probs = (0.0, 0.1, 0.25, 0.5, 0.75, 1.0)
    got = {r.name: r.q for r in quantiles_by_rank(to_long(df, ["a", "b"]), probs).collect()}
    near = {r.name: r.q for r in quantiles(df, ["a", "b"], probs).collect()}
    for i, c in enumerate("ab"):
        want = np.quantile([r[i] for r in rows], probs)
        assert got[c] == pytest.approx(want, rel=1e-12, abs=1e-12)
        assert near[c] == pytest.approx(want, rel=1e-12, abs=1e-12)
