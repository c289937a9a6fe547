"""Scaling of raw metrics, the composite score and the merge of sub-scores."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewarden.constants import RISK_BINS, RISK_WEIGHTS, SCORE_COLUMNS
from sitewarden.functions.scalars import clip01, risk_level
from sitewarden.session import scalar_of


def log_minmax_all(df: DataFrame, columns: dict[str, str], keep: list[str] | None = None) -> DataFrame:
    """log1p + min-max of several raw columns at once; `columns` maps raw -> score column.

    The extremes of all columns come from one aggregate, used as a scalar sub-query. A column that
    is all NULL, has maximum 0 or is constant scores 0; a NULL among other values stays NULL.
    """
    bounds = scalar_of(
        df,
        F.struct(
            *[F.struct(F.min(raw).alias("lo"), F.max(raw).alias("hi")).alias(raw) for raw in columns]
        ),
    )

    def scaled(raw: str) -> Column:
        low, high = F.col(f"_bounds.{raw}.lo"), F.col(f"_bounds.{raw}.hi")
        span = F.log1p(high) - F.log1p(low)
        value = F.coalesce(F.try_divide(F.log1p(F.col(raw)) - F.log1p(low), span), F.lit(0.0))
        return F.when(high.isNull() | (high == 0), F.lit(0.0)).when(F.col(raw).isNotNull(), value)

    # named once: every mention of a sub-query would be planned again
    bounded = df.withColumn("_bounds", bounds)
    return bounded.select(*(keep or df.columns), *[scaled(raw).alias(score) for raw, score in columns.items()])


def log_minmax(df: DataFrame, raw: str, score: str) -> DataFrame:
    """Append `score` = min-max of log1p(raw)."""
    return log_minmax_all(df, {raw: score})


def check_weights(weights: dict[str, float]) -> None:
    """Weights must sum to 1 within 1.1e-5."""
    total = math.fsum(weights.values())
    if abs(total - 1.0) > 1.1e-5:
        raise ValueError(f"weights must sum to 1, got {total}")


def merge_scores(frames: list[DataFrame], key: str = "site_id") -> DataFrame:
    """Full outer merge of frames that hold one row per key; missing values become 0.

    Stacked and grouped once: one shuffle with map-side combine in place of a chain of outer joins.
    """
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    values = [c for c in stacked.columns if c != key]
    return stacked.groupBy(key).agg(*[F.coalesce(F.max(c), F.lit(0.0)).alias(c) for c in values])


def composite(
    df: DataFrame,
    weights: dict[str, float] = RISK_WEIGHTS,
    bins: tuple[float, ...] = RISK_BINS,
    coverage: bool = False,
) -> DataFrame:
    """Weighted mean of the six sub-scores and its level; NULL sub-scores count as 0.

    `coverage=True` adds how many sub-scores were present.
    """
    check_weights(weights)
    missing = [c for c in SCORE_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"missing score columns: {', '.join(missing)}")
    if coverage:
        present = reduce(lambda a, b: a + b, [F.col(c).isNotNull().cast("int") for c in SCORE_COLUMNS])
        df = df.withColumn("score_coverage", present)
    filled = df.withColumns({c: F.coalesce(F.col(c), F.lit(0.0)) for c in SCORE_COLUMNS})
    total = reduce(
        lambda a, b: a + b, [F.col(f"{name}_score") * weight for name, weight in weights.items()]
    )
    return filled.withColumn("composite_risk_score", clip01(total)).withColumn(
        "risk_level", risk_level(F.col("composite_risk_score"), bins)
    )
