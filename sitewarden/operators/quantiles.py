"""Exact quantiles (linear interpolation) at any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_BUCKETS = 200


def to_long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(name, value) rows of the non-NULL values."""
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in columns])
    return df.select(F.inline(pairs)).where(F.col("value").isNotNull())


def quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """(name, q) with q an array of the exact quantiles of each column, by one method at every size."""
    return quantiles_by_rank(to_long(df, columns), probs)


def quantiles_by_rank(long: DataFrame, probs: Sequence[float]) -> DataFrame:
    """Exact quantiles of (name, value) rows without holding a group in one task.

    Approximate cut points split the values into buckets; counts per bucket locate the bucket of
    each wanted rank; only the values of those buckets are shuffled, as distinct values with counts.
    """
    steps = F.array(*[F.lit(i / _BUCKETS) for i in range(1, _BUCKETS)])
    # one row per column of the report
    cuts = F.broadcast(
        long.groupBy("name").agg(
            F.array_distinct(F.percentile_approx("value", steps, F.lit(10_000))).alias("cuts")
        )
    )
    bucketed = long.join(cuts, "name").select(
        "name", "value", F.size(F.filter("cuts", lambda c: c < F.col("value"))).alias("bucket")
    )
    per_bucket = bucketed.groupBy("name", "bucket").agg(F.count(F.lit(1)).alias("n"))
    by_bucket = Window.partitionBy("name").orderBy("bucket")
    # at most _BUCKETS rows per name
    offsets = per_bucket.select(
        "name",
        "bucket",
        (F.sum("n").over(by_bucket) - F.col("n")).alias("before"),
        F.sum("n").over(by_bucket).alias("upto"),
        F.sum("n").over(Window.partitionBy("name")).alias("total"),
    )
    wanted = F.array(
        *[
            F.struct(
                F.lit(i).alias("i"),
                F.floor(F.lit(float(p)) * (F.col("total") - 1)).alias("rank"),
                (F.lit(float(p)) * (F.col("total") - 1)).alias("pos"),
            )
            for i, p in enumerate(probs)
        ]
    )
    targets = (
        offsets.select("name", "bucket", "before", "upto", F.inline(wanted))
        .withColumn("rank", F.explode(F.array("rank", F.col("rank") + 1)))
        .where((F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("upto")))
        .select("name", "bucket", "before", "i", "rank", "pos")
    )
    chosen = targets.select("name", "bucket", "before").distinct()
    in_bucket = Window.partitionBy("name", "bucket").orderBy("value")
    ranked = (
        bucketed.join(F.broadcast(chosen), ["name", "bucket"])
        .groupBy("name", "bucket", "before", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("last", F.col("before") + F.sum("n").over(in_bucket) - 1)
        .withColumn("first", F.col("last") - F.col("n") + 1)
        .drop("before", "n")
    )
    hits = ranked.join(F.broadcast(targets.drop("before")), ["name", "bucket"]).where(
        (F.col("rank") >= F.col("first")) & (F.col("rank") <= F.col("last"))
    )
    low, high = F.min_by("value", "rank"), F.max_by("value", "rank")
    per_prob = hits.groupBy("name", "i").agg(
        (low + (high - low) * (F.max("pos") - F.floor(F.max("pos")))).alias("v")
    )
    # one entry per probability
    return per_prob.groupBy("name").agg(F.sort_array(F.collect_list(F.struct("i", "v"))).alias("s")).select(
        "name", F.transform("s", lambda s: s.getField("v")).alias("q")
    )
