"""Report aggregates over sites and scores."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewarden.constants import RISK_LEVELS, SCORE_COLUMNS
from sitewarden.operators.filters import coalesce_scores
from sitewarden.operators.quantiles import quantiles, to_long
from sitewarden.session import resolve_strategy, scalar_of


def site_risk_view(sites: DataFrame, scores: DataFrame, how: str = "left", ordered: bool = True) -> DataFrame:
    """Sites with their scores: 'left' fills defaults by site, 'inner' orders by score, highest first."""
    joined = sites.drop("coastal_risk_score").join(scores, "site_id", how)
    if how == "left":
        joined = coalesce_scores(joined)
        return joined.orderBy("site_id") if ordered else joined
    return joined.orderBy(F.desc("composite_risk_score"), "site_id") if ordered else joined


def anomalies_report(sites: DataFrame, scores: DataFrame) -> DataFrame:
    """Flagged sites, highest composite first."""
    return (
        scores.where("is_anomaly")
        .join(sites.select("site_id", "name", "country"), "site_id")
        .select("site_id", "name", "country", "composite_risk_score", "risk_level", "is_anomaly")
        .orderBy(F.desc("composite_risk_score"), "site_id")
    )


def table_counts(tables: dict[str, DataFrame], links: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """(table, rows, linked, avg_distance); `links` names the link and distance columns of a table."""
    parts = []
    for name, df in tables.items():
        link, distance = (links or {}).get(name, (None, None))
        parts.append(
            df.agg(
                F.count(F.lit(1)).alias("rows"),
                (F.count(link) if link else F.lit(None).cast("long")).alias("linked"),
                (F.avg(distance) if distance else F.lit(None).cast("double")).alias("avg_distance"),
            ).select(F.lit(name).alias("table"), "rows", "linked", "avg_distance")
        )
    return reduce(lambda a, b: a.unionByName(b), parts)


def value_counts(
    df: DataFrame,
    column: str,
    n: int | None = None,
    order: Sequence[str] | None = None,
    share: bool = False,
) -> DataFrame:
    """Frequency of each value; `order` fixes the values (zero-filled), `n` keeps the most frequent."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    if order is not None:
        levels = df.sparkSession.createDataFrame(
            [(i, v) for i, v in enumerate(order)], f"position int, {column} string"
        )
        counts = (
            F.broadcast(levels)
            .join(counts, column, "left")
            .select("position", column, F.coalesce("n", F.lit(0)).alias("n"))
            .orderBy("position")
            .drop("position")
        )
    if share:
        total = scalar_of(df, F.count(F.lit(1)))
        counts = counts.withColumn("share_pct", F.round(F.col("n") * 100.0 / total, 1))
    if order is None:
        counts = counts.orderBy(F.desc("n"), column)
    return counts.limit(n) if n is not None else counts


def site_summary(sites: DataFrame) -> DataFrame:
    return sites.agg(
        F.count(F.lit(1)).alias("total_sites"),
        F.countDistinct("country").alias("countries"),
        F.count_if("in_danger").alias("in_danger"),
        F.min("date_inscribed").alias("first_year"),
        F.max("date_inscribed").alias("last_year"),
    )


def sites_by_year(sites: DataFrame) -> DataFrame:
    return (
        sites.where(F.col("date_inscribed").isNotNull())
        .groupBy("date_inscribed")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy("date_inscribed")
    )


def total_bounds(df: DataFrame) -> DataFrame:
    return df.agg(
        F.min("lon").alias("min_lon"),
        F.min("lat").alias("min_lat"),
        F.max("lon").alias("max_lon"),
        F.max("lat").alias("max_lat"),
    )


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std, min, quartiles and max of each column."""
    basic = (
        to_long(df, columns)
        .groupBy("name")
        .agg(
            F.count("value").alias("n"),
            F.avg("value").alias("mean"),
            F.stddev_samp("value").alias("std"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
        )
    )
    # one row per described column
    q = F.broadcast(quantiles(df, columns, (0.25, 0.5, 0.75)))
    return basic.join(q, "name").select(
        "name",
        "n",
        "mean",
        "std",
        "min",
        F.col("q")[0].alias("q25"),
        F.col("q")[1].alias("q50"),
        F.col("q")[2].alias("q75"),
        "max",
    )


def missing_profile(df: DataFrame) -> DataFrame:
    """(column, missing, missing_pct) of the columns that have NULLs, most first."""
    names = [c for c in df.columns]
    counts = df.agg(F.count(F.lit(1)).alias("_total"), *[F.count_if(F.col(c).isNull()).alias(c) for c in names])
    return (
        counts.unpivot(["_total"], names, "column", "missing")
        .where(F.col("missing") > 0)
        .select("column", "missing", (F.col("missing") * 100.0 / F.col("_total")).alias("missing_pct"))
        .orderBy(F.desc("missing"), "column")
    )


def correlation(df: DataFrame, columns: Sequence[str] = SCORE_COLUMNS, min_abs: float | None = None) -> DataFrame:
    """Pearson r of each pair in long form; NULL for a constant column. `min_abs` keeps |r| above it."""
    pairs = list(combinations(columns, 2))

    def r(a: str, b: str):
        return F.try_divide(F.covar_samp(a, b), F.stddev_samp(a) * F.stddev_samp(b))

    row = df.agg(*[r(a, b).alias(f"{a}|{b}") for a, b in pairs])
    out = row.unpivot([], [f"{a}|{b}" for a, b in pairs], "pair", "r").select(
        F.split_part("pair", F.lit("|"), F.lit(1)).alias("col_a"),
        F.split_part("pair", F.lit("|"), F.lit(2)).alias("col_b"),
        "r",
    )
    return out.where(F.abs("r") > min_abs) if min_abs is not None else out


def crosstab(df: DataFrame, row: str, column: str, values: Sequence[str] = RISK_LEVELS) -> DataFrame:
    """Counts of row x column value; the values are fixed, so no pass looks for them."""
    return df.groupBy(row).agg(*[F.count_if(F.col(column) == v).alias(v) for v in values]).orderBy(row)


def group_mean(df: DataFrame, by: str, value: str = "composite_risk_score") -> DataFrame:
    return df.groupBy(by).agg(F.avg(value).alias(f"mean_{value}"))


def country_risk(df: DataFrame, min_sites: int = 3, digits: int | None = 3, n: int | None = 15) -> DataFrame:
    """Mean composite and site count per country with enough sites, highest first."""
    mean = F.avg("composite_risk_score")
    out = (
        df.groupBy("country")
        .agg(
            (F.round(mean, digits) if digits is not None else mean).alias("avg_risk"),
            F.count(F.lit(1)).alias("site_count"),
        )
        .where(F.col("site_count") >= min_sites)
        .orderBy(F.desc("avg_risk"), "country")
    )
    return out.limit(n) if n is not None else out


def dashboard_stats(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total_sites"),
        F.coalesce(F.avg("composite_risk_score"), F.lit(0.0)).alias("avg_risk"),
        F.count_if(F.col("risk_level").isin("high", "critical")).alias("high_risk"),
        F.count_if(F.coalesce("is_anomaly", F.lit(False))).alias("anomalies"),
    )


def factor_means(df: DataFrame, columns: Sequence[str] = SCORE_COLUMNS) -> DataFrame:
    """(factor, mean) of each sub-score."""
    return df.agg(*[F.avg(c).alias(c) for c in columns]).unpivot([], list(columns), "factor", "mean_score")


def factors_long(df: DataFrame, n: int = 5, columns: Sequence[str] = SCORE_COLUMNS) -> DataFrame:
    """The sub-scores of the n highest sites in long form."""
    top = df.orderBy(F.desc("composite_risk_score"), "site_id").limit(n)
    return top.select("site_id", "name", *columns).unpivot(
        ["site_id", "name"], list(columns), "factor", "score"
    )


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """(bin, low, high, n) of equal-width bins over the value range; the last bin is closed, empty bins stay."""
    value = F.col(column).cast("double")
    bounds = scalar_of(df, F.struct(F.min(value).alias("lo"), F.max(value).alias("hi")))
    # a constant column gets a range of one, as numpy does
    ranged = df.select(value.alias("v")).where(F.col("v").isNotNull()).withColumn("_b", bounds)
    lo = F.when(F.col("_b.lo") == F.col("_b.hi"), F.col("_b.lo") - 0.5).otherwise(F.col("_b.lo"))
    hi = F.when(F.col("_b.lo") == F.col("_b.hi"), F.col("_b.hi") + 0.5).otherwise(F.col("_b.hi"))
    placed = ranged.select("v", lo.alias("lo"), hi.alias("hi")).select(
        F.least(F.floor((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins), F.lit(bins - 1))
        .cast("int")
        .alias("bin")
    )
    counts = placed.groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    frame = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin")).withColumn("_b", bounds)
    frame = frame.select("bin", lo.alias("lo"), ((hi - lo) / bins).alias("width"))
    return (
        F.broadcast(frame)
        .join(counts, "bin", "left")
        .select(
            "bin",
            (F.col("lo") + F.col("bin") * F.col("width")).alias("low"),
            (F.col("lo") + (F.col("bin") + 1) * F.col("width")).alias("high"),
            F.coalesce("n", F.lit(0)).alias("n"),
        )
        .orderBy("bin")
    )


def histogram_stats(df: DataFrame, column: str) -> DataFrame:
    """Mean and median drawn over the histogram."""
    median = quantiles(df, [column], (0.5,)).select(F.col("q")[0].alias("median"))
    mean = scalar_of(df, F.avg(column))
    return median.select(mean.alias("mean"), "median")


def box_stats(df: DataFrame, columns: Sequence[str] = SCORE_COLUMNS) -> DataFrame:
    """Quartiles, whisker ends and outlier count (1.5 IQR) of each column."""
    # one row per column
    q = F.broadcast(
        quantiles(df, columns, (0.25, 0.5, 0.75)).select(
            "name", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3")
        )
    )
    fence = 1.5 * (F.col("q3") - F.col("q1"))
    value = F.col("value")
    inside = value.between(F.col("q1") - fence, F.col("q3") + fence)
    return (
        to_long(df, columns)
        .join(q, "name")
        .groupBy("name", "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, value)).alias("whisker_low"),
            F.max(F.when(inside, value)).alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
        )
    )


def anomaly_stats(df: DataFrame) -> DataFrame:
    flagged = F.count_if(F.coalesce("is_anomaly", F.lit(False)))
    total = F.count(F.lit(1))
    return df.agg(
        total.alias("total_sites"),
        flagged.alias("anomalies"),
        F.coalesce(F.try_divide(flagged * 100.0, total), F.lit(0.0)).alias("anomaly_pct"),
        (total - flagged).alias("normal"),
        F.coalesce(F.try_divide((total - flagged) * 100.0, total), F.lit(0.0)).alias("normal_pct"),
    )


def urban_exposure(sites: DataFrame, urban: DataFrame, n: int = 10, strategy: str = "auto") -> DataFrame:
    """Feature count and summed distance per site name, most exposed first."""
    strategy = resolve_strategy(sites, strategy)
    per_site = urban.groupBy(F.col("nearest_site_id").alias("site_id")).agg(
        F.count("id").alias("urban_count"), F.sum("distance_to_site_m").alias("total_dist")
    )
    ids = sites.select("site_id")
    known = per_site.join(F.broadcast(ids) if strategy == "broadcast" else ids, "site_id", "left_semi")
    return (
        sites.select("site_id", "name")
        .join(F.broadcast(known) if strategy == "broadcast" else known, "site_id", "left")
        .groupBy("name")
        .agg(F.coalesce(F.sum("urban_count"), F.lit(0)).alias("urban_count"), F.sum("total_dist").alias("total_dist"))
        .orderBy(F.desc("urban_count"), "name")
        .limit(n)
    )
