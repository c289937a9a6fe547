"""Filters and small projections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewarden.constants import SCORE_COLUMNS
from sitewarden.session import scalar_of


def filter_quakes(
    df: DataFrame,
    bbox: tuple[float, float, float, float] = (-90.0, 90.0, -180.0, 180.0),
    min_magnitude: float = 3.0,
    start: str | None = None,
    end: str | None = None,
    ordered: bool = True,
) -> DataFrame:
    """Box (min_lat, max_lat, min_lon, max_lon), magnitude and time range, oldest first."""
    min_lat, max_lat, min_lon, max_lon = bbox
    kept = df.where(
        F.col("lat").between(min_lat, max_lat)
        & F.col("lon").between(min_lon, max_lon)
        & (F.col("magnitude") >= min_magnitude)
    )
    kind = df.schema["event_time"].dataType
    if start is not None:
        kept = kept.where(F.col("event_time") >= F.lit(start).cast(kind))
    if end is not None:
        kept = kept.where(F.col("event_time") <= F.lit(end).cast(kind))
    return kept.orderBy("event_time", "usgs_id") if ordered else kept


def last_n_days(df: DataFrame, n: int, date: str = "acq_date", max_days: int | None = None) -> DataFrame:
    """The last n days up to the newest date. Asking for more than `max_days`, where given, is an error."""
    if max_days is not None and n > max_days:
        raise ValueError(f"{n} days asked for, {max_days} at most")
    newest = scalar_of(df, F.max(date))
    return df.where(F.col(date) > F.date_sub(newest, n))


def filter_sites_by_iso(df: DataFrame, codes: Sequence[str] | None) -> DataFrame:
    """Sites that list any of the ISO codes; None keeps all."""
    if codes is None:
        return df
    wanted = F.array(*[F.lit(c) for c in codes])
    return df.where(F.arrays_overlap(F.split("iso_code", r",\s*"), wanted))


def filter_sites(
    df: DataFrame,
    levels: Sequence[str] = (),
    countries: Sequence[str] = (),
    categories: Sequence[str] = (),
    danger: bool = False,
    anomaly: bool = False,
) -> DataFrame:
    """Conjunction of the filters that are set."""
    for column, values in (("risk_level", levels), ("country", countries), ("category", categories)):
        if values:
            df = df.where(F.col(column).isin(list(values)))
    if danger:
        df = df.where("in_danger")
    if anomaly:
        df = df.where("is_anomaly")
    return df


def coalesce_scores(df: DataFrame) -> DataFrame:
    """Missing scores -> 0, flag -> false, level -> 'low'."""
    numbers = [*SCORE_COLUMNS, "composite_risk_score", "isolation_forest_score"]
    filled: dict[str, Column] = {c: F.coalesce(F.col(c), F.lit(0.0)) for c in numbers if c in df.columns}
    if "is_anomaly" in df.columns:
        filled["is_anomaly"] = F.coalesce(F.col("is_anomaly"), F.lit(False))
    if "risk_level" in df.columns:
        filled["risk_level"] = F.coalesce(F.col("risk_level"), F.lit("low"))
    return df.withColumns(filled)


def with_geometry(df: DataFrame, columns: Sequence[str] = ("lon", "lat")) -> DataFrame:
    """Rows that have every geometry column."""
    return df.dropna(subset=list(columns))


def feature_matrix(df: DataFrame) -> DataFrame:
    """The six sub-scores as model input; a missing column or value is 0."""
    for column in SCORE_COLUMNS:
        if column not in df.columns:
            df = df.withColumn(column, F.lit(0.0))
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0.0)) for c in SCORE_COLUMNS})


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row of each key in the given order.

    `min_by` combines map-side, so a key with many rows is never sorted in one task.
    `order` must rank the rows of a key without ties.
    """
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("_first")
    return (
        df.groupBy(*keys)
        .agg(first)
        .select(*[F.col(c) if c in keys else F.col(f"_first.{c}").alias(c) for c in df.columns])
    )


def sample_sites(df: DataFrame, n: int, key: str = "site_id") -> DataFrame:
    """The first n sites by key."""
    return df.orderBy(key).limit(n)


def top_n(df: DataFrame, column: str, n: int, columns: Sequence[str] | None = None, key: str = "site_id") -> DataFrame:
    """The n largest values of a column."""
    top = df.orderBy(F.desc_nulls_last(column), key).limit(n)
    return top.select(*columns) if columns else top


def top_risk(df: DataFrame, n: int, columns: Sequence[str] | None = None) -> DataFrame:
    """The n sites of highest composite score."""
    return top_n(df, "composite_risk_score", n, columns)


def top_anomalies(df: DataFrame, n: int, columns: Sequence[str] | None = None) -> DataFrame:
    """The n most anomalous flagged sites (lowest forest score)."""
    top = df.where("is_anomaly").orderBy("isolation_forest_score", "site_id").limit(n)
    return top.select(*columns) if columns else top


def union_all(*frames: DataFrame) -> DataFrame:
    """UNION ALL by name; columns a frame lacks are NULL."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out
