"""Table writers: merges into a new version, appends and map layers."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewarden.constants import SCORE_COLUMNS
from sitewarden.operators.merge import merge_latest, update_matched
from sitewarden.operators.neardup import drop_near_duplicates
from sitewarden.session import stage

_MEASURES = [
    "temp_max_c",
    "temp_min_c",
    "temp_mean_c",
    "precipitation_mm",
    "wind_max_ms",
    "wind_gust_ms",
    "solar_radiation_kwh",
    "humidity_pct",
]
_QUAKE_FIELDS = [
    "magnitude",
    "mag_type",
    "depth_km",
    "place_desc",
    "event_time",
    "significance",
    "mmi",
    "alert_level",
    "tsunami",
]


def _filesystem(spark: SparkSession, path: str):
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, where.getFileSystem(spark._jsc.hadoopConfiguration())


def versions(spark: SparkSession, base: str) -> list[int]:
    """Complete versions (v=N with a success marker) under a table folder."""
    jvm, fs = _filesystem(spark, base)
    root = jvm.org.apache.hadoop.fs.Path(base)
    if not fs.exists(root):
        return []
    found = []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if name.startswith("v=") and fs.exists(jvm.org.apache.hadoop.fs.Path(f"{base}/{name}/_SUCCESS")):
            found.append(int(name[2:]))
    return sorted(found)


def read_current(spark: SparkSession, base: str) -> DataFrame | None:
    """The newest complete version, None if there is none."""
    found = versions(spark, base)
    return spark.read.parquet(f"{base}/v={found[-1]}") if found else None


def _last_number(spark: SparkSession, base: str) -> int:
    """The highest version number in use, complete or not; 0 without any."""
    jvm, fs = _filesystem(spark, base)
    root = jvm.org.apache.hadoop.fs.Path(base)
    names = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
    return max((int(n[2:]) for n in names if n.startswith("v=")), default=0)


def write_version(df: DataFrame, base: str, partition_by: list[str] | None = None) -> str:
    """Write the table as the next version. Readers switch when its success marker appears.

    A number that another writer has taken meanwhile is an error; remains of a failed write are passed over.
    """
    path = f"{base}/v={_last_number(df.sparkSession, base) + 1}"
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def next_version(spark: SparkSession, base: str, change: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Apply `change` to the newest version, write the result as the next one and return that, read back."""
    current = read_current(spark, base)
    if current is None:
        raise ValueError(f"{base} has no complete version")
    write_version(change(current), base)
    return read_current(spark, base)


def merge_partitions(
    base: str, new: DataFrame, partition_by: Sequence[str], merge: Callable[[DataFrame, DataFrame], DataFrame]
) -> None:
    """Merge `new` into a partitioned table in place, rewriting only the partitions it touches.

    The touched partition values are joined, not listed on the driver; Spark prunes the scan by them at run time.
    The merged rows are written to the work folder first, then replace the partitions.
    """
    spark = new.sparkSession
    jvm, fs = _filesystem(spark, base)
    merged = new
    if fs.exists(jvm.org.apache.hadoop.fs.Path(base)):
        current = spark.read.parquet(base)
        touched = new.select(*[F.col(c).alias(f"_t_{c}") for c in partition_by]).distinct()
        same = [F.col(c).eqNullSafe(F.col(f"_t_{c}")) for c in partition_by]
        merged = stage(merge(current.join(touched, same, "left_semi"), new), "merged")
    merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(base)


def upsert_sites(current: DataFrame, new: DataFrame, order: str | None = None) -> DataFrame:
    """Upsert on whc_id; every field but the id is overwritten and updated_at set."""
    updates = [c for c in current.columns if c not in ("site_id", "whc_id", "created_at", "updated_at")]
    defaults = {"updated_at": F.current_timestamp()} if "updated_at" in current.columns else None
    created = {"created_at": F.current_timestamp()} if "created_at" in current.columns else None
    return merge_latest(current, new, ["whc_id"], updates, order, defaults, created)


def upsert_climate(current: DataFrame, new: DataFrame, order: str | None = None) -> DataFrame:
    """Upsert on (site_id, event_date, source): the eight measures; the position is kept."""
    measures = [c for c in _MEASURES if c in current.columns]
    return merge_latest(current, new, ["site_id", "event_date", "source"], measures, order)


def upsert_quakes(current: DataFrame, new: DataFrame, order: str | None = None) -> DataFrame:
    """Upsert on usgs_id: nine fields; position and site link are kept."""
    fields = [c for c in _QUAKE_FIELDS if c in current.columns]
    return merge_latest(current, new, ["usgs_id"], fields, order)


def insert_fires(current: DataFrame, new: DataFrame, order: str = "ord", method: str = "spheroid") -> DataFrame:
    """Append the detections that have no near duplicate."""
    kept = drop_near_duplicates(new, current, order=order, method=method)
    return current.unionByName(kept.select(*[c for c in kept.columns if c in current.columns]), allowMissingColumns=True)


def upsert_floods(current: DataFrame, new: DataFrame, order: str | None = None) -> DataFrame:
    """Upsert on (nearest_site_id, event_date) of positive intensities; new rows get distance 0."""
    wet = new.where(F.col("flood_intensity") > 0)
    distance = {"distance_to_site_km": F.lit(0.0)} if "distance_to_site_km" in current.columns else None
    return merge_latest(
        current,
        wet,
        ["nearest_site_id", "event_date"],
        ["flood_intensity", "lon", "lat"],
        order,
        insert_only=distance,
    )


def append_urban(new: DataFrame, path: str) -> None:
    """Append features; the area column is not stored. Runs repeated on one input repeat the rows."""
    new.drop("area_m2").write.mode("append").parquet(path)


def dedupe_urban(urban: DataFrame) -> DataFrame:
    """One row per (osm_type, osm_id, site) of a table that was appended to repeatedly."""
    keys = ["osm_type", "osm_id", "nearest_site_id"]
    rest = [c for c in urban.columns if c not in keys]
    picked = urban.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in urban.columns])


def upsert_scores(current: DataFrame, new: DataFrame, order: str | None = None) -> DataFrame:
    """Upsert on site_id: scores and level; the anomaly columns are left alone, a NULL level is 'low'."""
    filled = new.withColumn("risk_level", F.coalesce("risk_level", F.lit("low")))
    return merge_latest(
        current, filled, ["site_id"], [*SCORE_COLUMNS, "composite_risk_score", "risk_level"], order
    )


__all__ = [
    "append_urban",
    "dedupe_urban",
    "insert_fires",
    "merge_partitions",
    "next_version",
    "read_current",
    "update_matched",
    "upsert_climate",
    "upsert_floods",
    "upsert_quakes",
    "upsert_scores",
    "upsert_sites",
    "versions",
    "write_version",
]
