"""Earthquake and fire feed readers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewarden.functions.scalars import from_epoch_ms, normalize_confidence, to_day, to_minutes
from sitewarden.operators.filters import first_per_key
from sitewarden.sources.documents import json_elements

_FEATURE = (
    "id string, properties struct<mag:double, magType:string, place:string, time:bigint, sig:int, mmi:double, "
    "alert:string, tsunami:int>, geometry struct<coordinates:array<double>>"
)


def read_quakes(spark: SparkSession, path: str | Sequence[str], lines: bool = False) -> DataFrame:
    """GeoJSON feature collections -> one row per quake.

    Features without id, time, magnitude or position are dropped; a missing place stays NULL.
    A collection is read by as many tasks as its size asks for. `lines=True` reads one feature per line.
    """
    paths = [path] if isinstance(path, str) else list(path)
    if lines:
        features = spark.read.schema(_FEATURE).json(paths)
    else:
        features = json_elements(spark, paths, level=2).select(F.from_json("text", _FEATURE).alias("f")).select("f.*")
    p, xyz = F.col("properties"), F.col("geometry.coordinates")
    quakes = features.select(
        F.col("id").alias("usgs_id"),
        p["mag"].alias("magnitude"),
        p["magType"].alias("mag_type"),
        F.try_element_at(xyz, F.lit(3)).alias("depth_km"),
        p["place"].alias("place_desc"),
        from_epoch_ms(p["time"]).alias("event_time"),
        p["sig"].alias("significance"),
        p["mmi"].alias("mmi"),
        p["alert"].alias("alert_level"),
        F.coalesce(p["tsunami"] == 1, F.lit(False)).alias("tsunami"),
        F.try_element_at(xyz, F.lit(1)).alias("lon"),
        F.try_element_at(xyz, F.lit(2)).alias("lat"),
    )
    return quakes.dropna(subset=["usgs_id", "magnitude", "event_time", "lon", "lat"])


def read_quakes_partitioned(spark: SparkSession, paths: Sequence[str], lines: bool = False) -> DataFrame:
    """Yearly pulls read as one table; an event in two pulls is kept once."""
    return first_per_key(read_quakes(spark, paths, lines), ["usgs_id"], ["event_time", "magnitude"])


FIRE_CSV_COLUMNS = (
    "latitude",
    "longitude",
    "bright_ti4",
    "brightness",
    "confidence",
    "frp",
    "acq_date",
    "acq_time",
    "daynight",
    "satellite",
)


def parse_fires(rows: DataFrame, source: str | None = None) -> DataFrame:
    """Text rows of a fire CSV -> typed detections; works on batch and streaming frames.

    Rows whose date, time or position cannot be read are dropped. `source` names the satellite feed;
    without it the satellite column is used.
    """

    def text(name: str):
        return F.col(name) if name in rows.columns else F.lit(None).cast("string")

    satellite = F.lit(source) if source is not None else text("satellite")
    brightness = text("bright_ti4") if "bright_ti4" in rows.columns else text("brightness")
    if {"bright_ti4", "brightness"} <= set(rows.columns):
        brightness = F.coalesce(text("bright_ti4"), text("brightness"))
    carried = [c for c in rows.columns if c not in FIRE_CSV_COLUMNS]
    return rows.select(
        *carried,
        satellite.alias("satellite"),
        brightness.try_cast("double").alias("brightness"),
        normalize_confidence(text("confidence")).alias("confidence"),
        text("frp").try_cast("double").alias("frp"),
        to_day(F.trim(text("acq_date"))).alias("acq_date"),
        to_minutes(text("acq_time")).alias("acq_time"),
        F.substring(F.coalesce(text("daynight"), F.lit("D")), 1, 1).alias("day_night"),
        text("longitude").try_cast("double").alias("lon"),
        text("latitude").try_cast("double").alias("lat"),
    ).dropna(subset=["acq_date", "acq_time", "lon", "lat"])


_HEADER_LINE = r'(?i)(^|,)\s*"?latitude"?\s*(,|$)'
MAX_HEADERS = 1000


def read_fires(spark: SparkSession, path: str, source: str | None = None) -> DataFrame:
    """Fire detections from CSV files; every file is read by its own header line.

    Files of one folder may differ in columns and their order. Each distinct header is one pass over the lines.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    headers = lines.where(F.col("value").rlike(_HEADER_LINE)).groupBy("file").agg(F.min("value").alias("header"))
    kinds = [r.header for r in headers.select("header").distinct().limit(MAX_HEADERS + 1).collect()]
    if len(kinds) > MAX_HEADERS:
        raise ValueError(f"more than {MAX_HEADERS} different headers in {path}")
    owned = lines.join(headers, "file").where("value <> header")
    parts = [parse_fires(owned.where(F.col("header") == kind).select(*by_header(kind)), source) for kind in sorted(kinds)]
    if not parts:
        empty = spark.createDataFrame([], ", ".join(f"{c} string" for c in FIRE_CSV_COLUMNS))
        return parse_fires(empty, source)
    return reduce(DataFrame.unionByName, parts)


def by_header(header: str) -> list[Column]:
    """The known columns of a CSV line (column value) under a header line."""
    names = [name.strip().strip('"').lower() for name in header.split(",")]
    schema = ", ".join(f"_{i} string" for i in range(len(names)))
    row = F.from_csv("value", F.lit(schema), {"mode": "PERMISSIVE"})
    places = {name: i for i, name in reversed(list(enumerate(names)))}
    return [row[f"_{places[c]}"].alias(c) if c in places else F.lit(None).cast("string").alias(c) for c in FIRE_CSV_COLUMNS]
