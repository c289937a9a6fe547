"""Map-feature reader."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewarden.constants import LANDUSE_VALUES
from sitewarden.functions.scalars import feature_info
from sitewarden.functions.shapes import from_geojson, from_wkt, project_shape, shape_area, shape_of_rings

_SCHEMA = (
    "osm_id bigint, osm_type string, site_id bigint, tags map<string,string>, "
    "rings array<array<struct<x:double,y:double>>>, geometry string"
)


def parse_osm(rows: DataFrame, all_tags: bool = False, fmt: str = "geojson") -> DataFrame:
    """Tagged shapes -> feature rows.

    A feature's place is its text `geometry` (GeoJSON or WKT, of one or several polygons, lines or points) or ready `rings`. `shape` keeps
    the polygons apart, for areas; `rings` lists the rings of all of them, for distances and tests of inside by the even-odd rule.
    Only buildings and the four landuse values are kept, as the feed asks for; `all_tags=True` keeps
    the rest as 'unknown'.
    """
    tags = F.col("tags")
    wanted = tags["building"].isNotNull() | tags["landuse"].isin(*LANDUSE_VALUES)
    kind, value = feature_info(tags)
    for name, dtype in (("rings", "array<array<struct<x:double,y:double>>>"), ("geometry", "string")):
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast(dtype))
    rows = rows.withColumn("shape", F.coalesce(_reader(fmt)(F.col("geometry")), shape_of_rings(F.col("rings"))))
    kept = rows if all_tags else rows.where(F.coalesce(wanted, F.lit(False)))
    return kept.select(
        "osm_id",
        F.coalesce("osm_type", F.lit("unknown")).alias("osm_type"),
        kind.alias("feature_type"),
        value.alias("feature_value"),
        tags["name"].alias("name"),
        F.col("site_id").alias("nearest_site_id"),
        F.lit(None).cast("double").alias("distance_to_site_m"),
        F.flatten(F.col("shape.polygons")).alias("rings"),
        "shape",
    )


def read_osm(spark: SparkSession, path: str, fmt: str = "json", all_tags: bool = False) -> DataFrame:
    """Feature extract in JSON lines or Parquet; `geometry` is a GeoJSON object or its text."""
    return parse_osm(spark.read.format(fmt).schema(_SCHEMA).load(path), all_tags)


def _reader(fmt: str):
    if fmt not in ("geojson", "wkt"):
        raise ValueError(f"unknown geometry format: {fmt}")
    return from_wkt if fmt == "wkt" else from_geojson


def with_shapes(rows: DataFrame, text: str = "geometry", fmt: str = "geojson", area_crs: int = 3035) -> DataFrame:
    """Replace the column `text`, WKT or GeoJSON, by `shape` and `area_m2` (0 for lines and points, null without a readable shape)."""
    shaped = rows.withColumn("shape", _reader(fmt)(F.col(text))).withColumn("_plane", project_shape(F.col("shape"), area_crs))
    return shaped.withColumn("area_m2", shape_area(F.col("_plane"))).drop("_plane", text)
