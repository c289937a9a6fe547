"""Site list readers: XML first, JSON as fallback."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitewarden.constants import CATEGORIES
from sitewarden.functions.scalars import clean, first_nonempty
from sitewarden.sources.documents import json_elements

_TEXT = (
    "id_number",
    "id",
    "site",
    "name",
    "category",
    "date_inscribed",
    "states",
    "state",
    "iso_code",
    "region",
    "criteria_txt",
    "criteria",
    "danger",
    "area_hectares",
    "short_description",
    "description",
    "latitude",
    "longitude",
)
_FLAT = T.StructType([T.StructField(c, T.StringType()) for c in _TEXT])
_POI = T.StructType([T.StructField("latitude", T.StringType()), T.StructField("longitude", T.StringType())])
_XML = T.StructType(
    [*_FLAT.fields, T.StructField("geolocations", T.StructType([T.StructField("poi", T.ArrayType(_POI))]))]
)


def _columns(lat: Column, lon: Column) -> list[Column]:
    """One rule set for both formats."""
    category = clean(F.col("category"))
    return [
        F.col("whc_id"),
        first_nonempty(F.col("site"), F.col("name")).alias("name"),
        F.when(category.isin(*CATEGORIES), category).alias("category"),
        F.trim("date_inscribed").try_cast("int").alias("date_inscribed"),
        first_nonempty(F.col("states"), F.col("state")).alias("country"),
        clean(F.col("iso_code")).alias("iso_code"),
        clean(F.col("region")).alias("region"),
        first_nonempty(F.col("criteria_txt"), F.col("criteria")).alias("criteria"),
        F.coalesce(F.trim("danger").isin("1", "true", "True", "TRUE"), F.lit(False)).alias("in_danger"),
        F.coalesce(F.trim("area_hectares").try_cast("double"), F.lit(0.0)).alias("area_hectares"),
        first_nonempty(F.col("short_description"), F.col("description")).alias("description"),
        lon.alias("lon"),
        lat.alias("lat"),
    ]


def _number(name: str) -> Column:
    return clean(F.col(name)).try_cast("double")


def _kept(df: DataFrame) -> DataFrame:
    return df.where(F.col("whc_id").isNotNull() & F.col("lon").isNotNull() & F.col("lat").isNotNull())


def read_sites_xml(spark: SparkSession, path: str) -> DataFrame:
    """One site per <row>; the first <poi> locates it, else the row's own coordinates."""
    rows = spark.read.format("xml").option("rowTag", "row").schema(_XML).load(path)
    poi = F.try_element_at(F.col("geolocations.poi"), F.lit(1))
    poi_lat, poi_lon = clean(poi.getField("latitude")), clean(poi.getField("longitude"))
    both = poi_lat.isNotNull() & poi_lon.isNotNull()
    lat = F.when(both, poi_lat).otherwise(clean(F.col("latitude"))).try_cast("double")
    lon = F.when(both, poi_lon).otherwise(clean(F.col("longitude"))).try_cast("double")
    return _kept(rows.withColumn("whc_id", F.trim("id_number").try_cast("int")).select(*_columns(lat, lon)))


def read_sites_json(spark: SparkSession, path: str, strict_reference: bool = False, multiline: bool = True) -> DataFrame:
    """JSON list of sites under the XML rules.

    `strict_reference=True` keeps the looser habits of the JSON feed: a zero coordinate drops the
    record, any non-empty danger text is true, categories pass unchecked and a bad year or area
    drops the record. A list is read by as many tasks as its size asks for; `multiline=False` reads one object per line.
    """
    if multiline:
        raw = json_elements(spark, path, level=1).select(F.from_json("text", _FLAT).alias("o")).select("o.*")
    else:
        raw = spark.read.schema(_FLAT).json(path)
    first_id = F.coalesce(F.nullif("id_number", F.lit("")), F.nullif("id", F.lit("")))
    keyed = raw.withColumn("whc_id", F.trim(first_id).try_cast("int"))
    lat, lon = _number("latitude"), _number("longitude")
    if not strict_reference:
        return _kept(keyed.select(*_columns(lat, lon)))
    danger = F.coalesce(~F.col("danger").isin("", "0", "false"), F.lit(False))
    year_ok = F.coalesce(F.nullif("date_inscribed", F.lit("")).isNull(), F.lit(True)) | F.trim(
        "date_inscribed"
    ).try_cast("int").isNotNull()
    area_ok = F.col("area_hectares").isNull() | F.trim("area_hectares").try_cast("double").isNotNull()
    zero = F.col("latitude").isin("0", "0.0") | F.col("longitude").isin("0", "0.0")
    loose = keyed.where(year_ok & area_ok & ~F.coalesce(zero, F.lit(True)))
    picked = loose.select(
        *_columns(lat, lon), F.col("category").alias("_category"), danger.alias("_danger")
    )
    return _kept(
        picked.withColumns({"category": F.col("_category"), "in_danger": F.col("_danger")}).drop(
            "_category", "_danger"
        )
    )


def read_sites(
    spark: SparkSession, xml: str | None = None, json: str | None = None, multiline: bool = True
) -> DataFrame:
    """The XML list, or the JSON list if the XML gives no site."""
    if xml is not None:
        sites = read_sites_xml(spark, xml)
        if json is None or not sites.isEmpty():
            return sites
    if json is None:
        raise ValueError("give an XML or a JSON path")
    return read_sites_json(spark, json, multiline=multiline)
