"""Schemas of the seven stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
RINGS = T.ArrayType(T.ArrayType(POINT))


_TYPES: dict[str, T.DataType] = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "rings": RINGS,
}


def _table(columns: str) -> T.StructType:
    """'name type, ...' -> schema; needs no running session."""
    pairs = [c.split() for c in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


SCHEMAS: dict[str, T.StructType] = {
    "sites": _table(
        "site_id bigint, whc_id int, name string, category string, date_inscribed int, country string, "
        "iso_code string, region string, criteria string, in_danger boolean, area_hectares double, "
        "description string, lon double, lat double, created_at timestamp, updated_at timestamp"
    ),
    "urban_features": _table(
        "id bigint, osm_id bigint, osm_type string, feature_type string, feature_value string, name string, "
        "nearest_site_id bigint, distance_to_site_m double, "
        "rings rings, fetched_at timestamp"
    ),
    "climate_events": _table(
        "site_id bigint, event_date date, source string, temp_max_c double, temp_min_c double, "
        "temp_mean_c double, precipitation_mm double, wind_max_ms double, wind_gust_ms double, "
        "solar_radiation_kwh double, humidity_pct double, lon double, lat double"
    ),
    "earthquake_events": _table(
        "usgs_id string, magnitude double, mag_type string, depth_km double, place_desc string, "
        "event_time timestamp, significance int, mmi double, alert_level string, tsunami boolean, "
        "nearest_site_id bigint, distance_to_site_km double, lon double, lat double"
    ),
    "fire_events": _table(
        "satellite string, brightness double, confidence int, frp double, acq_date date, acq_time int, "
        "day_night string, nearest_site_id bigint, distance_to_site_km double, lon double, lat double"
    ),
    "flood_zones": _table(
        "event_date date, flood_intensity double, nearest_site_id bigint, distance_to_site_km double, "
        "lon double, lat double"
    ),
    "risk_scores": _table(
        "site_id bigint, urban_density_score double, climate_anomaly_score double, seismic_risk_score double, "
        "fire_risk_score double, flood_risk_score double, coastal_risk_score double, "
        "composite_risk_score double, isolation_forest_score double, is_anomaly boolean, risk_level string, "
        "calculated_at timestamp"
    ),
}


def load_table(spark: SparkSession, name: str, folder: str) -> DataFrame:
    """Typed scan of one stored table; columns a file lacks read as NULL."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}")
