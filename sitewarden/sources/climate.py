"""Daily climate payload readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitewarden.constants import MISSING_MARKER
from sitewarden.functions.scalars import to_day
from sitewarden.schemas import SCHEMAS

# fixed values: feed variable -> table column
_ARRAYS = {
    "temperature_2m_max": "temp_max_c",
    "temperature_2m_min": "temp_min_c",
    "temperature_2m_mean": "temp_mean_c",
    "precipitation_sum": "precipitation_mm",
    "windspeed_10m_max": "wind_max_ms",
    "windgusts_10m_max": "wind_gust_ms",
}
_MAPS = {
    "T2M": "temp_mean_c",
    "PRECTOTCORR": "precipitation_mm",
    "WS10M": "wind_max_ms",
    "ALLSKY_SFC_SW_DWN": "solar_radiation_kwh",
    "RH2M": "humidity_pct",
}


def _as_table(df: DataFrame) -> DataFrame:
    """The climate table's columns, absent measures as NULL."""
    fields = SCHEMAS["climate_events"].fields
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in fields
        ]
    )


def read_open_meteo(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Payloads of parallel arrays -> one row per day; error payloads and those without days are dropped."""
    daily = T.StructType(
        [
            T.StructField("time", T.ArrayType(T.StringType())),
            *[T.StructField(v, T.ArrayType(T.DoubleType())) for v in _ARRAYS],
        ]
    )
    schema = T.StructType(
        [
            T.StructField("site_id", T.LongType()),
            T.StructField("latitude", T.DoubleType()),
            T.StructField("longitude", T.DoubleType()),
            T.StructField("error", T.BooleanType()),
            T.StructField("daily", daily),
        ]
    )
    payloads = spark.read.schema(schema).option("multiLine", multiline).json(path)
    good = payloads.where(F.col("error").isNull() & F.col("daily").isNotNull())
    # a variable the payload lacks must not void the zip
    columns = [F.col("daily.time").alias("time")] + [
        F.coalesce(F.col(f"daily.{v}"), F.array().cast("array<double>")).alias(v) for v in _ARRAYS
    ]
    days = good.select("site_id", "latitude", "longitude", F.arrays_zip(*columns).alias("z")).select(
        "site_id", "latitude", "longitude", F.inline("z")
    )
    return _as_table(
        days.select(
            "site_id",
            to_day(F.col("time")).alias("event_date"),
            F.lit("open_meteo").alias("source"),
            *[F.col(v).alias(c) for v, c in _ARRAYS.items()],
            F.col("longitude").alias("lon"),
            F.col("latitude").alias("lat"),
        ).where(F.col("event_date").isNotNull())
    )


def read_nasa_power(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Payloads of date -> value maps -> one row per day of T2M; -999 is missing."""
    values = T.MapType(T.StringType(), T.StringType())
    schema = T.StructType(
        [
            T.StructField("site_id", T.LongType()),
            T.StructField(
                "geometry", T.StructType([T.StructField("coordinates", T.ArrayType(T.DoubleType()))])
            ),
            T.StructField(
                "properties", T.StructType([T.StructField("parameter", T.MapType(T.StringType(), values))])
            ),
        ]
    )
    payloads = spark.read.schema(schema).option("multiLine", multiline).json(path)
    p = F.col("properties.parameter")
    days = payloads.select(
        "site_id", "geometry", p.alias("p"), F.explode(F.map_keys(F.try_element_at(p, F.lit("T2M")))).alias("day")
    )

    def measure(variable: str) -> Column:
        value = F.try_element_at(F.try_element_at(F.col("p"), F.lit(variable)), F.col("day")).try_cast("double")
        return F.nullif(value, F.lit(MISSING_MARKER))

    return _as_table(
        days.select(
            "site_id",
            to_day(F.col("day"), "yyyyMMdd").alias("event_date"),
            F.lit("nasa_power").alias("source"),
            *[measure(v).alias(c) for v, c in _MAPS.items()],
            F.try_element_at(F.col("geometry.coordinates"), F.lit(1)).alias("lon"),
            F.try_element_at(F.col("geometry.coordinates"), F.lit(2)).alias("lat"),
        ).where(F.col("event_date").isNotNull())
    )
