"""Domain tables derived from the TPC-H style tables, for tests and the registered queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewarden.constants import SHAPE_ROWS
from sitewarden.functions.scalars import coastal_score
from sitewarden.operators.spatial import refresh_distance
from sitewarden.session import by_key


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _d(value: Column, n: int) -> Column:
    return value.cast("double") / F.lit(float(n))


def _place(k: Column) -> tuple[Column, Column]:
    """(lon, lat) of slot k."""
    return _d((k * 104729) % 36000, 100) - 180, _d((k * 7919) % 14001, 100) - 70


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    lon, lat = _place(k)
    elevation = F.when(k % 7 != 0, ((k * 37) % 120 - 10).cast("double"))
    # 25 nations and 5 regions: fixed-size tables
    nation = _read(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = _read(spark, sf_dir, "region").select("r_regionkey", "r_name")
    places = F.broadcast(nation.join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey")))
    return (
        _read(spark, sf_dir, "supplier")
        .join(places, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            k.cast("long").alias("site_id"),
            (k + 1000).cast("int").alias("whc_id"),
            F.col("s_name").alias("name"),
            F.when(k % 3 == 0, "Cultural").when(k % 3 == 1, "Natural").otherwise("Mixed").alias("category"),
            (1978 + k % 45).cast("int").alias("date_inscribed"),
            F.col("n_name").alias("country"),
            iso_code(k).alias("iso_code"),
            F.col("r_name").alias("region"),
            (k % 20 == 0).alias("in_danger"),
            F.col("s_acctbal").cast("double").alias("area_hectares"),
            lon.alias("lon"),
            lat.alias("lat"),
            elevation.alias("elevation_m"),
            coastal_score(elevation).alias("coastal_risk_score"),
        )
    )


def iso_code(k: Column) -> Column:
    """One ISO code, two for every fifth site (transboundary)."""
    codes = F.array(*[F.lit(c) for c in ("IT", "BR", "FR", "CN", "GR", "US", "TR")])
    first = F.element_at(codes, (k % 7 + 1).cast("int"))
    second = F.element_at(codes, ((k + 3) % 7 + 1).cast("int"))
    return F.when(k % 5 == 0, F.concat(first, F.lit(", "), second)).otherwise(first)


def hazards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event rows with a position."""
    e = F.col("event_id")
    lon, lat = _place(e % 200)
    return _read(spark, sf_dir, "events").select(
        e,
        "ts",
        "event_type",
        F.col("value").cast("double").alias("value"),
        (lon + _d((e * 17) % 601 - 300, 100)).alias("lon"),
        (lat + _d((e * 31) % 601 - 300, 100)).alias("lat"),
    )


def quakes(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    regions = F.array(*[F.lit(c) for c in ("Turkey", "Italy", "Greece", "Chile")])
    return hazards(spark, sf_dir).select(
        F.concat(F.lit("ev"), e.cast("string")).alias("usgs_id"),
        (3 + _d(e % 50, 10)).alias("magnitude"),
        _d(e % 700, 10).alias("depth_km"),
        F.concat((e % 90).cast("string"), F.lit(" km N of "), F.element_at(regions, (e % 4 + 1).cast("int"))).alias(
            "place_desc"
        ),
        F.col("ts").alias("event_time"),
        "lon",
        "lat",
    )


def fires(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    hour = F.hour("ts")
    return hazards(spark, sf_dir).select(
        e.alias("ord"),
        F.concat(F.lit("SAT"), (e % 3).cast("string")).alias("satellite"),
        F.when(e % 97 != 0, F.col("value")).alias("frp"),
        ((e * 13) % 101).cast("int").alias("confidence"),
        F.to_date("ts").alias("acq_date"),
        (hour * 60 + F.minute("ts")).cast("int").alias("acq_time"),
        F.when(hour.between(6, 17), "D").otherwise("N").alias("day_night"),
        "lon",
        "lat",
    )


def floods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        hazards(spark, sf_dir)
        .where(F.col("event_type") == "error")
        .select(
            F.to_date("ts").alias("event_date"),
            _d(F.col("event_id") % 100, 100).alias("flood_intensity"),
            "event_id",
            "lon",
            "lat",
        )
    )


def climate(spark: SparkSession, sf_dir: str) -> DataFrame:
    odd = F.col("l_linenumber") % 2 == 1
    quantity, price = F.col("l_quantity").cast("double"), F.col("l_extendedprice").cast("double")
    keys = ["site_id", "event_date", "source"]
    rows = _read(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("long").alias("site_id"),
        F.to_date("l_shipdate").alias("event_date"),
        F.when(odd, "open_meteo").otherwise("nasa_power").alias("source"),
        F.when(odd, 40 * F.pow(quantity / 50, F.lit(6.0))).alias("temp_max_c"),
        (50 * F.pow(price / 100000, F.lit(8.0))).alias("precipitation_mm"),
    )
    # few days have two rows, so nothing is combined before the shuffle; a task's groups stay as many, however large the table
    return by_key(rows, keys).groupBy(*keys).agg(F.max("temp_max_c").alias("temp_max_c"), F.max("precipitation_mm").alias("precipitation_mm"))


def urban_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features with their site reference, main footprint (`rings`) and, for buildings, whole `shape`; distance not yet measured."""
    c = F.col("c_custkey")
    slot_lon, slot_lat = _place(c % 100)
    building = F.col("c_mktsegment").isin("BUILDING", "HOUSEHOLD", "MACHINERY")
    half = _d(10 + c % 40, 2) / 111320.0
    # the shapes are costly to measure and the rows few to a file
    rows = by_key(_read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_name"), ["c_custkey"], SHAPE_ROWS)
    placed = rows.select(
        c.cast("long").alias("id"),
        (c * 10).cast("long").alias("osm_id"),
        F.lit("way").alias("osm_type"),
        F.when(building, "building").otherwise("landuse").alias("feature_type"),
        F.when(building, "yes").otherwise("residential").alias("feature_value"),
        F.col("c_name").alias("name"),
        (c % 100).cast("long").alias("nearest_site_id"),
        (slot_lon + _d((c * 7) % 201 - 100, 1000)).alias("lon"),
        (slot_lat + _d((c * 13) % 201 - 100, 1000)).alias("lat"),
        building.alias("is_building"),
        half.alias("half_lat"),
    ).withColumn("half_lon", F.col("half_lat") / F.cos(F.radians("lat")))

    def box(scale: float = 1.0, east: float = 0.0) -> Column:
        corners = ((-1, -1), (1, -1), (1, 1), (-1, 1), (-1, -1))
        lon, lat, wide, high = (F.col(n) for n in ("lon", "lat", "half_lon", "half_lat"))
        return F.array(*[F.struct((lon + (sx * scale + east) * wide).alias("x"), (lat + sy * scale * high).alias("y")) for sx, sy in corners])

    square = box()
    point = F.array(F.struct(F.col("lon").alias("x"), F.col("lat").alias("y")))
    # every seventh building has a yard, every fifth a wing apart from it
    house = F.when(F.col("id") % 7 == 0, F.array(square, box(0.5))).otherwise(F.array(square))
    parts = F.when(F.col("id") % 5 == 0, F.array(house, F.array(box(1.0, 4.0)))).otherwise(F.array(house))
    kind = F.when(F.col("id") % 5 == 0, "MULTIPOLYGON").otherwise("POLYGON")
    shape = F.when(F.col("is_building"), F.struct(kind.alias("kind"), parts.alias("polygons")))
    shaped = placed.withColumn("shape", shape)
    return shaped.withColumn("rings", F.array(F.when(F.col("is_building"), square).otherwise(point))).drop(
        "is_building", "half_lat", "half_lon"
    )


def urban(spark: SparkSession, sf_dir: str, strategy: str = "auto") -> DataFrame:
    """Features with distance_to_site_m."""
    return refresh_distance(urban_raw(spark, sf_dir), sites(spark, sf_dir), strategy)
