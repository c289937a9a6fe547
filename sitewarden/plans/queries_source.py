"""Sources and the stream: rows are landed in the raw format and read back by the operator."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewarden.functions.shapes import shape_area
from sitewarden.operators.filters import union_all
from sitewarden.plans.oracle import r, with_ctes
from sitewarden.plans.registry import query, rounded, texts
from sitewarden.schemas import SCHEMAS, load_table
from sitewarden.session import new_path, stage
from sitewarden.sources import climate as cl
from sitewarden.sources import hazards as hz
from sitewarden.sources import sites as st
from sitewarden.sources.raster import RasterTransform, sample_raster
from sitewarden.sources.urban import read_osm
from sitewarden.streaming.fires import daily_counts, start_fires

W = with_ctes

_SITE_COLUMNS = ["whc_id", "name", "category", "date_inscribed", "country", "iso_code", "region", "in_danger", "area_hectares", "lon", "lat"]
_SITES_SQL = f"""{W('sites')} SELECT whc_id, name, CASE WHEN site_id % 13 = 2 THEN '' ELSE category END AS category,
    CASE WHEN site_id % 11 = 3 THEN -1 ELSE date_inscribed END AS date_inscribed, country, iso_code, region, in_danger,
    {r('CASE WHEN site_id % 17 = 5 THEN 0 ELSE area_hectares END', alias='area_hectares')}, {r('lon')}, {r('lat')}
    FROM sites WHERE site_id % 19 <> 7 AND site_id % 23 <> 4"""


def _site_rows(t):
    """Sites as the text records of the list, with some unreadable values."""
    k = F.col("site_id")

    def text(c):
        return F.col(c).cast("string")

    return t.sites.select(
        F.when(k % 19 != 7, text("whc_id")).alias("id_number"),
        F.when(k % 3 != 0, F.col("name")).alias("site"),
        F.when(k % 3 == 0, F.concat(F.lit(" "), "name")).alias("name"),
        F.when(k % 13 == 2, "Ruins").otherwise(F.col("category")).alias("category"),
        F.when(k % 11 == 3, "soon").otherwise(text("date_inscribed")).alias("date_inscribed"),
        F.col("country").alias("states"),
        "iso_code",
        "region",
        F.when(F.col("in_danger"), "1").otherwise("0").alias("danger"),
        F.when(k % 17 == 5, "n/a").otherwise(text("area_hectares")).alias("area_hectares"),
        F.when(k % 23 == 4, "x").otherwise(text("lat")).alias("latitude"),
        text("lon").alias("longitude"),
    )


def _sites_out(df):
    out = df.select(*_SITE_COLUMNS).withColumns(
        {"category": F.coalesce("category", F.lit("")), "date_inscribed": F.coalesce("date_inscribed", F.lit(-1))}
    )
    return rounded(out, "area_hectares", "lon", "lat")


@query("src_sites_xml", _SITES_SQL)
def src_sites_xml(t):
    rows = _site_rows(t)
    located = F.col("id_number").cast("int") % 2 == 0
    poi = F.struct(F.array(F.struct("latitude", "longitude")).alias("poi"))
    rows = rows.select(
        *[c for c in rows.columns if c not in ("latitude", "longitude")],
        F.when(located, poi).alias("geolocations"),
        F.when(F.coalesce(~located, F.lit(True)), F.col("latitude")).alias("latitude"),
        F.when(F.coalesce(~located, F.lit(True)), F.col("longitude")).alias("longitude"),
    )
    return _sites_out(st.read_sites_xml(t.spark, t.landed(rows, "sites_xml", "xml", rowTag="row", rootTag="query")))


def one_document(objects: DataFrame, head: str, tail: str) -> DataFrame:
    """The objects (value) as the lines of one JSON document, made as a stream by one task that holds a batch at a time."""

    def document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # an empty object first, so that every other one follows a comma
        yield pa.RecordBatch.from_arrays([pa.array([head + "{}"])], ["value"])
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pc.binary_join_element_wise(", ", batch.column("value"), "")], ["value"])
        yield pa.RecordBatch.from_arrays([pa.array([tail])], ["value"])

    return objects.coalesce(1).mapInArrow(document, "value string")


def landed_document(t, rows: DataFrame, name: str, head: str, tail: str) -> str:
    """The rows as one JSON document, as a feed would be; many tasks make its objects."""
    path = new_path(t.spark, name)
    objects = stage(rows.select(F.to_json(F.struct("*")).alias("value")), f"{name}_objects")
    one_document(objects, head, tail).write.option("lineSep", " ").text(path)
    return path


@query("src_sites_json", _SITES_SQL)
def src_sites_json(t):
    path = landed_document(t, _site_rows(t), "sites_json", "[", "]")
    return _sites_out(st.read_sites_json(t.spark, path))


@query("src_sites_fallback", _SITES_SQL)
def src_sites_fallback(t):
    empty = _site_rows(t).drop("latitude", "longitude")
    xml = t.landed(empty, "sites_xml", "xml", rowTag="row", rootTag="query")
    json = t.landed(_site_rows(t), "sites_json", "json")
    return _sites_out(st.read_sites(t.spark, xml, json, multiline=False))


def _features(t):
    e = F.substring("usgs_id", 3, 20).cast("long")
    position = F.when(e % 9 == 4, F.array("lon", "lat")).otherwise(F.array("lon", "lat", "depth_km"))
    return t.quakes.select(
        F.lit("Feature").alias("type"),
        F.struct(
            F.when(e % 31 != 6, F.col("magnitude")).alias("mag"),
            F.lit("mb").alias("magType"),
            F.when(e % 7 != 3, F.col("place_desc")).alias("place"),
            F.unix_millis(F.col("event_time").cast("timestamp")).alias("time"),
            (e % 1000).cast("int").alias("sig"),
            (e % 5 == 0).cast("int").alias("tsunami"),
        ).alias("properties"),
        F.struct(F.lit("Point").alias("type"), position.alias("coordinates")).alias("geometry"),
        F.col("usgs_id").alias("id"),
        "event_time",
    )


_QUAKES_SQL = f"""{W('quakes')} SELECT usgs_id, {r('magnitude')}, {r('CASE WHEN event_id % 9 = 4 THEN -1 ELSE depth_km END', alias='depth_km')},
    CASE WHEN event_id % 7 = 3 THEN '' ELSE place_desc END AS place_desc, strftime(event_time, '%Y-%m-%d %H:%M:%S') AS event_time,
    CAST(event_id % 1000 AS INTEGER) AS significance, event_id % 5 = 0 AS tsunami, {r('lon')}, {r('lat')} FROM quakes WHERE event_id % 31 <> 6"""


def _quakes_out(df):
    out = df.select(
        "usgs_id",
        "magnitude",
        F.coalesce("depth_km", F.lit(-1.0)).alias("depth_km"),
        F.coalesce("place_desc", F.lit("")).alias("place_desc"),
        "event_time",
        "significance",
        "tsunami",
        "lon",
        "lat",
    )
    return texts(rounded(out, "magnitude", "depth_km", "lon", "lat"), "event_time", fmt="yyyy-MM-dd HH:mm:ss")


@query("src_quakes_geojson", _QUAKES_SQL)
def src_quakes_geojson(t):
    path = landed_document(t, _features(t).drop("event_time"), "quakes", '{"type": "FeatureCollection", "metadata": {"title": "all } of \\"it\\" {["}, "features": [', "]}")
    return _quakes_out(hz.read_quakes(t.spark, path))


@query("src_quakes_by_year", _QUAKES_SQL)
def src_quakes_by_year(t):
    # one pull per ten days; each event also sits in the following pull
    pull = F.floor((F.dayofmonth("event_time") - 1) / 10).cast("int")
    rows = _features(t).withColumn("pull", F.explode(F.array(pull, pull + 1))).drop("event_time")
    path = new_path(t.spark, "pulls")
    rows.write.partitionBy("pull").json(path)
    # as many rows as there are pulls
    pulls = [f"{path}/pull={row.pull}" for row in rows.select("pull").distinct().collect()]
    return _quakes_out(hz.read_quakes_partitioned(t.spark, pulls, lines=True))


@query(
    "src_fires_csv",
    f"""{W('fires')} SELECT satellite, {r('ord % 400 / 1.0::DOUBLE', alias='brightness')},
    CAST(CASE ord % 4 WHEN 0 THEN 50 WHEN 1 THEN 80 ELSE confidence END AS INTEGER) AS confidence, {r('frp')},
    strftime(acq_date, '%Y-%m-%d') AS acq_date, acq_time, day_night, {r('lon')}, {r('lat')} FROM fires WHERE ord % 29 <> 8""",
)
def src_fires_csv(t):
    out = hz.read_fires(t.spark, _landed_fires(t, _fire_rows(t)))
    return texts(rounded(out, "brightness", "frp", "lon", "lat"), "acq_date")


def _landed_fires(t, rows):
    """One folder with the files of two sensors, each with its own columns in its own order."""
    other = F.lit("1.1")
    first = rows.where("bright_ti4 is not null").select(
        "latitude", "longitude", "bright_ti4", other.alias("scan"), other.alias("track"), "acq_date", "acq_time", "satellite",
        F.lit("VIIRS").alias("instrument"), "confidence", F.lit("2.0").alias("version"), other.alias("bright_ti5"), "frp", "daynight",
    )
    second = rows.where("bright_ti4 is null").select(
        "acq_time", "acq_date", "satellite", "brightness", other.alias("bright_t31"), "frp", "daynight", "confidence", "longitude", "latitude"
    )
    path = t.landed(first, "fires", "csv", header=True)
    second.write.mode("append").option("header", True).csv(path)
    return path


def _fire_rows(t, bad: bool = True):
    k = F.col("ord")
    brightness = (k % 400).cast("string")
    clock = F.floor(F.col("acq_time") / 60) * 100 + F.col("acq_time") % 60
    return t.fires.select(
        F.col("lat").cast("string").alias("latitude"),
        F.col("lon").cast("string").alias("longitude"),
        F.when(k % 2 == 0, brightness).alias("bright_ti4"),
        F.when(k % 2 == 1, brightness).alias("brightness"),
        F.when(k % 4 == 0, "nominal").when(k % 4 == 1, "h-HIGH").otherwise(F.col("confidence").cast("string")).alias("confidence"),
        F.col("frp").cast("string").alias("frp"),
        F.when((k % 29 == 8) & F.lit(bad), "not a day").otherwise(F.date_format("acq_date", "yyyy-MM-dd")).alias("acq_date"),
        clock.cast("int").cast("string").alias("acq_time"),
        F.when(F.col("day_night") == "N", "Night").alias("daynight"),
        "satellite",
    )


@query(
    "src_climate_arrays",
    f"""{W('climate')} SELECT site_id, strftime(event_date, '%Y-%m-%d') AS event_date, source, {r('temp_max_c')}, {r('precipitation_mm')}
    FROM climate WHERE source = 'open_meteo' AND site_id % 10 <> 3""",
)
def src_climate_arrays(t):
    # one payload per site and year: at most 366 days
    days = (
        t.climate.where("source = 'open_meteo'")
        .groupBy("site_id", F.year("event_date").alias("y"))
        .agg(F.sort_array(F.collect_list(F.struct("event_date", "temp_max_c", "precipitation_mm"))).alias("d"))
    )
    daily = F.struct(
        F.transform("d", lambda d: F.date_format(d["event_date"], "yyyy-MM-dd")).alias("time"),
        F.col("d.temp_max_c").alias("temperature_2m_max"),
        F.col("d.precipitation_mm").alias("precipitation_sum"),
    )
    payloads = days.select(
        "site_id",
        F.lit(1.5).alias("latitude"),
        F.lit(2.5).alias("longitude"),
        F.when(F.col("site_id") % 10 == 3, True).alias("error"),
        daily.alias("daily"),
    )
    out = cl.read_open_meteo(t.spark, t.landed(payloads, "open_meteo", "json"))
    out = out.select("site_id", "event_date", "source", "temp_max_c", "precipitation_mm")
    return texts(rounded(out, "temp_max_c", "precipitation_mm"), "event_date")


@query(
    "src_climate_maps",
    f"""{W('climate')} SELECT site_id, strftime(event_date, '%Y-%m-%d') AS event_date, source, {r('precipitation_mm / 2', alias='temp_mean_c')},
    {r('CASE WHEN site_id % 4 = 1 THEN NULL ELSE precipitation_mm END', alias='precipitation_mm')},
    {r('CASE WHEN day(event_date) % 2 = 1 THEN NULL ELSE day(event_date) * 1.0::DOUBLE END', alias='humidity_pct')}
    FROM climate WHERE source = 'nasa_power'""",
)
def src_climate_maps(t):
    day = F.date_format("event_date", "yyyyMMdd")
    rain = F.when(F.col("site_id") % 4 == 1, -999.0).otherwise(F.col("precipitation_mm"))
    per_year = (
        t.climate.where("source = 'nasa_power'")
        .groupBy("site_id", F.year("event_date").alias("y"))
        .agg(
            F.map_from_entries(F.collect_list(F.struct(day, F.col("precipitation_mm") / 2))).alias("T2M"),
            F.map_from_entries(F.collect_list(F.struct(day, rain))).alias("PRECTOTCORR"),
            F.map_from_entries(
                F.collect_list(
                    F.when(F.dayofmonth("event_date") % 2 == 0, F.struct(day, F.dayofmonth("event_date").cast("double")))
                )
            ).alias("RH2M"),
        )
    )
    payloads = per_year.select(
        "site_id",
        F.struct(F.array(F.lit(2.5), F.lit(1.5)).alias("coordinates")).alias("geometry"),
        F.struct(F.struct("T2M", "PRECTOTCORR", "RH2M").alias("parameter")).alias("properties"),
    )
    out = cl.read_nasa_power(t.spark, t.landed(payloads, "nasa_power", "json"))
    out = out.select("site_id", "event_date", "source", "temp_mean_c", "precipitation_mm", "humidity_pct")
    return texts(rounded(out, "temp_mean_c", "precipitation_mm", "humidity_pct"), "event_date")


@query(
    "src_urban_features",
    f"""{W('urban0')} SELECT osm_id, CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'landuse' ELSE 'building' END AS feature_type,
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'residential' WHEN 'HOUSEHOLD' THEN 'house' ELSE 'yes' END AS feature_value,
    name, nearest_site_id, CASE id % 3 WHEN 0 THEN 'MULTIPOLYGON' WHEN 1 THEN 'POLYGON' ELSE 'LINESTRING' END AS kind,
    CASE id % 3 WHEN 2 THEN 1 ELSE 2 END AS n_rings,
    CASE id % 3 WHEN 0 THEN a * a + 4 WHEN 1 THEN a * a - 1 ELSE 0 END::DOUBLE AS area
    FROM (SELECT *, id % 9 + 2 AS a FROM urban0) WHERE c_mktsegment <> 'FURNITURE'""",
)
def src_urban_features(t):
    s = F.col("c_mktsegment")
    k = F.col("c_custkey")
    building = F.when(s == "HOUSEHOLD", "house").when(s == "BUILDING", "yes").when(s == "MACHINERY", "True")
    landuse = F.when(s == "AUTOMOBILE", "residential").when(s == "FURNITURE", "forest")
    square, hole, apart = "[[0,0],[%1$d,0],[%1$d,%1$d],[0,%1$d],[0,0]]", "[[0.5,0.5],[1.5,0.5],[1.5,1.5],[0.5,1.5],[0.5,0.5]]", "[[20,0],[20,2],[22,2],[22,0],[20,0]]"
    geometry = (
        F.when(k % 3 == 0, F.format_string(f'{{"type":"MultiPolygon","coordinates":[[{square}],[{apart}]]}}', k % 9 + 2))
        .when(k % 3 == 1, F.format_string(f'{{"type":"Polygon","coordinates":[{square},{hole}]}}', k % 9 + 2))
        .otherwise(F.format_string(f'{{"type":"LineString","coordinates":{square}}}', k % 9 + 2))
    )
    rows = t.raw("customer").select(
        (k * 10).alias("osm_id"),
        F.lit("way").alias("osm_type"),
        (k % 100).alias("site_id"),
        F.struct(building.alias("building"), landuse.alias("landuse"), F.col("c_name").alias("name")).alias("tags"),
        geometry.alias("geometry"),
    )
    # the geometry is landed as an object, as the feed has it
    attributes = F.regexp_replace(F.to_json(F.struct("osm_id", "osm_type", "site_id", "tags")), r"\}$", "")
    lines = rows.select(F.concat(attributes, F.lit(',"geometry":'), "geometry", F.lit("}")).alias("value"))
    out = read_osm(t.spark, t.landed(lines, "osm", "text"))
    return out.select(
        "osm_id", "feature_type", "feature_value", "name", "nearest_site_id",
        F.col("shape.kind").alias("kind"), F.size("rings").alias("n_rings"), shape_area(F.col("shape")).alias("area"),
    )


@query(
    "src_raster_sample",
    f"""{W('sites')}, cells AS (SELECT event_id % 180 AS "row", (event_id * 7) % 360 AS col, max(event_id % 50) AS value FROM events GROUP BY 1, 2)
    SELECT s.site_id, coalesce(CASE WHEN c.value = 7 THEN NULL ELSE CAST(c.value AS DOUBLE) END, -1) AS value
    FROM sites s LEFT JOIN cells c ON c."row" = floor(90 - s.lat) AND c.col = floor(s.lon + 180)""",
)
def src_raster_sample(t):
    e = F.col("event_id")
    cells = t.raw("events").groupBy((e % 180).alias("row"), ((e * 7) % 360).alias("col")).agg(F.max(e % 50).alias("value"))
    out = sample_raster(t.sites.select("site_id", "lon", "lat"), cells, RasterTransform(-180.0, 90.0, 1.0, 1.0, 7.0))
    return out.select("site_id", F.coalesce("value", F.lit(-1.0)).alias("value"))


@query(
    "src_tables",
    f"""{W('quakes')} SELECT usgs_id, {r('magnitude')}, strftime(event_time, '%Y-%m-%d %H:%M:%S') AS event_time,
    CAST(-1 AS BIGINT) AS nearest_site_id, {r('lon')}, {r('lat')} FROM quakes""",
)
def src_tables(t):
    folder = new_path(t.spark, "tables")
    stored = t.quakes.withColumn("event_time", F.col("event_time").cast("timestamp"))
    stored.write.parquet(f"{folder}/earthquake_events")
    table = load_table(t.spark, "earthquake_events", folder)
    assert table.columns == SCHEMAS["earthquake_events"].names
    out = table.select("usgs_id", "magnitude", "event_time", F.coalesce("nearest_site_id", F.lit(-1)).cast("long").alias("nearest_site_id"), "lon", "lat")
    return texts(rounded(out, "magnitude", "lon", "lat"), "event_time", fmt="yyyy-MM-dd HH:mm:ss")


_TABLES_SQL = {
    "sites": ("sites", "area_hectares"),
    "urban_features": ("urban", "distance_to_site_m"),
    "climate_events": ("climate", "precipitation_mm"),
    "earthquake_events": ("quakes", "magnitude"),
    "fire_events": ("fires", "frp"),
    "flood_zones": ("floods", "flood_intensity"),
    "risk_scores": ("scores", "composite_risk_score"),
}


@query(
    "src_all_tables",
    f"""{W(*(cte for cte, _ in _TABLES_SQL.values()))} """
    + " UNION ALL ".join(
        f"""SELECT '{name}' AS tab, {len(SCHEMAS[name])}::BIGINT AS n_columns, count(*) AS n_rows, count({measure}) AS measured,
        {r(f'coalesce(sum({measure}), 0)', 3, 'total')} FROM {cte}"""
        for name, (cte, measure) in _TABLES_SQL.items()
    ),
)
def src_all_tables(t):
    """All stored tables by their schemas, whatever columns the files have."""
    folder = new_path(t.spark, "tables")
    parts = []
    for name, (source, measure) in _TABLES_SQL.items():
        rows = getattr(t, source)
        known = [F.col(f.name).cast(f.dataType).alias(f.name) for f in SCHEMAS[name] if f.name in rows.columns]
        rows.select(*known).write.parquet(f"{folder}/{name}")
        table = load_table(t.spark, name, folder)
        sums = F.coalesce(F.sum(measure), F.lit(0.0)).alias("total")
        part = table.agg(F.count(F.lit(1)).alias("n_rows"), F.count(measure).alias("measured"), sums)
        parts.append(part.select(F.lit(name).alias("tab"), F.lit(len(table.columns)).cast("bigint").alias("n_columns"), "n_rows", "measured", "total"))
    return rounded(union_all(*parts), "total", digits=3)


_STEP = 0.1 / 110.5


@query(
    "stream_fires",
    f"""{W('fires')}, b AS (SELECT *, least(CAST(floor((lat + 90) / {_STEP!r}::DOUBLE) AS BIGINT), CAST(ceil(180 / {_STEP!r}::DOUBLE) AS BIGINT) - 1) AS band FROM fires),
    w AS (SELECT *, greatest(1, CAST(floor(360 * cos(radians(least(90, greatest(abs(band * {_STEP!r}::DOUBLE - 90),
      abs(band * {_STEP!r}::DOUBLE - 90 + {_STEP!r}::DOUBLE))))) / {_STEP!r}::DOUBLE) AS BIGINT)) AS width FROM b),
    c AS (SELECT DISTINCT satellite, acq_date, acq_time, day_night, band,
      CAST(floor((lon + 180 - 360 * floor((lon + 180) / 360)) / 360 * width) AS BIGINT) % width AS col FROM w)
    SELECT strftime(acq_date, '%Y-%m-%d') AS day, day_night, count(*) AS detections FROM c GROUP BY 1, 2""",
)
def stream_fires(t):
    # every detection is landed twice
    rows = _fire_rows(t, bad=False).withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1)))).drop("copy")
    landing, table = _landed_fires(t, rows), new_path(t.spark, "detections")
    job = start_fires(t.spark, landing, table, new_path(t.spark, "stream"))
    job.awaitTermination()
    if job.exception() is not None:
        raise job.exception()
    return texts(daily_counts(t.spark.read.parquet(table)), "day")
