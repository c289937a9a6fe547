"""Sinks: two overlapping parts that together make the whole table are merged and the state returned."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewarden.constants import RISK_COLORS
from sitewarden.operators.merge import last_per_key, update_matched
from sitewarden.plans import layers
from sitewarden.plans.oracle import SCORES6, r, with_ctes
from sitewarden.plans.queries_spatial import GREEDY_SQL, copies_of
from sitewarden.plans.registry import SCORES, query, rounded, texts
from sitewarden.session import new_path
from sitewarden.sources import sinks

W = with_ctes


def merged(t, name: str, current: DataFrame, change: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The table after `change`: both states are written versions, the second is read back."""
    base = new_path(t.spark, name)
    sinks.write_version(current, base)
    return sinks.next_version(t.spark, base, change)


@query(
    "snk_upsert_sites",
    f"""{W('sites')} SELECT whc_id, CASE WHEN site_id % 6 IN (0, 2, 3, 4) THEN name || ' new' ELSE name END AS name, country,
    {r('CASE WHEN site_id % 6 IN (0, 2, 3, 4) THEN area_hectares + 1 ELSE area_hectares END', alias='area_hectares')},
    {r('CASE WHEN site_id % 6 IN (0, 2, 3, 4) THEN lon + 0.5 ELSE lon END', alias='lon')}, site_id % 6 IN (0, 2, 3, 4) AS touched
    FROM sites""",
)
def snk_upsert_sites(t):
    columns = ["whc_id", "name", "country", "area_hectares", "lon", "lat"]
    k = F.col("site_id")
    cur = t.sites.where(k % 3 != 0).select(*columns, F.lit(None).cast("timestamp").alias("updated_at"))
    new = (
        t.sites.where((k % 2 == 0) | (k % 3 == 0))
        .select(*columns)
        .withColumns(
            {
                "name": F.concat("name", F.lit(" new")),
                "area_hectares": F.col("area_hectares") + 1,
                "lon": F.col("lon") + 0.5,
            }
        )
    )
    out = merged(t, "sites", cur, lambda c: sinks.upsert_sites(c, new)).withColumn("touched", F.col("updated_at").isNotNull())
    return rounded(out.select("whc_id", "name", "country", "area_hectares", "lon", "touched"), "area_hectares", "lon")


@query(
    "snk_upsert_climate",
    f"""{W('climate')} SELECT site_id, strftime(event_date, '%Y-%m-%d') AS event_date, source, {r('CASE WHEN site_id % 6 IN (0, 2, 3, 4) THEN temp_max_c + 1 ELSE temp_max_c END', alias='temp_max_c')},
    {r('CASE WHEN site_id % 6 IN (0, 2, 3, 4) THEN precipitation_mm + 1 ELSE precipitation_mm END', alias='precipitation_mm')},
    CASE WHEN site_id % 3 <> 0 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS lon FROM climate""",
)
def snk_upsert_climate(t):
    k = F.col("site_id")
    cur = t.climate.where(k % 3 != 0).withColumn("lon", F.lit(1.0))
    new = t.climate.where((k % 2 == 0) | (k % 3 == 0)).withColumns(
        {
            "temp_max_c": F.col("temp_max_c") + 1,
            "precipitation_mm": F.col("precipitation_mm") + 1,
            "lon": F.lit(2.0),
        }
    )
    # written as the next version of the table, then read back
    base = new_path(t.spark, "climate")
    sinks.write_version(cur, base, ["source"])
    sinks.write_version(sinks.upsert_climate(sinks.read_current(t.spark, base), new), base, ["source"])
    out = sinks.read_current(t.spark, base)
    return texts(rounded(out, "temp_max_c", "precipitation_mm"), "event_date")


@query(
    "snk_upsert_quakes",
    f"""{W('quakes')} SELECT usgs_id, {r('CASE WHEN event_id % 6 IN (0, 2, 3, 4) THEN magnitude + 1 ELSE magnitude END', alias='magnitude')},
    {r('CASE WHEN event_id % 3 <> 0 THEN lon ELSE lon + 1 END', alias='lon')},
    CASE WHEN event_id % 3 <> 0 THEN event_id % 10 ELSE -1 END AS nearest_site_id FROM quakes""",
)
def snk_upsert_quakes(t):
    e = F.substring("usgs_id", 3, 20).cast("long")
    cur = t.quakes.where(e % 3 != 0).withColumn("nearest_site_id", e % 10)
    new = t.quakes.where((e % 2 == 0) | (e % 3 == 0)).withColumns({"magnitude": F.col("magnitude") + 1, "lon": F.col("lon") + 1})
    out = merged(t, "quakes", cur, lambda c: sinks.upsert_quakes(c, new)).select(
        "usgs_id", "magnitude", "lon", F.coalesce("nearest_site_id", F.lit(-1)).cast("long").alias("nearest_site_id")
    )
    return rounded(out, "magnitude", "lon")


@query(
    "snk_insert_fires",
    f"""{W('fires')}, {GREEDY_SQL}, s AS (SELECT *, o0 % 7 = 0 AS st FROM trio)
    SELECT o0 AS ord FROM s UNION ALL SELECT o1 FROM s WHERE NOT ab
    UNION ALL SELECT o2 FROM s WHERE NOT ac AND (ab OR NOT bc)""",
)
def snk_insert_fires(t):
    rows = copies_of(t)
    first = (F.col("copy") == 0) & (F.col("ord") % 7 == 0)
    stored, new = rows.where(first), rows.where(~first)
    return merged(t, "fires", stored, lambda c: sinks.insert_fires(c, new, method="haversine")).select("ord")


_FLOOD_KEY = "event_id % 100 AS nearest_site_id, event_date"


@query(
    "snk_upsert_floods",
    f"""{W('floods')}, cur AS (SELECT {_FLOOD_KEY}, flood_intensity, lon FROM floods WHERE event_id % 2 = 1
      QUALIFY row_number() OVER (PARTITION BY event_id % 100, event_date ORDER BY event_id DESC) = 1),
    new AS (SELECT (event_id + 1) % 100 AS nearest_site_id, event_date, flood_intensity, lon FROM floods WHERE event_id % 2 = 0 AND flood_intensity > 0
      QUALIFY row_number() OVER (PARTITION BY (event_id + 1) % 100, event_date ORDER BY event_id DESC) = 1)
    SELECT coalesce(n.nearest_site_id, c.nearest_site_id) AS nearest_site_id, strftime(coalesce(n.event_date, c.event_date), '%Y-%m-%d') AS event_date,
    {r('coalesce(n.flood_intensity, c.flood_intensity)', alias='flood_intensity')}, {r('coalesce(n.lon, c.lon)', alias='lon')},
    CASE WHEN c.lon IS NULL THEN 0.0::DOUBLE ELSE 5.0::DOUBLE END AS distance_to_site_km
    FROM cur c FULL JOIN new n ON c.nearest_site_id = n.nearest_site_id AND c.event_date = n.event_date""",
)
def snk_upsert_floods(t):
    e = F.col("event_id")
    base = t.floods.select("event_date", "flood_intensity", "event_id", "lon", "lat")
    keys = ["nearest_site_id", "event_date"]
    cur = last_per_key(base.where(e % 2 == 1).withColumn("nearest_site_id", e % 100), keys, "event_id")
    cur = cur.withColumn("distance_to_site_km", F.lit(5.0))
    new = base.where(e % 2 == 0).withColumn("nearest_site_id", (e + 1) % 100)
    out = merged(t, "floods", cur, lambda c: sinks.upsert_floods(c, new, order="event_id"))
    return texts(rounded(out.drop("lat"), "flood_intensity", "lon"), "event_date")


@query(
    "snk_append_urban",
    f"""{W('urban0')} SELECT osm_id, nearest_site_id, CASE WHEN id % 3 <> 0 AND id % 6 IN (0, 2, 3, 4) THEN 2 ELSE 1 END AS copies,
    CAST(1 AS BIGINT) AS kept FROM urban0""",
)
def snk_append_urban(t):
    k = F.col("id")
    path = new_path(t.spark, "urban")
    columns = ["id", "osm_id", "osm_type", "feature_type", "feature_value", "name", "nearest_site_id"]
    rows = t.urban_raw.select(*columns, F.lit(1.0).alias("area_m2"))
    sinks.append_urban(rows.where(k % 3 != 0), path)
    sinks.append_urban(rows.where((k % 2 == 0) | (k % 3 == 0)), path)
    stored = t.spark.read.parquet(path)
    keys = ["osm_id", "nearest_site_id"]
    copies = stored.groupBy(*keys).agg(F.count(F.lit(1)).cast("int").alias("copies"))
    kept = sinks.dedupe_urban(stored).groupBy(*keys).agg(F.count(F.lit(1)).alias("kept"))
    return copies.join(kept, keys)


@query(
    "snk_upsert_scores",
    f"""{W('flagged')} SELECT site_id, {', '.join(r(f"CASE WHEN site_id % 6 IN (0, 2, 3, 4) THEN {c} / 2 ELSE {c} END", alias=c) for c in (*SCORES6, 'composite_risk_score'))},
    CASE WHEN site_id % 6 IN (0, 2, 3, 4) THEN 'low' ELSE risk_level END AS risk_level,
    CASE WHEN site_id % 3 <> 0 THEN is_anomaly ELSE false END AS is_anomaly FROM flagged""",
)
def snk_upsert_scores(t):
    k = F.col("site_id")
    columns = [*SCORES, "composite_risk_score"]
    cur = t.flagged.where(k % 3 != 0)
    new = (
        t.scores.where((k % 2 == 0) | (k % 3 == 0))
        .withColumns({c: F.col(c) / 2 for c in columns})
        .withColumn("risk_level", F.lit(None).cast("string"))
    )
    out = merged(t, "scores", cur, lambda c: sinks.upsert_scores(c, new)).withColumn("is_anomaly", F.coalesce("is_anomaly", F.lit(False)))
    return rounded(out.select("site_id", *columns, "risk_level", "is_anomaly"), *columns)


@query(
    "snk_update_columns",
    f"""{W('urban0')} SELECT id, {r("CASE WHEN id % 2 = 0 THEN id * 0.5::DOUBLE ELSE -1 END", alias='density_score')},
    CASE WHEN id % 2 = 0 THEN 'updated' ELSE feature_type END AS feature_type FROM urban0""",
)
def snk_update_columns(t):
    k = F.col("id")
    cur = t.urban_raw.select("id", "feature_type", "name")
    upd = t.urban_raw.where(k % 2 == 0).select(
        (k * 0.5).cast("double").alias("density_score"), F.lit("updated").alias("feature_type"), "id"
    )
    out = merged(t, "features", cur, lambda c: update_matched(c, upd, ["id"], ["feature_type", "density_score"]))
    return rounded(
        out.select("id", F.coalesce("density_score", F.lit(-1.0)).alias("density_score"), "feature_type"), "density_score"
    )


_COLOR = "CASE risk_level " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in RISK_COLORS.items()) + " ELSE '#888' END"


@query(
    "snk_map_layers",
    f"""{W('view')} SELECT 'marker' AS layer, CAST(site_id AS VARCHAR) AS item, {r('lat', alias='latitude')}, {r('lon', alias='longitude')},
      round(composite_risk_score, 2) + 0.0 AS value, CASE WHEN is_anomaly THEN '#d32f2f' ELSE {_COLOR} END || ' ' || {_COLOR} AS color,
      CASE WHEN is_anomaly THEN 8 ELSE 5 END AS radius FROM view
    UNION ALL SELECT 'heat', CAST(site_id AS VARCHAR), {r('lat')}, {r('lon')}, {r('composite_risk_score')}, '', 0 FROM view
    UNION ALL SELECT 'cluster', CAST(floor((lon + 180) / 10) AS BIGINT) || '_' || CAST(floor((lat + 90) / 10) AS BIGINT),
      {r('avg(lat)', alias='a')}, {r('avg(lon)', alias='b')}, {r('max(composite_risk_score)', alias='c')}, '', CAST(count(*) AS INTEGER) FROM view
      GROUP BY floor((lon + 180) / 10), floor((lat + 90) / 10)""",
)
def snk_map_layers(t):
    path = new_path(t.spark, "layers")
    layers.write_layers(t.view, path)
    read = t.spark.read
    marker = read.schema("site_id bigint, latitude double, longitude double, composite_risk_score double, color string, fill_color string, radius int").json(f"{path}/markers")
    heat = read.schema("site_id bigint, latitude double, longitude double, composite_risk_score double").json(f"{path}/heat")
    cluster = read.schema("cell_x bigint, cell_y bigint, sites bigint, latitude double, longitude double, max_score double").json(f"{path}/clusters")

    def part(df, layer, item, value, color, radius):
        return df.select(
            F.lit(layer).alias("layer"),
            item.cast("string").alias("item"),
            "latitude",
            "longitude",
            F.col(value).alias("value"),
            color.alias("color"),
            radius.cast("int").alias("radius"),
        )

    out = (
        part(marker, "marker", F.col("site_id"), "composite_risk_score", F.concat_ws(" ", "color", "fill_color"), F.col("radius"))
        .unionByName(part(heat, "heat", F.col("site_id"), "composite_risk_score", F.lit(""), F.lit(0)))
        .unionByName(part(cluster, "cluster", F.concat_ws("_", "cell_x", "cell_y"), "max_score", F.lit(""), F.col("sites")))
    )
    return rounded(out, "latitude", "longitude", "value")
