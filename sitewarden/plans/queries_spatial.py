"""Spatial functions and joins."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewarden.functions import geodesy as g
from sitewarden.functions import polygons as pg
from sitewarden.functions import shapes as sh
from sitewarden.operators import exposure as ex
from sitewarden.operators import reports as rp
from sitewarden.operators import spatial as sp
from sitewarden.operators.areas import points_in_areas
from sitewarden.operators.neardup import drop_near_duplicates
from sitewarden.operators.scaling import merge_scores
from sitewarden.plans.linking import link_hazard
from sitewarden.plans.oracle import _DD, _RQ, SCORES6, haversine, laea, lambert, r, with_ctes
from sitewarden.plans.queries_scalar import nearest_sql
from sitewarden.plans.registry import SCORES, query, rounded, texts

W = with_ctes


@query("sp_point", f"{W('sites')} SELECT site_id, {r('lon', alias='x')}, {r('lat', alias='y')} FROM sites")
def sp_point(t):
    p = g.st_point(F.col("lon"), F.col("lat"))
    return rounded(t.sites.select("site_id", g.st_x(p).alias("x"), g.st_y(p).alias("y")), "x", "y")


@query(
    "sp_wkt",
    f"""{W('sites')} SELECT site_id, format('POINT({{:.6f}} {{:.6f}})', lon, lat) AS wkt, {r('lon')}, {r('lat')} FROM sites""",
)
def sp_wkt(t):
    texted = t.sites.select("site_id", g.to_wkt(F.col("lon"), F.col("lat")).alias("wkt"))
    p = g.parse_point_wkt(F.col("wkt"))
    return rounded(texted.select("site_id", "wkt", p["x"].alias("lon"), p["y"].alias("lat")), "lon", "lat")


@query(
    "sp_transform_3035",
    f"SELECT event_id, {r('x', 2)}, {r('y', 2)} FROM ({W('hazards')} SELECT * FROM {laea('hazards')})",
)
def sp_transform_3035(t):
    placed = t.hazards.withColumn("p", g.to_3035(F.col("lon"), F.col("lat")))
    return rounded(placed.select("event_id", "p.x", "p.y"), "x", "y", digits=2)


@query(
    "sp_transform_3857",
    f"""{W('hazards')} SELECT event_id, {r('6378137.0::DOUBLE * radians(lon)', 3, 'x')},
    {r('6378137.0::DOUBLE * ln(tan(pi() / 4 + radians(lat) / 2))', 3, 'y')} FROM hazards""",
)
def sp_transform_3857(t):
    placed = t.hazards.withColumn("p", g.to_3857(F.col("lon"), F.col("lat")))
    return rounded(placed.select("event_id", "p.x", "p.y"), "x", "y", digits=3)


def _feature_site(t):
    """Features next to their linked site."""
    s = t.sites.select(F.col("site_id").alias("nearest_site_id"), F.col("lon").alias("site_lon"), F.col("lat").alias("site_lat"))
    joined = t.urban_raw.select("id", "nearest_site_id", "lon", "lat")
    return joined.join(F.broadcast(s) if t.strategy == "broadcast" else s, "nearest_site_id")


_LINKED = "(SELECT u.id, u.nearest_site_id, u.lon, u.lat, s.lon AS site_lon, s.lat AS site_lat FROM urban0 u JOIN sites s ON u.nearest_site_id = s.site_id)"


@query(
    "sp_distance_planar",
    f"""{W('urban0', 'sites', 'sites_p')} SELECT u.id, {r('sqrt(power(u.x - s.x, 2) + power(u.y - s.y, 2))', 3, 'distance_m')}
    FROM {laea('urban0')} u JOIN sites_p s ON u.nearest_site_id = s.site_id""",
)
def sp_distance_planar(t):
    j = g.with_3035(g.with_3035(_feature_site(t), "px", "py"), "qx", "qy", "site_lon", "site_lat")
    d = g.planar_m(F.col("px"), F.col("py"), F.col("qx"), F.col("qy"))
    return rounded(j.select("id", d.alias("distance_m")), "distance_m", digits=3)


@query(
    "sp_distance_geodesic",
    f"""{W('urban0', 'sites')} SELECT id, {r('distance_m', 3, 'spheroid_m')},
    {r(haversine('lat', 'lon', 'site_lat', 'site_lon'), 3, 'sphere_m')} FROM {lambert(_LINKED)}""",
)
def sp_distance_geodesic(t):
    args = (F.col("lat"), F.col("lon"), F.col("site_lat"), F.col("site_lon"))
    out = _feature_site(t).select(
        "id",
        g.geodesic_m(*args).alias("spheroid_m"),
        g.geodesic_m(*args, method="haversine").alias("sphere_m"),
    )
    return rounded(out, "spheroid_m", "sphere_m", digits=3)


@query(
    "sp_polygon_area",
    f"""{W('urban0', 'areas')} SELECT u.id, {r('coalesce(a.area_m2, 0)', 3, 'area_m2')} FROM urban0 u LEFT JOIN areas a ON u.id = a.id""",
)
def sp_polygon_area(t):
    measured = pg.with_plane_rings(t.urban_raw.select("id", "rings")).select(
        "id", pg.st_area(F.col("rings_m")).alias("area_m2")
    )
    return rounded(measured, "area_m2", digits=3)


@query("sp_centroid", f"{W('urban0')} SELECT id, {r('lon', alias='cx')}, {r('lat', alias='cy')} FROM urban0")
def sp_centroid(t):
    c = t.urban_raw.select("id", pg.st_centroid(F.col("rings")).alias("c"))
    return rounded(c.select("id", F.col("c.x").alias("cx"), F.col("c.y").alias("cy")), "cx", "cy")


@query(
    "sp_buffer",
    # a ring that leaves the projected disc has no lon/lat form
    f"""{W('sites', 'sites_p')} SELECT site_id, CAST(d.m AS INTEGER) AS buffer_m, 65 AS vertices,
    CASE WHEN sqrt(power((x - 4321000) / {_DD!r}::DOUBLE, 2) + power((y - 3210000) * {_DD!r}::DOUBLE, 2)) + d.m > {2 * _RQ!r}::DOUBLE THEN -1
      ELSE {r(f'{0.5 * 64 * math.sin(2 * math.pi / 64)!r}::DOUBLE', 4).split(' AS ')[0]} END AS area_ratio
    FROM sites_p, (VALUES (5000), (10000), (25000), (50000)) d(m)""",
)
def sp_buffer(t):
    rings = sp.create_buffers(t.sites)
    plane = pg.with_plane_rings(rings.withColumn("rings", F.array("ring")))
    ratio = pg.st_area(F.col("rings_m")) / (F.col("buffer_m") * F.col("buffer_m").cast("double"))
    ratio = F.coalesce(ratio, F.lit(-1.0))
    return rounded(
        plane.select("site_id", "buffer_m", F.size("ring").alias("vertices"), ratio.alias("area_ratio")),
        "area_ratio",
        digits=4,
    )


@query(
    "sp_point_in_polygon",
    f"{W('urban0')} SELECT id, id % 5 <= 2 AND feature_type = 'building' AS inside FROM urban0",
)
def sp_point_in_polygon(t):
    half = F.when(
        F.size(F.col("rings")[0]) > 1, F.col("rings")[0][1]["x"] - F.col("lon")
    ).otherwise(0.0)
    x = F.col("lon") + half * 0.4 * (F.col("id") % 5)
    probed = t.urban_raw.select("id", "rings", "lat", x.alias("px"))
    return probed.select("id", pg.st_within(F.col("px"), F.col("lat"), F.col("rings")).alias("inside"))


@query("sp_point_polygon_distance", f"{W('distances')} SELECT id, {r('distance_m', 3)} FROM distances")
def sp_point_polygon_distance(t):
    s = sp.with_plane(t.sites.select("site_id", "lon", "lat"), "sx", "sy").select(
        F.col("site_id").alias("nearest_site_id"), "sx", "sy"
    )
    side = F.broadcast(s) if t.strategy == "broadcast" else s
    shapes = pg.with_plane_rings(t.urban_raw.select("id", "nearest_site_id", "rings").join(side, "nearest_site_id"))
    measured = shapes.select("id", pg.st_distance(F.col("rings_m"), F.col("sx"), F.col("sy")).alias("distance_m"))
    return rounded(measured, "distance_m", digits=3)


@query(
    "sp_bounds",
    f"""{W('hazards')} SELECT {r('min(lon)', alias='min_lon')}, {r('min(lat)', alias='min_lat')},
    {r('max(lon)', alias='max_lon')}, {r('max(lat)', alias='max_lat')} FROM hazards""",
)
def sp_bounds(t):
    return rounded(rp.total_bounds(t.hazards), "min_lon", "min_lat", "max_lon", "max_lat")


@query(
    "sp_crs_check",
    f"""{W('urban0', 'sites')}, near AS (SELECT * FROM {lambert(_LINKED)} WHERE distance_m > 0),
    a AS (SELECT nearest_site_id, distance_m, x AS ax, y AS ay, site_lon AS lon, site_lat AS lat
      FROM (SELECT * EXCLUDE (lon, lat) FROM {laea('near')})),
    c AS (SELECT * FROM {laea('a')})
    SELECT nearest_site_id AS site_id, count(*) AS features,
    {r('min(sqrt(power(ax - x, 2) + power(ay - y, 2)) / distance_m)', alias='min_ratio')},
    {r('max(sqrt(power(ax - x, 2) + power(ay - y, 2)) / distance_m)', alias='max_ratio')} FROM c GROUP BY 1""",
)
def sp_crs_check(t):
    return rounded(sp.projection_scale(_feature_site(t)), "min_ratio", "max_ratio")


@query(
    "join_within_distance",
    f"""{W('sites', 'quake_pairs')} SELECT s.site_id, coalesce(p.usgs_id, '') AS usgs_id, {r('coalesce(p.distance_m, -1)', 3, 'distance_m')}
    FROM sites s LEFT JOIN quake_pairs p ON s.site_id = p.site_id""",
)
def join_within_distance(t):
    pairs = sp.distance_join(t.sites, t.quakes.select("usgs_id", "lon", "lat"), 200_000, strategy=t.strategy)
    out = pairs.select(
        "site_id", F.coalesce("usgs_id", F.lit("")).alias("usgs_id"), F.coalesce("distance_m", F.lit(-1.0)).alias("distance_m")
    )
    return rounded(out, "distance_m", digits=3)


@query(
    "join_nearest_lateral",
    f"{W('sites', 'quakes', 'sites_p')}, {nearest_sql(50000)} SELECT usgs_id, site_id, {r('distance_km')} FROM links",
)
def join_nearest_lateral(t):
    return rounded(sp.nearest_site(t.quakes, t.sites, 50.0, "usgs_id", strategy=t.strategy), "distance_km")


@query(
    "join_nearest_projected",
    f"""{W('quakes', 'sites_p')}, e AS (SELECT * FROM {laea('quakes')}),
    d AS (SELECT e.usgs_id, s.site_id, sqrt(power(e.x - s.x, 2) + power(e.y - s.y, 2)) AS m FROM e, sites_p s)
    SELECT usgs_id, site_id, {r('m', 3, 'distance_to_site_m')}, {r('m / 1000', 6, 'distance_to_site_km')} FROM (
      SELECT *, rank() OVER (PARTITION BY usgs_id ORDER BY m) AS k FROM d WHERE m <= 100000) WHERE k = 1""",
)
def join_nearest_projected(t):
    out = sp.nearest_site_projected(t.quakes, t.sites, 100_000, "usgs_id", strategy=t.strategy)
    return rounded(rounded(out, "distance_to_site_m", digits=3), "distance_to_site_km")


_SEGMENTS = """SELECT e.id, s.site_id, CASE WHEN (ay > s.y) <> (by_ > s.y) AND s.x < ax + (s.y - ay) * (bx - ax) / nullif(by_ - ay, 0)
      THEN 1 ELSE 0 END AS hit, sqrt(power(s.x - ax, 2) + power(s.y - ay, 2)) AS far, ax, ay, bx, by_, s.x, s.y,
      greatest(0::DOUBLE, least(1::DOUBLE, ((s.x - ax) * (bx - ax) + (s.y - ay) * (by_ - ay)) / (power(bx - ax, 2) + power(by_ - ay, 2)))) AS t
      FROM edges e, sites_p s WHERE abs(s.x - ax) < 6000 AND abs(s.y - ay) < 6000"""


@query(
    "join_within_buffer",
    f"""{W('edges', 'vertices', 'urban0', 'sites_p')}, seg AS ({_SEGMENTS})
    SELECT id, site_id AS nearest_site_id, {r("CASE WHEN sum(hit) % 2 = 1 THEN 0::DOUBLE ELSE min(sqrt(power(x - (ax + t * (bx - ax)), 2) + power(y - (ay + t * (by_ - ay)), 2))) END", 3, 'distance_to_site_m')}
    FROM seg GROUP BY id, site_id HAVING count(*) = 4 AND max(far) < 5000
    UNION ALL SELECT v.id, s.site_id, {r('sqrt(power(v.x - s.x, 2) + power(v.y - s.y, 2))', 3, 'd')}
    FROM vertices v JOIN urban0 u ON u.id = v.id AND u.feature_type <> 'building', sites_p s
    WHERE sqrt(power(v.x - s.x, 2) + power(v.y - s.y, 2)) < 5000""",
)
def join_within_buffer(t):
    out = sp.urban_in_buffer(t.urban_raw, t.sites, 5000.0, strategy=t.strategy)
    return rounded(out.select("id", "nearest_site_id", "distance_to_site_m"), "distance_to_site_m", digits=3)


@query(
    "join_refresh_distance",
    f"""{W('urban')} SELECT id, nearest_site_id, {r('coalesce(distance_to_site_m, -1)', 3, 'distance_to_site_m')} FROM urban""",
)
def join_refresh_distance(t):
    out = sp.refresh_distance(t.urban_raw, t.sites, t.strategy)
    out = out.select("id", "nearest_site_id", F.coalesce("distance_to_site_m", F.lit(-1.0)).alias("distance_to_site_m"))
    return rounded(out, "distance_to_site_m", digits=3)


@query(
    "join_left_extra_pred",
    f"""{W('sites', 'urban')} SELECT s.site_id, coalesce(u.id, -1) AS id, coalesce(u.feature_type, '') AS feature_type,
    {r('coalesce(u.distance_to_site_m, -1)', 3, 'distance_to_site_m')}
    FROM sites s LEFT JOIN urban u ON u.nearest_site_id = s.site_id AND u.distance_to_site_m <= 10000""",
)
def join_left_extra_pred(t):
    out = sp.sites_with_features(t.sites, t.urban, 10_000, t.strategy).select(
        "site_id",
        F.coalesce("id", F.lit(-1)).cast("long").alias("id"),
        F.coalesce("feature_type", F.lit("")).alias("feature_type"),
        F.coalesce("distance_to_site_m", F.lit(-1.0)).alias("distance_to_site_m"),
    )
    return rounded(out, "distance_to_site_m", digits=3)


@query(
    "join_stats_back",
    f"""{W('climate', 'climate_stats', 'sites')} SELECT c.site_id, strftime(c.event_date, '%Y-%m-%d') AS event_date, c.source,
    {r('c.precipitation_mm')}, {r('t.tm', alias='temp_mean')}, {r('coalesce(t.ts, -1)', alias='temp_stddev')}, t.total_days
    FROM climate c JOIN climate_stats t ON c.site_id = t.site_id JOIN sites s ON s.site_id = c.site_id""",
)
def join_stats_back(t):
    out = ex.with_group_stats(t.climate, t.sites, t.strategy).select(
        "site_id",
        "event_date",
        "source",
        "precipitation_mm",
        "temp_mean",
        F.coalesce("temp_stddev", F.lit(-1.0)).alias("temp_stddev"),
        "total_days",
    )
    return texts(rounded(out, "precipitation_mm", "temp_mean", "temp_stddev"), "event_date")


@query(
    "join_scores_outer",
    f"""{W('scores')} SELECT site_id, {', '.join(
        f"CASE WHEN site_id % 7 = {i} THEN 0 ELSE round({c}, 6) + 0.0 END AS {c}" for i, c in enumerate(SCORES6))} FROM scores""",
)
def join_scores_outer(t):
    frames = [t.scores.where(F.col("site_id") % 7 != i).select("site_id", c) for i, c in enumerate(SCORES)]
    return rounded(merge_scores(frames), *SCORES)


@query(
    "join_site_scores",
    f"""{W('view')} SELECT site_id, whc_id, name, country, {', '.join(
        f"CASE WHEN site_id % 5 = 0 THEN 0 ELSE round({c}, 6) + 0.0 END AS {c}" for c in (*SCORES6, 'composite_risk_score'))},
    CASE WHEN site_id % 5 = 0 THEN 'low' ELSE risk_level END AS risk_level,
    CASE WHEN site_id % 5 = 0 THEN false ELSE is_anomaly END AS is_anomaly FROM view""",
)
def join_site_scores(t):
    view = rp.site_risk_view(t.sites, t.flagged.where(F.col("site_id") % 5 != 0))
    out = view.select("site_id", "whc_id", "name", "country", *SCORES, "composite_risk_score", "risk_level", "is_anomaly")
    return rounded(out, *SCORES, "composite_risk_score")


# three sightings of each fire, up to 160 m apart in longitude
COPIES_SQL = """copies AS (SELECT ord * 3 + c.i AS ord, satellite, acq_date, acq_time, frp,
    lon + c.i * (ord % 6) * 0.0002::DOUBLE AS lon, lat, ord AS fire_id, c.i AS copy FROM fires, (VALUES (0), (1), (2)) c(i))"""


def copies_of(t):
    i = F.col("copy")
    return (
        t.fires.select("*", F.col("ord").alias("fire_id"))
        .withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
        .withColumn("lon", F.col("lon") + i * (F.col("fire_id") % 6) * 0.0002)
        .withColumn("ord", F.col("fire_id") * 3 + i)
        .select("ord", "satellite", "acq_date", "acq_time", "frp", "lon", "lat", "fire_id", "copy")
    )


def _gap(a: str, b: str) -> str:
    """Longitude-only distance between two sightings of one fire, on the sphere."""
    return haversine(f"{a}.lat", f"{a}.lon", f"{b}.lat", f"{b}.lon")


GREEDY_SQL = f"""{COPIES_SQL}, trio AS (SELECT a.fire_id, a.ord AS o0, b.ord AS o1, c.ord AS o2,
      {_gap('a', 'b')} <= 100 AS ab, {_gap('a', 'c')} <= 100 AS ac, {_gap('b', 'c')} <= 100 AS bc
      FROM copies a JOIN copies b ON a.fire_id = b.fire_id AND b.copy = 1 JOIN copies c ON a.fire_id = c.fire_id AND c.copy = 2
      WHERE a.copy = 0)"""


@query(
    "join_anti_near_dup",
    f"""{W('fires')}, {GREEDY_SQL} SELECT o0 AS ord FROM trio UNION ALL SELECT o1 FROM trio WHERE NOT ab
    UNION ALL SELECT o2 FROM trio WHERE NOT ac AND (ab OR NOT bc)""",
)
def join_anti_near_dup(t):
    return drop_near_duplicates(copies_of(t), method="haversine").select("ord")


# id % 4: two squares of which the first has a hole, one square, a closed line, a point
_SHAPES_SQL = """shapes AS (SELECT c_custkey AS id, c_custkey % 4 AS kind, (c_custkey % 9 + 2)::DOUBLE AS a, (c_custkey % 5 + 1)::DOUBLE AS b FROM customer)"""


def _shape_texts(t) -> DataFrame:
    """(id, wkt, geojson) derived from customers; side lengths a and b follow the id, the hole has side 1."""
    k = F.col("c_custkey")
    rows = t.raw("customer").select(k.alias("id"), (k % 4).alias("kind"), (k % 9 + 2).alias("a"), (k % 5 + 1).alias("b"))
    text = F.when(
        F.col("kind") == 0,
        F.format_string("MULTIPOLYGON (((0 0, %1$d 0, %1$d %1$d, 0 %1$d, 0 0), (0.5 0.5, 1.5 0.5, 1.5 1.5, 0.5 1.5, 0.5 0.5)), ((20 0, 20 %2$d, 2%2$d %2$d, 2%2$d 0, 20 0)))", "a", "b"),
    )
    text = text.when(F.col("kind") == 1, F.format_string("POLYGON ((0 0, %1$d 0, %1$d %1$d, 0 %1$d, 0 0))", "a"))
    text = text.when(F.col("kind") == 2, F.format_string("LINESTRING (0 0, %1$d 0, %1$d %1$d, 0 0)", "a"))
    rows = rows.withColumn("wkt", text.otherwise(F.format_string("POINT (%d %d)", "a", "b")))
    # the same shape as GeoJSON
    body = F.translate(F.regexp_replace(F.regexp_extract("wkt", r"(\(.*\))", 1), r"([0-9.]+) ([0-9.]+)", r"[$1, $2]"), "()", "[]")
    body = F.when(F.col("kind") == 3, F.regexp_replace(body, r"^\[|\]$", "")).otherwise(body)
    names = F.array(*[F.lit(n) for n in ("MultiPolygon", "Polygon", "LineString", "Point")])
    name = F.element_at(names, (F.col("kind") + 1).cast("int"))
    return rows.withColumn("geojson", F.concat(F.lit('{"type": "'), name, F.lit('", "coordinates": '), body, F.lit("}")))


@query(
    "sp_shape_area",
    f"""WITH {_SHAPES_SQL}, m AS (SELECT id, CASE kind WHEN 0 THEN a * a - 1 + b * b WHEN 1 THEN a * a ELSE 0 END AS area FROM shapes)
    SELECT id, area::DOUBLE AS wkt_area, area::DOUBLE AS geojson_area FROM m""",
)
def sp_shape_area(t):
    read = _shape_texts(t).select("id", sh.from_wkt(F.col("wkt")).alias("w"), sh.from_geojson(F.col("geojson")).alias("g"))
    measured = read.select("id", sh.shape_area(F.col("w")).alias("wkt_area"), sh.shape_area(F.col("g")).alias("geojson_area"))
    return rounded(measured, "wkt_area", "geojson_area")


@query(
    "sp_shape_centroid",
    f"""WITH {_SHAPES_SQL}, m AS (SELECT id,
      CASE kind WHEN 0 THEN (a * a * a / 2 - 1 + b * b * (20 + b / 2)) / (a * a - 1 + b * b) WHEN 1 THEN a / 2 WHEN 2 THEN a / 2 ELSE a END AS cx,
      CASE kind WHEN 0 THEN (a * a * a / 2 - 1 + b * b * b / 2) / (a * a - 1 + b * b) WHEN 1 THEN a / 2 WHEN 2 THEN a / 4 ELSE b END AS cy FROM shapes)
    SELECT id, {r('cx')}, {r('cy')} FROM m""",
)
def sp_shape_centroid(t):
    read = _shape_texts(t).select("id", sh.from_geojson(F.col("geojson")).alias("g"))
    c = read.select("id", sh.shape_centroid(F.col("g")).alias("c"))
    return rounded(c.select("id", F.col("c.x").alias("cx"), F.col("c.y").alias("cy")), "cx", "cy")


def _links_sql(events: str, key: str, limit: int) -> str:
    return f"""{W('sites', 'quakes', events, 'sites_p')}, {nearest_sql(limit).replace('usgs_id', key).replace('FROM quakes e', f'FROM {events} e')}
    SELECT e.{key}, coalesce(l.site_id, -1)::BIGINT AS nearest_site_id, {r('coalesce(l.distance_km, -1)', 6, 'distance_to_site_km')}
    FROM {events} e LEFT JOIN links l ON e.{key} = l.{key}"""


def _linked(t, events: DataFrame, kind: str, key: str) -> DataFrame:
    """The hazard's whole table after the link step; unlinked events show -1."""
    none = {"nearest_site_id": F.lit(None).cast("bigint"), "distance_to_site_km": F.lit(None).cast("double")}
    out = link_hazard(events.withColumns(none), t.sites, kind, key, strategy=t.strategy)
    out = out.select(key, F.coalesce("nearest_site_id", F.lit(-1)).cast("long").alias("nearest_site_id"), F.coalesce("distance_to_site_km", F.lit(-1.0)).alias("distance_to_site_km"))
    return rounded(out, "distance_to_site_km")


@query("link_fires", _links_sql("fires", "ord", 25000))
def link_fires(t):
    return _linked(t, t.fires, "fire", "ord")


@query("link_floods", _links_sql("floods", "event_id", 50000))
def link_floods(t):
    return _linked(t, t.floods, "flood", "event_id")


# a house-shaped area with a yard, and for every fourth site a second one beside it; in halves of its size
_AREA_RINGS = (((-1, -1), (1, -1), (1, 0.3), (0.1, 1), (-1, 0.4)), ((-0.5, -0.5), (0.4, -0.6), (0.5, 0.2), (-0.4, 0.1)), ((2, -1), (3, 0), (2, 1)))
_AREA_CORNERS_SQL = ", ".join(f"({i}, {k}, {ring[k][0]}::DOUBLE, {ring[k][1]}::DOUBLE, {ring[k - 1][0]}::DOUBLE, {ring[k - 1][1]}::DOUBLE)" for i, ring in enumerate(_AREA_RINGS) for k in range(len(ring)))


def _flood_areas(t) -> DataFrame:
    half = F.col("site_id") % 5 * 0.5 + 0.25371  # so that no event lies on an edge
    lon, lat = F.col("lon"), F.col("lat")

    def ring(corners):
        return F.array(*[F.struct((lon + half * x).alias("x"), (lat + half * y).alias("y")) for x, y in (*corners, corners[0])])

    house, wing = F.array(ring(_AREA_RINGS[0]), ring(_AREA_RINGS[1])), F.array(ring(_AREA_RINGS[2]))
    several = F.col("site_id") % 4 == 0
    polygons = F.when(several, F.array(house, wing)).otherwise(F.array(house))
    shape = F.struct(F.when(several, "MULTIPOLYGON").otherwise("POLYGON").alias("kind"), polygons.alias("polygons"))
    return t.sites.select(F.col("site_id").alias("area_id"), shape.alias("shape"))


@query(
    "join_points_in_areas",
    f"""{W('sites', 'hazards')}, edges AS (SELECT site_id, lon + h * ax AS ax, lat + h * ay AS ay, lon + h * bx AS bx, lat + h * byy AS byy
      FROM (SELECT site_id, lon, lat, site_id % 5 * 0.5::DOUBLE + 0.25371::DOUBLE AS h FROM sites) s, (VALUES {_AREA_CORNERS_SQL}) c(ring, k, ax, ay, bx, byy)
      WHERE ring < 2 OR site_id % 4 = 0)
    SELECT e.event_id, a.site_id AS area_id FROM hazards e, edges a
    WHERE (a.ay > e.lat) <> (a.byy > e.lat) AND e.lon < a.ax + (e.lat - a.ay) * (a.bx - a.ax) / nullif(a.byy - a.ay, 0)
    GROUP BY e.event_id, a.site_id HAVING count(*) % 2 = 1""",
)
def join_points_in_areas(t):
    """Events inside flood areas."""
    return points_in_areas(t.hazards.select("event_id", "lon", "lat"), _flood_areas(t)).select("event_id", "area_id")
