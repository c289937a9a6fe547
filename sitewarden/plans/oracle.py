"""Plain SQL building blocks: the domain tables and results, written independently of the library."""

from __future__ import annotations

import math

_F = 1 / 298.257222101
_E2 = _F * (2 - _F)
_E = math.sqrt(_E2)


def _q(s: float) -> float:
    return (1 - _E2) * (s / (1 - _E2 * s * s) - math.log((1 - _E * s) / (1 + _E * s)) / (2 * _E))


_QP = _q(1.0)
_S0 = math.sin(math.radians(52.0))
_SB0 = _q(_S0) / _QP
_CB0 = math.sqrt(1 - _SB0 * _SB0)
_RQ = 6378137.0 * math.sqrt(_QP / 2)
_DD = 6378137.0 * math.cos(math.radians(52.0)) / math.sqrt(1 - _E2 * _S0 * _S0) / (_RQ * _CB0)


def laea(src: str) -> str:
    """Relation `src` with lon, lat -> the same with x, y in EPSG:3035."""
    return f"""(SELECT * EXCLUDE (s_, q_, sb_, cb_, dl_, b_),
        4321000.0::DOUBLE + b_ * {_DD!r}::DOUBLE * cb_ * sin(dl_) AS x,
        3210000.0::DOUBLE + b_ / {_DD!r}::DOUBLE * ({_CB0!r}::DOUBLE * sb_ - {_SB0!r}::DOUBLE * cb_ * cos(dl_)) AS y
      FROM (SELECT *, {_RQ!r}::DOUBLE * sqrt(2 / (1 + {_SB0!r}::DOUBLE * sb_ + {_CB0!r}::DOUBLE * cb_ * cos(dl_))) AS b_
      FROM (SELECT *, sqrt(1 - sb_ * sb_) AS cb_, radians(lon - 10) AS dl_
      FROM (SELECT *, q_ / {_QP!r}::DOUBLE AS sb_
      FROM (SELECT *, {1 - _E2!r}::DOUBLE * (s_ / (1 - {_E2!r}::DOUBLE * s_ * s_)
            - ln((1 - {_E!r}::DOUBLE * s_) / (1 + {_E!r}::DOUBLE * s_)) / {2 * _E!r}::DOUBLE) AS q_
      FROM (SELECT *, sin(radians(lat)) AS s_ FROM {src}))))))"""


_WF = 1 / 298.257223563


def lambert(src: str) -> str:
    """Relation with lat, lon, site_lat, site_lon -> the same with distance_m on the WGS84 spheroid."""
    return f"""(SELECT * EXCLUDE (b1_, b2_, g_),
        CASE WHEN g_ = 0 THEN 0::DOUBLE ELSE 6378137.0::DOUBLE * (g_ - {_WF / 2!r}::DOUBLE * (
          (g_ - sin(g_)) * power(sin((b1_ + b2_) / 2), 2) * power(cos((b2_ - b1_) / 2), 2) / power(cos(g_ / 2), 2)
        + (g_ + sin(g_)) * power(cos((b1_ + b2_) / 2), 2) * power(sin((b2_ - b1_) / 2), 2) / power(sin(g_ / 2), 2)))
        END AS distance_m
      FROM (SELECT *, 2 * asin(sqrt(least(1.0::DOUBLE, power(sin((b2_ - b1_) / 2), 2)
          + cos(b1_) * cos(b2_) * power(sin(radians(site_lon - lon) / 2), 2)))) AS g_
      FROM (SELECT *, atan({1 - _WF!r}::DOUBLE * tan(radians(lat))) AS b1_,
            atan({1 - _WF!r}::DOUBLE * tan(radians(site_lat))) AS b2_ FROM {src})))"""


def haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        f"6371008.8::DOUBLE * 2 * asin(sqrt(least(1.0::DOUBLE, power(sin(radians({lat2} - {lat1}) / 2), 2) + "
        f"cos(radians({lat1})) * cos(radians({lat2})) * power(sin(radians({lon2} - {lon1}) / 2), 2))))"
    )


def _place(k: str) -> str:
    return (
        f"CAST(({k} * 104729) % 36000 AS DOUBLE) / 100::DOUBLE - 180 AS lon, "
        f"CAST(({k} * 7919) % 14001 AS DOUBLE) / 100::DOUBLE - 70 AS lat"
    )


def _pairs(events: str, radius: int) -> str:
    cross = f"(SELECT e.*, s.site_id, s.lon AS site_lon, s.lat AS site_lat FROM {events} e, sites s)"
    return f"SELECT * FROM {lambert(cross)} WHERE distance_m <= {radius}"


def coastal(elevation: str) -> str:
    return (
        f"CASE WHEN {elevation} IS NULL THEN 0::DOUBLE WHEN {elevation} < 0 THEN 1::DOUBLE "
        f"ELSE round(greatest(0::DOUBLE, 1 - {elevation} / 10::DOUBLE), 4) END"
    )


def level(score: str) -> str:
    return (
        f"CASE WHEN {score} < 0 OR {score} > 1 THEN NULL WHEN {score} <= 0.25 THEN 'low' "
        f"WHEN {score} <= 0.5 THEN 'medium' WHEN {score} <= 0.75 THEN 'high' WHEN {score} <= 1 THEN 'critical' END"
    )


def _scaled(raw: str, out: str) -> str:
    top, low = f"max({raw}) OVER ()", f"min({raw}) OVER ()"
    return (
        f"CASE WHEN {top} = 0 OR {top} = {low} THEN 0::DOUBLE ELSE "
        f"(ln(1 + {raw}) - ln(1 + {low})) / (ln(1 + {top}) - ln(1 + {low})) END AS {out}"
    )


SCORES6 = [
    "urban_density_score",
    "climate_anomaly_score",
    "seismic_risk_score",
    "fire_risk_score",
    "flood_risk_score",
    "coastal_risk_score",
]

_ISO = "list_value('IT', 'BR', 'FR', 'CN', 'GR', 'US', 'TR')"

_TREES, _SAMPLE, _DEPTH, _SEED = 200, 256, 8, 42


def _forest() -> dict[str, tuple[list[str], str]]:
    """An isolation forest level by level: every site walks down every tree, the members of its sample set the cuts."""
    columns = ["urban_density_score", "climate_anomaly_score", "seismic_risk_score", "fire_risk_score", "flood_risk_score", "coastal_risk_score"]
    xs = [f"x{i}" for i in range(len(columns))]

    def draw(text: str) -> str:
        return f"(('0x' || substr(md5({text}), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE)"

    def mean_path(n: str) -> str:
        return f"CASE WHEN {n} <= 1 THEN 0::DOUBLE WHEN {n} = 2 THEN 1::DOUBLE ELSE 2 * (ln({n} - 1) + 0.5772156649015329::DOUBLE) - 2 * ({n} - 1)::DOUBLE / {n} END"

    blocks = {
        "forest_rows": (["scores"], f"SELECT site_id, {', '.join(f'round(coalesce({c}, 0), 9) AS {x}' for c, x in zip(columns, xs, strict=True))} FROM scores"),
        "forest_size": (
            ["forest_rows"],
            f"""SELECT psi, share, least(1::DOUBLE, {_TREES} * share) AS any_share, ceil(log2(greatest(psi, 2))) AS depth FROM (
            SELECT least({_SAMPLE}, count(*)) AS psi, least(1::DOUBLE, 3::DOUBLE * least({_SAMPLE}, count(*)) / greatest(count(*), 1)) AS share FROM forest_rows)""",
        ),
        "forest_l0": (
            ["forest_rows", "forest_size"],
            f"""SELECT tree, 1 AS node, site_id, drawn AND row_number() OVER (PARTITION BY tree, drawn ORDER BY u, site_id) <= psi AS member, {', '.join(xs)} FROM (
            SELECT *, u <= share / any_share AND {draw(f"'{_SEED}|any|' || site_id")} < any_share AS drawn FROM (
            SELECT f.*, t.tree, z.*, {draw(f"'{_SEED}|' || t.tree || '|' || site_id")} AS u FROM forest_rows f, range({_TREES}) t(tree), forest_size z))""",
        ),
    }
    for d in range(_DEPTH + 1):
        lows, highs = (", ".join(f"{fn}({x}) FILTER (WHERE member)" for x in xs) for fn in ("min", "max"))
        blocks[f"forest_n{d}"] = ([f"forest_l{d}"], f"SELECT tree, node, count(*) FILTER (WHERE member) AS m, [{lows}] AS lows, [{highs}] AS highs FROM forest_l{d} GROUP BY tree, node")
        blocks[f"forest_c{d}"] = (
            [f"forest_n{d}", "forest_size"],
            f"""SELECT tree, node, f, low + {draw(f"'{_SEED}|' || tree || '|' || node || '|cut'")} * (high - low) AS cut FROM (
            SELECT tree, node, arg_min(f, h) AS f, arg_min(low, h) AS low, arg_min(high, h) AS high FROM (
            SELECT *, md5('{_SEED}|' || tree || '|' || node || '|feature|' || f) AS h FROM (
            SELECT tree, node, unnest(range({len(xs)})) AS f, unnest(lows) AS low, unnest(highs) AS high FROM forest_n{d}) WHERE high > low AND {d} < (SELECT depth FROM forest_size))
            GROUP BY tree, node)""",
        )
        if d < _DEPTH:
            x_of = "CASE f " + " ".join(f"WHEN {i} THEN {x}" for i, x in enumerate(xs)) + " END"
            blocks[f"forest_l{d + 1}"] = (
                [f"forest_l{d}", f"forest_c{d}"],
                f"SELECT tree, 2 * node + CASE WHEN {x_of} > cut THEN 1 ELSE 0 END AS node, site_id, member, {', '.join(xs)} FROM forest_l{d} JOIN forest_c{d} USING (tree, node)",
            )
    leaves = " UNION ALL ".join(
        f"SELECT site_id, {d} + {mean_path('m')} AS path FROM forest_l{d} JOIN forest_n{d} USING (tree, node) ANTI JOIN forest_c{d} USING (tree, node)" for d in range(_DEPTH + 1)
    )
    blocks["forest_raw"] = (
        [f"forest_{k}{d}" for d in range(_DEPTH + 1) for k in "lnc"],
        f"""SELECT site_id, round(CASE WHEN norm > 0 THEN -power(2, -(sum(path) / {_TREES}) / norm) ELSE -0.5 END, 12) AS raw
        FROM ({leaves}), (SELECT {mean_path('psi')} AS norm FROM forest_size) GROUP BY site_id, norm""",
    )
    blocks["forest"] = (
        ["forest_raw"],
        """SELECT site_id, score AS isolation_forest_score, score < 0 AS is_anomaly FROM (
        SELECT site_id, round(raw - (SELECT quantile_cont(raw, 0.1) FROM forest_raw), 12) AS score FROM forest_raw)""",
    )
    return blocks


# name -> (dependencies, body)
CTES: dict[str, tuple[list[str], str]] = {
    "sites": (
        [],
        f"""SELECT s_suppkey AS site_id, CAST(s_suppkey + 1000 AS INTEGER) AS whc_id, s_name AS name,
        CASE s_suppkey % 3 WHEN 0 THEN 'Cultural' WHEN 1 THEN 'Natural' ELSE 'Mixed' END AS category,
        CAST(1978 + s_suppkey % 45 AS INTEGER) AS date_inscribed, n_name AS country,
        CASE WHEN s_suppkey % 5 = 0 THEN {_ISO}[s_suppkey % 7 + 1] || ', ' || {_ISO}[(s_suppkey + 3) % 7 + 1]
             ELSE {_ISO}[s_suppkey % 7 + 1] END AS iso_code,
        r_name AS region, s_suppkey % 20 = 0 AS in_danger, s_acctbal AS area_hectares, {_place('s_suppkey')},
        CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE CAST((s_suppkey * 37) % 120 - 10 AS DOUBLE) END AS elevation_m
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    ),
    "hazards": (
        [],
        """SELECT event_id, ts, event_type, value,
        CAST((event_id % 200 * 104729) % 36000 AS DOUBLE) / 100::DOUBLE - 180
          + CAST((event_id * 17) % 601 - 300 AS DOUBLE) / 100::DOUBLE AS lon,
        CAST((event_id % 200 * 7919) % 14001 AS DOUBLE) / 100::DOUBLE - 70
          + CAST((event_id * 31) % 601 - 300 AS DOUBLE) / 100::DOUBLE AS lat FROM events""",
    ),
    "quakes": (
        ["hazards"],
        """SELECT event_id, 'ev' || event_id AS usgs_id, 3 + CAST(event_id % 50 AS DOUBLE) / 10::DOUBLE AS magnitude,
        CAST(event_id % 700 AS DOUBLE) / 10::DOUBLE AS depth_km,
        (event_id % 90) || ' km N of ' || list_value('Turkey', 'Italy', 'Greece', 'Chile')[event_id % 4 + 1] AS place_desc,
        ts AS event_time, lon, lat FROM hazards""",
    ),
    "fires": (
        ["hazards"],
        """SELECT event_id AS ord, 'SAT' || (event_id % 3) AS satellite,
        CASE WHEN event_id % 97 = 0 THEN NULL ELSE value END AS frp,
        CAST((event_id * 13) % 101 AS INTEGER) AS confidence, CAST(ts AS DATE) AS acq_date,
        CAST(hour(ts) * 60 + minute(ts) AS INTEGER) AS acq_time,
        CASE WHEN hour(ts) BETWEEN 6 AND 17 THEN 'D' ELSE 'N' END AS day_night, lon, lat FROM hazards""",
    ),
    "floods": (
        ["hazards"],
        """SELECT CAST(ts AS DATE) AS event_date, CAST(event_id % 100 AS DOUBLE) / 100::DOUBLE AS flood_intensity,
        event_id, lon, lat FROM hazards WHERE event_type = 'error'""",
    ),
    "climate": (
        [],
        """SELECT l_suppkey AS site_id, CAST(l_shipdate AS DATE) AS event_date,
        CASE WHEN l_linenumber % 2 = 1 THEN 'open_meteo' ELSE 'nasa_power' END AS source,
        max(CASE WHEN l_linenumber % 2 = 1 THEN 40 * power(l_quantity / 50, 6) END) AS temp_max_c,
        max(50 * power(l_extendedprice / 100000, 8)) AS precipitation_mm
        FROM lineitem GROUP BY 1, 2, 3""",
    ),
    "urban0": (
        [],
        """SELECT *, half_lat / cos(radians(lat)) AS half_lon FROM (
        SELECT c_custkey AS id, c_custkey * 10 AS osm_id, c_name AS name, c_mktsegment,
        CASE WHEN c_mktsegment IN ('BUILDING', 'HOUSEHOLD', 'MACHINERY') THEN 'building' ELSE 'landuse' END AS feature_type,
        c_custkey % 100 AS nearest_site_id,
        CAST((c_custkey % 100 * 104729) % 36000 AS DOUBLE) / 100::DOUBLE - 180
          + CAST((c_custkey * 7) % 201 - 100 AS DOUBLE) / 1000::DOUBLE AS lon,
        CAST((c_custkey % 100 * 7919) % 14001 AS DOUBLE) / 100::DOUBLE - 70
          + CAST((c_custkey * 13) % 201 - 100 AS DOUBLE) / 1000::DOUBLE AS lat,
        CAST(10 + c_custkey % 40 AS DOUBLE) / 2::DOUBLE / 111320::DOUBLE AS half_lat FROM customer)""",
    ),
    "vertices": (
        ["urban0"],
        "SELECT * FROM "
        + laea(
            """(SELECT u.id, u.nearest_site_id, c.i, u.lon + c.sx * u.half_lon AS lon, u.lat + c.sy * u.half_lat AS lat
            FROM urban0 u, (VALUES (0, -1, -1), (1, 1, -1), (2, 1, 1), (3, -1, 1)) c(i, sx, sy) WHERE feature_type = 'building'
            UNION ALL SELECT id, nearest_site_id, 0, lon, lat FROM urban0 WHERE feature_type <> 'building')"""
        ),
    ),
    "edges": (
        ["vertices"],
        """SELECT a.id, a.nearest_site_id, a.x AS ax, a.y AS ay, b.x AS bx, b.y AS by_
        FROM vertices a JOIN vertices b ON a.id = b.id AND b.i = (a.i + 1) % 4""",
    ),
    "areas": (
        ["edges", "vertices"],
        """SELECT e.id, abs(sum((e.ax - o.x) * (e.by_ - o.y) - (e.bx - o.x) * (e.ay - o.y))) / 2 AS area_m2
        FROM edges e JOIN vertices o ON e.id = o.id AND o.i = 0 GROUP BY e.id""",
    ),
    "corners": (
        ["urban0"],
        "SELECT * FROM "
        + laea(
            """(SELECT u.id, p.part, p.sign, c.i, u.lon + (c.sx * p.size + p.east) * u.half_lon AS lon, u.lat + c.sy * p.size * u.half_lat AS lat
            FROM urban0 u, (VALUES (0, -1, -1), (1, 1, -1), (2, 1, 1), (3, -1, 1)) c(i, sx, sy),
              (VALUES (0, 1, 1::DOUBLE, 0), (1, -1, 0.5::DOUBLE, 0), (2, 1, 1::DOUBLE, 4)) p(part, sign, size, east)
            WHERE feature_type = 'building' AND (p.part = 0 OR (p.part = 1 AND u.id % 7 = 0) OR (p.part = 2 AND u.id % 5 = 0)))"""
        ),
    ),
    "shape_areas": (
        ["corners"],
        "SELECT id, sum(sign * abs(twice)) / 2 AS area_m2 FROM (SELECT a.id, a.part, min(a.sign) AS sign, "
        "sum((a.x - o.x) * (b.y - o.y) - (b.x - o.x) * (a.y - o.y)) AS twice FROM corners a "
        "JOIN corners b ON a.id = b.id AND a.part = b.part AND b.i = (a.i + 1) % 4 "
        "JOIN corners o ON a.id = o.id AND a.part = o.part AND o.i = 0 GROUP BY a.id, a.part) GROUP BY id",
    ),
    "sites_p": (["sites"], "SELECT * FROM " + laea("(SELECT site_id, lon, lat FROM sites)")),
    "distances": (
        ["edges", "vertices", "sites_p", "urban0"],
        """SELECT id, CASE WHEN sum(hit) % 2 = 1 THEN 0::DOUBLE ELSE min(d) END AS distance_m FROM (
          SELECT e.id, CASE WHEN (ay > y) <> (by_ > y) AND x < ax + (y - ay) * (bx - ax) / nullif(by_ - ay, 0)
            THEN 1 ELSE 0 END AS hit,
          sqrt(power(x - (ax + t * (bx - ax)), 2) + power(y - (ay + t * (by_ - ay)), 2)) AS d
          FROM (SELECT e.*, s.x, s.y, greatest(0::DOUBLE, least(1::DOUBLE,
              ((s.x - ax) * (bx - ax) + (s.y - ay) * (by_ - ay)) / (power(bx - ax, 2) + power(by_ - ay, 2)))) AS t
            FROM edges e JOIN sites_p s ON e.nearest_site_id = s.site_id) e) GROUP BY id
        UNION ALL SELECT v.id, sqrt(power(v.x - s.x, 2) + power(v.y - s.y, 2)) FROM vertices v
          JOIN urban0 u ON u.id = v.id AND u.feature_type <> 'building' JOIN sites_p s ON v.nearest_site_id = s.site_id""",
    ),
    "urban": (
        ["urban0", "distances", "shape_areas"],
        """SELECT u.*, d.distance_m AS distance_to_site_m, coalesce(a.area_m2, 0) AS area_m2
        FROM urban0 u LEFT JOIN distances d ON u.id = d.id LEFT JOIN shape_areas a ON u.id = a.id""",
    ),
    "quake_pairs": (["quakes", "sites"], _pairs("quakes", 200000)),
    "fire_pairs": (["fires", "sites"], _pairs("fires", 100000)),
    "flood_pairs": (["floods", "sites"], _pairs("floods", 100000)),
    "urban_density": (
        ["sites", "urban"],
        """SELECT s.site_id, count(u.id) AS building_count,
        coalesce(sum(CASE WHEN u.feature_type = 'building' THEN u.area_m2 ELSE 0 END), 0) AS total_area_m2,
        count(u.id) + coalesce(sum(CASE WHEN u.feature_type = 'building' THEN u.area_m2 ELSE 0 END), 0) / 1e6 AS urban_density_raw
        FROM sites s LEFT JOIN urban u ON u.nearest_site_id = s.site_id AND u.distance_to_site_m <= 10000 GROUP BY s.site_id""",
    ),
    "climate_stats": (
        ["climate"],
        """SELECT site_id, avg(temp_max_c) AS tm, stddev_samp(temp_max_c) AS ts, avg(precipitation_mm) AS pm,
        stddev_samp(precipitation_mm) AS ps, count(*) AS total_days FROM climate
        WHERE temp_max_c IS NOT NULL AND precipitation_mm IS NOT NULL GROUP BY site_id""",
    ),
    "climate_extremes": (
        ["sites", "climate", "climate_stats"],
        """SELECT s.site_id, coalesce(x.n, 0) AS extreme_days, coalesce(t.total_days, 0) AS total_days,
        CASE WHEN t.total_days > 0 THEN CAST(coalesce(x.n, 0) AS DOUBLE) / t.total_days ELSE 0::DOUBLE END AS anomaly_ratio
        FROM sites s LEFT JOIN climate_stats t ON s.site_id = t.site_id LEFT JOIN (
          SELECT c.site_id, count(*) AS n FROM climate c JOIN climate_stats t ON c.site_id = t.site_id
          WHERE c.temp_max_c > t.tm + 2 * t.ts OR c.precipitation_mm > t.pm + 3 * t.ps GROUP BY c.site_id
        ) x ON s.site_id = x.site_id""",
    ),
    "seismic": (
        ["sites", "quake_pairs"],
        """SELECT s.site_id, count(p.usgs_id) AS earthquake_count,
        coalesce(sum(power(10, 1.5 * p.magnitude) / power(greatest(p.distance_m / 1000, 0.1), 2)), 0) AS total_energy
        FROM sites s LEFT JOIN quake_pairs p ON s.site_id = p.site_id GROUP BY s.site_id""",
    ),
    "fire": (
        ["sites", "fire_pairs"],
        """SELECT s.site_id, count(p.ord) AS fire_count,
        coalesce(sum(p.frp * (p.confidence / 100::DOUBLE) / greatest(p.distance_m / 1000, 0.1)), 0) AS total_fire_risk
        FROM sites s LEFT JOIN fire_pairs p ON s.site_id = p.site_id GROUP BY s.site_id""",
    ),
    "flood": (
        ["sites", "flood_pairs"],
        """SELECT s.site_id, count(p.event_id) AS flood_count, coalesce(avg(p.flood_intensity), 0) AS avg_severity,
        count(p.event_id) * 0.5::DOUBLE + coalesce(avg(p.flood_intensity), 0) * 0.5::DOUBLE AS flood_risk_raw
        FROM sites s LEFT JOIN flood_pairs p ON s.site_id = p.site_id GROUP BY s.site_id""",
    ),
    "subscores": (
        ["sites", "urban_density", "climate_extremes", "seismic", "fire", "flood"],
        f"""SELECT s.site_id, {_scaled('u.urban_density_raw', 'urban_density_score')},
        {_scaled('c.anomaly_ratio', 'climate_anomaly_score')}, {_scaled('q.total_energy', 'seismic_risk_score')},
        {_scaled('f.total_fire_risk', 'fire_risk_score')}, {_scaled('w.flood_risk_raw', 'flood_risk_score')},
        {coastal('s.elevation_m')} AS coastal_risk_score
        FROM sites s JOIN urban_density u ON u.site_id = s.site_id JOIN climate_extremes c ON c.site_id = s.site_id
        JOIN seismic q ON q.site_id = s.site_id JOIN fire f ON f.site_id = s.site_id JOIN flood w ON w.site_id = s.site_id""",
    ),
    "scores": (
        ["subscores"],
        f"""SELECT *, {level('composite_risk_score')} AS risk_level FROM (SELECT *, least(1::DOUBLE, greatest(0::DOUBLE,
        urban_density_score * 0.25::DOUBLE + climate_anomaly_score * 0.2::DOUBLE + seismic_risk_score * 0.2::DOUBLE
        + fire_risk_score * 0.15::DOUBLE + flood_risk_score * 0.1::DOUBLE + coastal_risk_score * 0.1::DOUBLE))
        AS composite_risk_score FROM subscores)""",
    ),
    **_forest(),
    "flagged": (
        ["scores", "forest"],
        """SELECT s.*, isolation_forest_score, is_anomaly FROM scores s JOIN forest f ON s.site_id = f.site_id""",
    ),
    "view": (
        ["sites", "flagged"],
        f"""SELECT s.* EXCLUDE (site_id), f.* FROM sites s JOIN flagged f ON s.site_id = f.site_id""",
    ),
}


def with_ctes(*names: str) -> str:
    """WITH clause holding the named blocks and what they need."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for needed in CTES[name][0]:
            visit(needed)
        ordered.append(name)

    for name in names:
        visit(name)
    return "WITH " + ", ".join(f"{n} AS MATERIALIZED ({CTES[n][1]})" for n in ordered)


def r(column: str, digits: int = 6, alias: str | None = None) -> str:
    """Rounded output column."""
    return f"round({column}, {digits}) + 0.0 AS {alias or column.split('.')[-1]}"


SCORES_ROUNDED = ", ".join(r(c) for c in SCORES6)
