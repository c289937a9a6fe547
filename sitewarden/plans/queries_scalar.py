"""Filters, validation and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from sitewarden.functions import scalars as fn
from sitewarden.operators import filters as fl
from sitewarden.operators import quality as ql
from sitewarden.plans.linking import link_hazard
from sitewarden.plans.oracle import coastal, laea, level, r, with_ctes
from sitewarden.plans.registry import SCORES, query, rounded, texts

W = with_ctes

_BBOX = (-40.0, 60.0, -100.0, 120.0)


@query(
    "flt_bbox_mag_time",
    f"""{W('quakes')} SELECT usgs_id, {r('magnitude')}, {r('lon')}, {r('lat')},
    strftime(event_time, '%Y-%m-%d %H:%M:%S') AS event_time FROM quakes
    WHERE lat BETWEEN -40 AND 60 AND lon BETWEEN -100 AND 120 AND magnitude >= 5
      AND event_time BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-25 12:00:00'""",
)
def flt_bbox_mag_time(t):
    df = fl.filter_quakes(t.quakes, _BBOX, 5.0, "2024-01-05 00:00:00", "2024-01-25 12:00:00")
    df = df.select("usgs_id", "magnitude", "lon", "lat", "event_time")
    return texts(rounded(df, "magnitude", "lon", "lat"), "event_time", fmt="yyyy-MM-dd HH:mm:ss")


@query(
    "flt_days_window",
    f"""{W('fires')} SELECT ord, satellite, strftime(acq_date, '%Y-%m-%d') AS acq_date FROM fires
    WHERE acq_date > (SELECT max(acq_date) FROM fires) - 15""",
)
def flt_days_window(t):
    return texts(fl.last_n_days(t.fires, 15).select("ord", "satellite", "acq_date"), "acq_date")


_WANTED = ("FR", "VA")
_CODES = "list_value(" + ", ".join(f"'{c}'" for c in _WANTED) + ")"


@query(
    "flt_iso_overlap",
    f"""{W('sites')} SELECT site_id, iso_code FROM sites
    WHERE list_has_any(string_split(iso_code, ', '), {_CODES})""",
)
def flt_iso_overlap(t):
    return fl.filter_sites_by_iso(t.sites, _WANTED).select("site_id", "iso_code")


_COPIES = """records AS (SELECT whc_id, site_id AS ord, lon, CASE WHEN site_id % 10 = 1 THEN 95::DOUBLE ELSE lat END AS lat,
    CASE WHEN site_id % 13 = 2 THEN 'Ruins' ELSE category END AS category FROM sites
    UNION ALL SELECT whc_id, 1000000000 + site_id, lon, lat, category FROM sites WHERE site_id % 4 = 1)"""


def _copies(t):
    k = F.col("site_id")
    base = t.sites.select(
        "whc_id",
        k.alias("ord"),
        "lon",
        F.when(k % 10 == 1, 95.0).otherwise(F.col("lat")).alias("lat"),
        F.when(k % 13 == 2, "Ruins").otherwise(F.col("category")).alias("category"),
    )
    again = t.sites.where(k % 4 == 1).select("whc_id", (k + 1000000000).alias("ord"), "lon", "lat", "category")
    return base.unionByName(again)


@query(
    "val_sites",
    f"""{W('sites')}, {_COPIES},
    ranked AS (SELECT *, row_number() OVER (PARTITION BY whc_id ORDER BY ord) AS rn,
      lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180 AS ok FROM records)
    SELECT 'valid' AS issue, whc_id, CAST(1 AS BIGINT) AS records FROM ranked WHERE rn = 1 AND ok
    UNION ALL SELECT 'duplicate_whc_id', whc_id, count(*) - 1 FROM ranked GROUP BY whc_id HAVING count(*) > 1
    UNION ALL SELECT 'invalid_geometry', whc_id, count(*) FROM ranked WHERE NOT ok GROUP BY whc_id
    UNION ALL SELECT 'invalid_category', whc_id, count(*) FROM ranked
      WHERE category NOT IN ('Cultural', 'Natural', 'Mixed') GROUP BY whc_id
    UNION ALL SELECT 'total', -1, count(*) FROM ranked
    UNION ALL SELECT 'rejected', -1, count(*) - count(CASE WHEN rn = 1 AND ok THEN 1 END) FROM ranked""",
)
def val_sites(t):
    records = _copies(t)
    valid, offenders = ql.validate_sites(records)
    kept = valid.select(F.lit("valid").alias("issue"), "whc_id", F.lit(1).cast("long").alias("records"))
    report = ql.site_report(records).select(
        F.inline(
            F.array(
                F.struct(F.lit("total").alias("issue"), F.col("total_records").alias("records")),
                F.struct(F.lit("rejected").alias("issue"), F.col("invalid_records").alias("records")),
            )
        )
    )
    totals = report.select("issue", F.lit(-1).alias("whc_id"), "records")
    return kept.unionByName(offenders).unionByName(totals)


_BINS = ", ".join(
    f"count(CASE WHEN magnitude > {a} AND magnitude <= {b} THEN 1 END) AS mag_{a}_{b}"
    for a, b in ((0, 3), (3, 4), (4, 5), (5, 6), (6, 7), (7, 10))
)


@query(
    "val_quakes",
    f"""{W('quakes')}, q AS (SELECT *, CASE WHEN event_id % 50 = 7 THEN -depth_km ELSE depth_km END AS depth,
      CASE WHEN event_id % 40 = 3 THEN NULL ELSE lon END AS x FROM quakes)
    SELECT count(*) AS events, {r('min(magnitude)', alias='min_magnitude')}, {r('max(magnitude)', alias='max_magnitude')},
    count(CASE WHEN depth < 0 THEN 1 END) AS negative_depth, count(CASE WHEN x IS NULL OR lat IS NULL THEN 1 END) AS empty_geometry,
    strftime(min(event_time), '%Y-%m-%d %H:%M:%S') AS first_event, strftime(max(event_time), '%Y-%m-%d %H:%M:%S') AS last_event,
    {_BINS} FROM q""",
)
def val_quakes(t):
    e = F.substring("usgs_id", 3, 20).cast("long")
    df = t.quakes.withColumns(
        {
            "depth_km": F.when(e % 50 == 7, -F.col("depth_km")).otherwise(F.col("depth_km")),
            "lon": F.when(e % 40 != 3, F.col("lon")),
        }
    )
    out = rounded(ql.profile_quakes(df), "min_magnitude", "max_magnitude")
    return texts(out, "first_event", "last_event", fmt="yyyy-MM-dd HH:mm:ss")


@query(
    "val_known_events",
    f"""{W('quakes')} SELECT
    count(CASE WHEN year(event_time) = 2024 AND magnitude >= 7.5 AND lower(place_desc) LIKE '%turkey%' THEN 1 END) AS turkey_large,
    count(CASE WHEN lower(place_desc) LIKE '%italy%' THEN 1 END) AS italy_events,
    count(CASE WHEN lower(place_desc) LIKE '%greece%' THEN 1 END) AS greece_events FROM quakes""",
)
def val_known_events(t):
    found = ql.find_events(t.quakes, 2024, 7.5, "Turkey").agg(F.count(F.lit(1)).alias("n")).scalar()
    return ql.count_mentions(t.quakes, ["Italy", "Greece"]).withColumn("turkey_large", found)


@query(
    "val_date_gaps",
    f"""{W('climate')}, g AS (SELECT site_id, source, event_date,
      event_date - lag(event_date) OVER (PARTITION BY site_id, source ORDER BY event_date) AS gap FROM climate)
    SELECT site_id, source, count(*) AS total_records, strftime(min(event_date), '%Y-%m-%d') AS start_date,
    strftime(max(event_date), '%Y-%m-%d') AS end_date, count(CASE WHEN gap > 7 THEN 1 END) AS num_large_gaps,
    CAST(coalesce(max(gap), 0) AS BIGINT) AS largest_gap_days FROM g GROUP BY site_id, source""",
)
def val_date_gaps(t):
    return texts(ql.date_gap_report(t.climate), "start_date", "end_date")


_SCORE_DOMAINS = [*SCORES, "composite_risk_score"]
_SCORE_RULES_SQL = " UNION ALL ".join(
    f"SELECT 'risk_scores' AS tab, '{c}_domain' AS rule, count(CASE WHEN {c} < 0 OR {c} > 1 THEN 1 END) AS violations FROM x" for c in _SCORE_DOMAINS
)


@query(
    "val_constraints",
    f"""{W('sites', 'climate', 'quakes', 'fires', 'scores')}, x AS (SELECT * EXCLUDE (risk_level, fire_risk_score),
      CASE WHEN site_id % 6 = 1 THEN 'severe' ELSE risk_level END AS risk_level, CASE WHEN site_id % 10 = 3 THEN 1.5::DOUBLE ELSE fire_risk_score END AS fire_risk_score FROM scores), s AS (SELECT CASE WHEN site_id % 9 = 4 THEN whc_id - 1 ELSE whc_id END AS whc_id,
      CASE WHEN site_id % 8 = 3 THEN NULL ELSE name END AS name,
      CASE WHEN site_id % 13 = 2 THEN 'Ruins' ELSE category END AS category FROM sites)
    SELECT 'sites' AS tab, 'whc_id_not_null' AS rule, count(CASE WHEN whc_id IS NULL THEN 1 END) AS violations FROM s
    UNION ALL SELECT 'sites', 'name_not_null', count(CASE WHEN name IS NULL THEN 1 END) FROM s
    UNION ALL SELECT 'sites', 'category_domain', count(CASE WHEN category NOT IN ('Cultural', 'Natural', 'Mixed') THEN 1 END) FROM s
    UNION ALL SELECT 'sites', 'whc_id_unique', CAST(count(*) - count(DISTINCT whc_id) AS BIGINT) FROM s
    UNION ALL SELECT 'climate_events', 'event_date_not_null', count(CASE WHEN event_date IS NULL THEN 1 END) FROM climate
    UNION ALL SELECT 'climate_events', 'source_domain', count(CASE WHEN source NOT IN ('open_meteo', 'nasa_power') THEN 1 END) FROM climate
    UNION ALL SELECT 'climate_events', 'site_id_event_date_source_unique', CAST(count(*) - count(DISTINCT (site_id, event_date, source)) AS BIGINT) FROM climate
    UNION ALL SELECT 'earthquake_events', 'usgs_id_not_null', count(CASE WHEN usgs_id IS NULL THEN 1 END) FROM quakes
    UNION ALL SELECT 'earthquake_events', 'magnitude_not_null', count(CASE WHEN magnitude IS NULL OR magnitude > 7.5 THEN 1 END) FROM quakes
    UNION ALL SELECT 'earthquake_events', 'event_time_not_null', count(CASE WHEN event_time IS NULL THEN 1 END) FROM quakes
    UNION ALL SELECT 'earthquake_events', 'usgs_id_unique', CAST(count(*) - count(DISTINCT usgs_id) AS BIGINT) FROM quakes
    UNION ALL SELECT 'fire_events', 'acq_date_not_null', count(CASE WHEN ord % 50 = 7 THEN 1 END) FROM fires
    UNION ALL {_SCORE_RULES_SQL}
    UNION ALL SELECT 'risk_scores', 'risk_level_domain', count(CASE WHEN risk_level NOT IN ('low', 'medium', 'high', 'critical') THEN 1 END) FROM x
    UNION ALL SELECT 'risk_scores', 'site_id_unique', CAST(count(*) - count(DISTINCT site_id) AS BIGINT) FROM x""",
)
def val_constraints(t):
    k = F.col("site_id")
    sites = t.sites.select(
        F.when(k % 9 == 4, F.col("whc_id") - 1).otherwise(F.col("whc_id")).alias("whc_id"),
        F.when(k % 8 != 3, F.col("name")).alias("name"),
        F.when(k % 13 == 2, "Ruins").otherwise(F.col("category")).alias("category"),
    )
    quakes = t.quakes.withColumn("magnitude", F.when(F.col("magnitude") <= 7.5, F.col("magnitude")))
    fires = t.fires.withColumn("acq_date", F.when(F.col("ord") % 50 != 7, F.col("acq_date")))
    scores = t.scores.withColumns(
        {
            "risk_level": F.when(k % 6 == 1, "severe").otherwise(F.col("risk_level")),
            "fire_risk_score": F.when(k % 10 == 3, 1.5).otherwise(F.col("fire_risk_score")),
        }
    )
    tables = {"sites": sites, "climate_events": t.climate, "earthquake_events": quakes, "fire_events": fires, "risk_scores": scores}
    parts = [
        ql.check_domains(df, name).select(F.lit(name).alias("tab"), "rule", "violations")
        for name, df in tables.items()
    ]
    return fl.union_all(*parts)


_NEAREST_DEGREES = """nearest AS (SELECT e.usgs_id, s.site_id, e.lon, e.lat FROM quakes e, sites s
    QUALIFY row_number() OVER (PARTITION BY e.usgs_id
      ORDER BY (e.lon - s.lon) * (e.lon - s.lon) + (e.lat - s.lat) * (e.lat - s.lat), s.site_id) = 1),
    links AS (SELECT n.usgs_id, n.site_id, sqrt(power(n.x - s.x, 2) + power(n.y - s.y, 2)) / 1000 AS distance_km
      FROM {nearest_p} n JOIN sites_p s ON n.site_id = s.site_id
      WHERE sqrt(power(n.x - s.x, 2) + power(n.y - s.y, 2)) <= {limit})"""


def nearest_sql(limit: int) -> str:
    return _NEAREST_DEGREES.replace("{nearest_p}", laea("nearest")).replace("{limit}", str(limit))


@query(
    "val_pipeline_checks",
    f"""{W('sites', 'scores', 'quakes', 'sites_p')}, {nearest_sql(50000)}
    SELECT 'site_count' AS "check", CAST(count(*) AS DOUBLE) AS value, count(*) >= 1 AS passed FROM sites
    UNION ALL SELECT 'invalid_geometries', 0, true
    UNION ALL SELECT 'largest_level_share', {r('max(n) * 1.0::DOUBLE / sum(n)', alias='value')}, max(n) * 1.0::DOUBLE / sum(n) <= 0.6
      FROM (SELECT count(*) AS n FROM scores GROUP BY risk_level)
    UNION ALL SELECT 'earthquake_without_site', (SELECT count(*) FROM quakes) - (SELECT count(*) FROM links),
      (SELECT count(*) FROM quakes) = (SELECT count(*) FROM links)""",
)
def val_pipeline_checks(t):
    linked = link_hazard(t.quakes, t.sites, "earthquake", "usgs_id", strategy=t.strategy)
    return rounded(ql.pipeline_checks(t.sites, t.scores, {"earthquake": linked}), "value")


@query(
    "flt_dashboard",
    f"""{W('view')} SELECT site_id, risk_level, country, category, in_danger, is_anomaly FROM view
    WHERE risk_level IN ('medium', 'high', 'critical') AND category IN ('Cultural', 'Natural') AND is_anomaly""",
)
def flt_dashboard(t):
    kept = fl.filter_sites(
        t.view, levels=["medium", "high", "critical"], categories=["Cultural", "Natural"], anomaly=True
    )
    return kept.select("site_id", "risk_level", "country", "category", "in_danger", "is_anomaly")


@query(
    "prj_missing_to_default",
    f"""{W('flagged')} SELECT site_id, {', '.join(
        f"CASE WHEN site_id % 3 = 0 THEN 0 ELSE round({c}, 6) + 0.0 END AS {c}" for c in (*SCORES, 'composite_risk_score'))},
    CASE WHEN site_id % 3 = 0 THEN false ELSE is_anomaly END AS is_anomaly,
    CASE WHEN site_id % 3 = 0 THEN 'low' ELSE risk_level END AS risk_level FROM flagged""",
)
def prj_missing_to_default(t):
    columns = [*SCORES, "composite_risk_score", "is_anomaly", "risk_level"]
    holes = t.flagged.select("site_id", *[F.when(F.col("site_id") % 3 != 0, F.col(c)).alias(c) for c in columns])
    return rounded(fl.coalesce_scores(holes), *SCORES, "composite_risk_score")


@query("prj_geom_not_null", f"{W('hazards')} SELECT event_id, {r('lon')}, {r('lat')} FROM hazards WHERE event_id % 6 <> 2")
def prj_geom_not_null(t):
    holes = t.hazards.withColumn("lon", F.when(F.col("event_id") % 6 != 2, F.col("lon")))
    return rounded(fl.with_geometry(holes).select("event_id", "lon", "lat"), "lon", "lat")


_WORDS = """CASE event_id % 8 WHEN 0 THEN 'low' WHEN 1 THEN 'Nominal' WHEN 2 THEN 'HIGH' WHEN 3 THEN 'junk'
    WHEN 4 THEN NULL ELSE CAST(CAST((event_id * 13) % 1010 AS DOUBLE) / 10::DOUBLE AS VARCHAR) END"""


@query(
    "fn_confidence",
    f"""{W('hazards')} SELECT event_id, CAST(CASE event_id % 8 WHEN 0 THEN 30 WHEN 1 THEN 50 WHEN 2 THEN 80 WHEN 3 THEN 50
    WHEN 4 THEN 0 ELSE trunc(CAST((event_id * 13) % 1010 AS DOUBLE) / 10::DOUBLE) END AS INTEGER) AS confidence FROM hazards""",
)
def fn_confidence(t):
    k = F.col("event_id") % 8
    number = (((F.col("event_id") * 13) % 1010).cast("double") / 10.0).cast("string")
    word = (
        F.when(k == 0, "low").when(k == 1, "Nominal").when(k == 2, "HIGH").when(k == 3, "junk").when(k > 4, number)
    )
    return t.hazards.select("event_id", fn.normalize_confidence(word).alias("confidence"))


@query("fn_coastal", f"{W('sites')} SELECT site_id, {coastal('elevation_m')} AS coastal_risk_score FROM sites")
def fn_coastal(t):
    return t.sites.select("site_id", fn.coastal_score(F.col("elevation_m")).alias("coastal_risk_score"))


@query(
    "fn_coastal_site",
    f"""{W('sites')} SELECT site_id, coalesce(elevation_m, 0) AS elevation_m,
    coalesce(elevation_m < 50, false) AS is_coastal, {coastal('elevation_m')} AS coastal_risk_score FROM sites""",
)
def fn_coastal_site(t):
    from sitewarden.operators.exposure import coastal_scores

    return coastal_scores(t.sites)


@query(
    "fn_text_clean",
    """SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN c_name ELSE substring(c_mktsegment, 1, 12) END AS label,
    CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE substring(c_name, 1, 12) END AS short FROM customer""",
)
def fn_text_clean(t):
    k = F.col("c_custkey")
    first = F.when(k % 3 == 0, F.concat(F.lit("  "), "c_name", F.lit(" "))).when(k % 3 == 1, "   ")
    blank = F.when(k % 4 == 0, "  ").otherwise(F.concat(F.lit(" "), "c_name"))
    return t.raw("customer").select(
        k.alias("id"),
        fn.first_nonempty(first, F.col("c_mktsegment"), max_len=30).alias("label"),
        fn.clean(blank, 12).alias("short"),
    )


@query(
    "fn_dates",
    f"""{W('hazards')} SELECT event_id, strftime(ts, '%Y-%m-%d') AS iso_day, strftime(ts, '%Y-%m-%d') AS compact_day,
    CAST(CASE WHEN event_id % 11 = 5 THEN -1 ELSE hour(ts) * 60 + minute(ts) END AS INTEGER) AS minutes,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS from_ms, CAST(year(ts) AS INTEGER) AS year FROM hazards""",
)
def fn_dates(t):
    ts = F.col("ts").cast("timestamp")
    hhmm = F.when(F.col("event_id") % 11 == 5, "2460").otherwise(
        (F.hour(ts) * 100 + F.minute(ts)).cast("string")
    )
    return t.hazards.select(
        "event_id",
        F.date_format(fn.to_day(F.date_format(ts, "yyyy-MM-dd")), "yyyy-MM-dd").alias("iso_day"),
        F.date_format(fn.to_day(F.date_format(ts, "yyyyMMdd"), "yyyyMMdd"), "yyyy-MM-dd").alias("compact_day"),
        F.coalesce(fn.to_minutes(hhmm), F.lit(-1)).alias("minutes"),
        F.date_format(fn.from_epoch_ms(F.unix_millis(ts)), "yyyy-MM-dd HH:mm:ss").alias("from_ms"),
        F.year(fn.from_epoch_ms(F.unix_millis(ts))).alias("year"),
    )


@query(
    "fn_log1p",
    f"""{W('quakes')} SELECT usgs_id, {r('ln(1 + depth_km)', alias='log_depth')}, {r('power(10, magnitude / 4)', alias='ten_power')},
    {r('greatest(depth_km, 0.1)', alias='floored')}, least(1.0::DOUBLE, greatest(0.0::DOUBLE, depth_km - 20)) AS clipped,
    round(lon, 4) + 0.0 AS lon4 FROM quakes""",
)
def fn_log1p(t):
    d = F.col("depth_km")
    out = t.quakes.select(
        "usgs_id",
        F.log1p(d).alias("log_depth"),
        F.pow(F.lit(10.0), F.col("magnitude") / 4).alias("ten_power"),
        F.greatest(d, F.lit(0.1)).alias("floored"),
        fn.clip01(d - 20).alias("clipped"),
        (F.round("lon", 4) + 0.0).alias("lon4"),
    )
    return rounded(out, "log_depth", "ten_power", "floored")


@query(
    "fn_risk_bin",
    f"""SELECT event_id, coalesce({level('s')}, 'none') AS risk_level FROM (
    SELECT event_id, CAST(event_id % 111 - 5 AS DOUBLE) / 100::DOUBLE AS s FROM events)""",
)
def fn_risk_bin(t):
    score = (F.col("event_id") % 111 - 5).cast("double") / 100.0
    return t.raw("events").select("event_id", F.coalesce(fn.risk_level(score), F.lit("none")).alias("risk_level"))
