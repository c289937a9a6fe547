"""Aggregates, windows, sorts, top-k and set operations."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from sitewarden.operators import exposure as ex
from sitewarden.operators import filters as fl
from sitewarden.operators import reports as rp
from sitewarden.plans.oracle import SCORES6, r, with_ctes
from sitewarden.plans.registry import LEVELS, SCORES, query, rounded, texts

W = with_ctes


@query(
    "agg_urban_density",
    f"""{W('urban_density')} SELECT site_id, building_count, {r('total_area_m2', 3)}, {r('urban_density_raw')} FROM urban_density""",
)
def agg_urban_density(t):
    out = ex.urban_density(t.sites, t.urban, strategy=t.strategy)
    return rounded(rounded(out, "total_area_m2", digits=3), "urban_density_raw")


@query(
    "agg_climate_extremes",
    f"{W('climate_extremes')} SELECT site_id, extreme_days, total_days, {r('anomaly_ratio')} FROM climate_extremes",
)
def agg_climate_extremes(t):
    return rounded(ex.climate_extremes(t.sites, t.climate, strategy=t.strategy), "anomaly_ratio")


@query(
    "agg_seismic_energy",
    f"{W('seismic')} SELECT site_id, earthquake_count, {r('ln(1 + total_energy)', alias='log_energy')} FROM seismic",
)
def agg_seismic_energy(t):
    out = ex.seismic_energy(t.sites, t.quakes, strategy=t.strategy)
    return rounded(out.select("site_id", "earthquake_count", F.log1p("total_energy").alias("log_energy")), "log_energy")


@query(
    "agg_fire_exposure",
    f"{W('fire')} SELECT site_id, fire_count, {r('total_fire_risk')} FROM fire",
)
def agg_fire_exposure(t):
    return rounded(ex.fire_exposure(t.sites, t.fires, strategy=t.strategy), "total_fire_risk")


@query(
    "agg_flood_exposure",
    f"{W('flood')} SELECT site_id, flood_count, {r('avg_severity')}, {r('flood_risk_raw')} FROM flood",
)
def agg_flood_exposure(t):
    return rounded(ex.flood_exposure(t.sites, t.floods, strategy=t.strategy), "avg_severity", "flood_risk_raw")


_DENSE = "CASE WHEN id % 6 = 1 THEN NULL ELSE CAST((id * 31) % 997 AS DOUBLE) / 1000::DOUBLE END"


@query(
    "agg_site_density",
    f"""{W('sites', 'urban')}, d AS (SELECT *, {_DENSE} AS density_score FROM urban)
    SELECT s.site_id, s.name AS site_name, count(d.id) AS density_feature_count, {r('coalesce(avg(d.density_score), 0)', alias='avg_density')},
    {r('coalesce(max(d.density_score), 0)', alias='max_density')}, {r('coalesce(stddev_samp(d.density_score), 0)', alias='stddev_density')}
    FROM sites s LEFT JOIN d ON d.nearest_site_id = s.site_id AND d.distance_to_site_m <= 5000 AND d.density_score IS NOT NULL
    GROUP BY s.site_id, s.name""",
)
def agg_site_density(t):
    k = F.col("id")
    scored = t.urban.withColumn("density_score", F.when(k % 6 != 1, ((k * 31) % 997).cast("double") / 1000.0))
    out = ex.site_density(t.sites, scored, strategy=t.strategy)
    return rounded(out, "avg_density", "max_density", "stddev_density")


@query(
    "agg_table_counts",
    f"""{W('sites', 'urban', 'climate', 'quakes', 'fires', 'floods', 'scores')}
    SELECT 'sites' AS "table", count(*) AS "rows", CAST(-1 AS BIGINT) AS linked, -1.0::DOUBLE AS avg_distance FROM sites
    UNION ALL SELECT 'urban_features', count(*), count(nearest_site_id), {r('avg(distance_to_site_m)', 3, 'd')} FROM urban
    UNION ALL SELECT 'climate_events', count(*), -1, -1 FROM climate
    UNION ALL SELECT 'earthquake_events', count(*), -1, -1 FROM quakes
    UNION ALL SELECT 'fire_events', count(*), -1, -1 FROM fires
    UNION ALL SELECT 'flood_zones', count(*), -1, -1 FROM floods
    UNION ALL SELECT 'risk_scores', count(*), -1, -1 FROM scores""",
)
def agg_table_counts(t):
    tables = {
        "sites": t.sites,
        "urban_features": t.urban,
        "climate_events": t.climate,
        "earthquake_events": t.quakes,
        "fire_events": t.fires,
        "flood_zones": t.floods,
        "risk_scores": t.scores,
    }
    out = rp.table_counts(tables, {"urban_features": ("nearest_site_id", "distance_to_site_m")})
    out = out.withColumns(
        {"linked": F.coalesce("linked", F.lit(-1)).cast("long"), "avg_distance": F.coalesce("avg_distance", F.lit(-1.0))}
    )
    return rounded(out, "avg_distance", digits=3)


@query(
    "agg_value_counts",
    f"""{W('view', 'fires')}, lv AS (SELECT * FROM (VALUES ('low'), ('medium'), ('high'), ('critical')) v(level))
    SELECT 'risk_level' AS what, level AS value, count(v.site_id) AS n,
      round(count(v.site_id) * 100.0::DOUBLE / (SELECT count(*) FROM view), 1) + 0.0 AS share_pct
      FROM lv LEFT JOIN view v ON v.risk_level = level GROUP BY level
    UNION ALL SELECT 'category', category, count(*), -1 FROM view GROUP BY category
    UNION ALL SELECT 'day_night', day_night, count(*), -1 FROM fires GROUP BY day_night
    UNION ALL (SELECT 'country', country, count(*) AS n, -1 FROM view GROUP BY country ORDER BY n DESC, country LIMIT 10)""",
)
def agg_value_counts(t):
    def part(what, df):
        column = df.columns[0]
        share = F.col("share_pct") + 0.0 if "share_pct" in df.columns else F.lit(-1.0)
        return df.select(F.lit(what).alias("what"), F.col(column).alias("value"), "n", share.alias("share_pct"))

    return fl.union_all(
        part("risk_level", rp.value_counts(t.view, "risk_level", order=LEVELS, share=True)),
        part("category", rp.value_counts(t.view, "category")),
        part("day_night", rp.value_counts(t.fires, "day_night")),
        part("country", rp.value_counts(t.view, "country", n=10)),
    )


@query(
    "agg_site_summary",
    f"""{W('sites')} SELECT count(*) AS total_sites, count(DISTINCT country) AS countries,
    count(CASE WHEN in_danger THEN 1 END) AS in_danger, min(date_inscribed) AS first_year, max(date_inscribed) AS last_year FROM sites""",
)
def agg_site_summary(t):
    return rp.site_summary(t.sites)


@query("agg_by_year", f"{W('sites')} SELECT date_inscribed, count(*) AS n FROM sites GROUP BY 1")
def agg_by_year(t):
    return rp.sites_by_year(t.sites)


def _describe_sql(name: str, column: str, src: str) -> str:
    q = ", ".join(r(f"quantile_cont({column}, {p})", alias=a) for p, a in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75")))
    return f"""SELECT '{name}' AS name, count({column}) AS n, {r(f'avg({column})', alias='mean')}, {r(f'stddev_samp({column})', alias='std')},
    {r(f'min({column})', alias='min')}, {q}, {r(f'max({column})', alias='max')} FROM {src}"""


@query(
    "agg_describe",
    W("view")
    + " "
    + " UNION ALL ".join(
        _describe_sql(c, c, "view") for c in (*SCORES6, "composite_risk_score", "elevation_m", "area_hectares")
    ),
)
def agg_describe(t):
    columns = [*SCORES, "composite_risk_score", "elevation_m", "area_hectares"]
    return rounded(rp.describe(t.view, columns), "mean", "std", "min", "q25", "q50", "q75", "max")


@query(
    "agg_missing_profile",
    f"""{W('sites', 'fires')} SELECT 'elevation_m' AS "column", count(*) - count(elevation_m) AS missing,
    {r('(count(*) - count(elevation_m)) * 100.0::DOUBLE / count(*)', alias='missing_pct')} FROM sites
    UNION ALL SELECT 'frp', count(*) - count(frp), {r('(count(*) - count(frp)) * 100.0::DOUBLE / count(*)', alias='p')} FROM fires""",
)
def agg_missing_profile(t):
    return rounded(fl.union_all(rp.missing_profile(t.sites), rp.missing_profile(t.fires)), "missing_pct")


@query(
    "agg_correlation",
    W("view")
    + " "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, {r(f'covar_samp({a}, {b}) / nullif(stddev_samp({a}) * stddev_samp({b}), 0)', alias='r')}, "
        f"abs(covar_samp({a}, {b}) / nullif(stddev_samp({a}) * stddev_samp({b}), 0)) > 0.5 AS strong FROM view"
        for a, b in combinations(SCORES6, 2)
    ),
)
def agg_correlation(t):
    out = rp.correlation(t.view).withColumn("strong", F.abs("r") > 0.5)
    return rounded(out, "r")


@query(
    "agg_crosstab",
    f"""{W('view')} SELECT in_danger, {', '.join(f"count(CASE WHEN risk_level = '{v}' THEN 1 END) AS {v}" for v in LEVELS)} FROM view GROUP BY 1""",
)
def agg_crosstab(t):
    return rp.crosstab(t.view, "in_danger", "risk_level")


@query(
    "agg_group_mean",
    f"{W('view')} SELECT in_danger, {r('avg(composite_risk_score)', alias='mean_composite_risk_score')} FROM view GROUP BY 1",
)
def agg_group_mean(t):
    return rounded(rp.group_mean(t.view, "in_danger"), "mean_composite_risk_score")


@query(
    "agg_country_risk",
    f"""{W('view')} (SELECT 'top' AS kind, country, round(avg(composite_risk_score), 3) + 0.0 AS avg_risk, count(*) AS site_count FROM view
    GROUP BY country HAVING count(*) >= 3 ORDER BY avg_risk DESC, country LIMIT 15)
    UNION ALL SELECT 'treemap', country, {r('avg(composite_risk_score)', alias='a')}, count(*) FROM view GROUP BY country HAVING count(*) >= 2""",
)
def agg_country_risk(t):
    top = rp.country_risk(t.view).withColumn("kind", F.lit("top"))
    tree = rp.country_risk(t.view, min_sites=2, digits=None, n=None).withColumn("kind", F.lit("treemap"))
    return rounded(top.unionByName(tree), "avg_risk")


@query(
    "agg_dashboard_stats",
    f"""{W('view')} SELECT count(*) AS total_sites, {r('coalesce(avg(composite_risk_score), 0)', alias='avg_risk')},
    count(CASE WHEN risk_level IN ('high', 'critical') THEN 1 END) AS high_risk, count(CASE WHEN is_anomaly THEN 1 END) AS anomalies
    FROM view WHERE category IN ('Cultural', 'Mixed')""",
)
def agg_dashboard_stats(t):
    return rounded(rp.dashboard_stats(fl.filter_sites(t.view, categories=["Cultural", "Mixed"])), "avg_risk")


@query(
    "agg_factor_means",
    W("view")
    + " "
    + " UNION ALL ".join(f"SELECT 'mean' AS who, '{c}' AS factor, {r(f'avg({c})', alias='value')} FROM view" for c in SCORES6)
    + " "
    + " ".join(
        f"UNION ALL (SELECT site_id || ' ' || name, '{c}', {r(c, alias='value')} FROM view ORDER BY composite_risk_score DESC, site_id LIMIT 5)"
        for c in SCORES6
    ),
)
def agg_factor_means(t):
    means = rp.factor_means(t.view).select(F.lit("mean").alias("who"), "factor", F.col("mean_score").alias("value"))
    top = rp.factors_long(t.view).select(F.concat_ws(" ", "site_id", "name").alias("who"), "factor", F.col("score").alias("value"))
    return rounded(means.unionByName(top), "value")


@query(
    "agg_histogram",
    f"""{W('view')}, b AS (SELECT min(composite_risk_score) AS lo, max(composite_risk_score) AS hi FROM view),
    p AS (SELECT least(CAST(floor((composite_risk_score - lo) / (hi - lo) * 50) AS INTEGER), 49) AS bin FROM view, b)
    SELECT CAST(g.i AS INTEGER) AS bin, {r('lo + g.i * ((hi - lo) / 50)', alias='low')}, {r('lo + (g.i + 1) * ((hi - lo) / 50)', alias='high')},
    (SELECT count(*) FROM p WHERE p.bin = g.i) AS n, {r('(SELECT avg(composite_risk_score) FROM view)', alias='mean')},
    {r('(SELECT median(composite_risk_score) FROM view)', alias='median')} FROM range(50) g(i), b""",
)
def agg_histogram(t):
    stats = rp.histogram_stats(t.view, "composite_risk_score").agg(F.struct(F.max("mean").alias("mean"), F.max("median").alias("median")).alias("s"))
    out = rp.histogram(t.view, "composite_risk_score").withColumn("s", stats.scalar())
    out = out.select("bin", "low", "high", "n", F.col("s.mean").alias("mean"), F.col("s.median").alias("median"))
    return rounded(out, "low", "high", "mean", "median")


def _box_sql(c: str) -> str:
    return f"""SELECT '{c}' AS name, {r('q1')}, {r('med', alias='median')}, {r('q3')},
    {r(f'min(CASE WHEN {c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN {c} END)', alias='whisker_low')},
    {r(f'max(CASE WHEN {c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN {c} END)', alias='whisker_high')},
    count(CASE WHEN {c} NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN 1 END) AS outliers
    FROM view, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS med, quantile_cont({c}, 0.75) AS q3 FROM view) z
    GROUP BY q1, med, q3"""


@query("agg_box_stats", W("view") + " " + " UNION ALL ".join(_box_sql(c) for c in SCORES6))
def agg_box_stats(t):
    return rounded(rp.box_stats(t.view), "q1", "median", "q3", "whisker_low", "whisker_high")


@query(
    "agg_anomaly_stats",
    f"""{W('view')} SELECT count(*) AS total_sites, count(CASE WHEN is_anomaly THEN 1 END) AS anomalies,
    {r('count(CASE WHEN is_anomaly THEN 1 END) * 100.0::DOUBLE / count(*)', alias='anomaly_pct')},
    count(CASE WHEN NOT is_anomaly THEN 1 END) AS normal,
    {r('count(CASE WHEN NOT is_anomaly THEN 1 END) * 100.0::DOUBLE / count(*)', alias='normal_pct')} FROM view""",
)
def agg_anomaly_stats(t):
    return rounded(rp.anomaly_stats(t.view), "anomaly_pct", "normal_pct")


@query(
    "agg_urban_exposure",
    f"""{W('sites', 'urban')} SELECT s.name, count(u.id) AS urban_count, {r('coalesce(sum(u.distance_to_site_m), -1)', 3, 'total_dist')}
    FROM sites s LEFT JOIN urban u ON u.nearest_site_id = s.site_id GROUP BY s.name ORDER BY urban_count DESC, s.name LIMIT 10""",
)
def agg_urban_exposure(t):
    out = rp.urban_exposure(t.sites, t.urban, strategy=t.strategy)
    return rounded(out.withColumn("total_dist", F.coalesce("total_dist", F.lit(-1.0))), "total_dist", digits=3)


@query(
    "win_distinct_on",
    f"""{W('fires')} SELECT DISTINCT ON (satellite, acq_date, acq_time // 60) satellite, strftime(acq_date, '%Y-%m-%d') AS acq_date,
    CAST(acq_time // 60 AS INTEGER) AS hour, ord, {r('lon')} FROM fires ORDER BY satellite, acq_date, acq_time // 60, acq_time, ord""",
)
def win_distinct_on(t):
    df = t.fires.select("satellite", "acq_date", F.floor(F.col("acq_time") / 60).cast("int").alias("hour"), "acq_time", "ord", "lon")
    first = fl.first_per_key(df, ["satellite", "acq_date", "hour"], ["acq_time", "ord"]).drop("acq_time")
    return texts(rounded(first, "lon"), "acq_date")


@query(
    "topk_risk",
    f"""{W('view')} SELECT site_id, name, country, category, {r('composite_risk_score')}, risk_level FROM view
    ORDER BY composite_risk_score DESC, site_id LIMIT 20""",
)
def topk_risk(t):
    out = fl.top_risk(t.view, 20, ["site_id", "name", "country", "category", "composite_risk_score", "risk_level"])
    return rounded(out, "composite_risk_score")


@query(
    "topk_anomalies",
    f"""{W('view')} SELECT site_id, name, {r('composite_risk_score')}, {r('isolation_forest_score')} FROM view WHERE is_anomaly
    ORDER BY isolation_forest_score, site_id LIMIT 20""",
)
def topk_anomalies(t):
    out = fl.top_anomalies(t.view, 20, ["site_id", "name", "composite_risk_score", "isolation_forest_score"])
    return rounded(out, "composite_risk_score", "isolation_forest_score")


@query(
    "topk_density",
    f"""{W('sites', 'urban')}, d AS (SELECT *, {_DENSE} AS density_score FROM urban)
    SELECT s.site_id, s.name AS site_name, {r('coalesce(avg(d.density_score), 0)', alias='avg_density')}
    FROM sites s LEFT JOIN d ON d.nearest_site_id = s.site_id AND d.distance_to_site_m <= 5000 AND d.density_score IS NOT NULL
    GROUP BY s.site_id, s.name ORDER BY avg_density DESC, s.site_id LIMIT 10""",
)
def topk_density(t):
    k = F.col("id")
    scored = t.urban.withColumn("density_score", F.when(k % 6 != 1, ((k * 31) % 997).cast("double") / 1000.0))
    # rounded before the cut, as equal means may differ in their last bit
    means = rounded(ex.site_density(t.sites, scored, strategy=t.strategy), "avg_density")
    return fl.top_n(means, "avg_density", 10, ["site_id", "site_name", "avg_density"])


@query(
    "topk_area",
    f"{W('sites')} SELECT site_id, name, country, {r('area_hectares')} FROM sites ORDER BY area_hectares DESC, site_id LIMIT 10",
)
def topk_area(t):
    return rounded(fl.top_n(t.sites, "area_hectares", 10, ["site_id", "name", "country", "area_hectares"]), "area_hectares")


@query(
    "anomalies_report",
    f"{W('view')} SELECT site_id, name, country, {r('composite_risk_score')}, risk_level, is_anomaly FROM view WHERE is_anomaly",
)
def anomalies_report(t):
    return rounded(rp.anomalies_report(t.sites, t.flagged), "composite_risk_score")


@query("limit_sites", f"{W('sites')} SELECT site_id, name, {r('lon')}, {r('lat')} FROM sites ORDER BY site_id LIMIT 10")
def limit_sites(t):
    return rounded(fl.sample_sites(t.sites.select("site_id", "name", "lon", "lat"), 10), "lon", "lat")


@query(
    "union_sources",
    f"""{W('climate')} SELECT site_id, strftime(event_date, '%Y-%m-%d') AS event_date, source, {r('precipitation_mm')},
    {r("CASE WHEN source = 'open_meteo' THEN temp_max_c END", alias='temp_max_c')} FROM climate""",
)
def union_sources(t):
    meteo = t.climate.where("source = 'open_meteo'")
    power = t.climate.where("source = 'nasa_power'").drop("temp_max_c")
    return texts(rounded(fl.union_all(meteo, power), "precipitation_mm", "temp_max_c"), "event_date")


