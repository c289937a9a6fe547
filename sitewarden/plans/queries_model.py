"""Scaling, composite, models and the composed plans."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from sitewarden.operators import filters as fl
from sitewarden.operators.density import urban_kde
from sitewarden.operators.exposure import seismic_energy
from sitewarden.operators.isolation import attach_anomalies, isolation_forest
from sitewarden.operators.scaling import composite, log_minmax
from sitewarden.plans import densities
from sitewarden.plans.oracle import SCORES6, SCORES_ROUNDED, r, with_ctes
from sitewarden.plans.registry import SCORES, query, rounded

W = with_ctes


@query("ml_log_minmax", f"{W('subscores')} SELECT site_id, {r('seismic_risk_score')} FROM subscores")
def ml_log_minmax(t):
    raw = seismic_energy(t.sites, t.quakes, strategy=t.strategy)
    scaled = log_minmax(raw, "total_energy", "seismic_risk_score")
    return rounded(scaled.select("site_id", "seismic_risk_score"), "seismic_risk_score")


@query(
    "ml_composite",
    f"""{W('scores')}, h AS (SELECT site_id, {', '.join(
        f"CASE WHEN site_id % 6 = {i} THEN 0 ELSE {c} END AS {c}" for i, c in enumerate(SCORES6))} FROM scores),
    c AS (SELECT *, urban_density_score * 0.25::DOUBLE + climate_anomaly_score * 0.2::DOUBLE + seismic_risk_score * 0.2::DOUBLE
      + fire_risk_score * 0.15::DOUBLE + flood_risk_score * 0.1::DOUBLE + coastal_risk_score * 0.1::DOUBLE AS s FROM h)
    SELECT site_id, {r('s', alias='composite_risk_score')}, CASE WHEN s <= 0.25 THEN 'low' WHEN s <= 0.5 THEN 'medium'
      WHEN s <= 0.75 THEN 'high' ELSE 'critical' END AS risk_level FROM c""",
)
def ml_composite(t):
    k = F.col("site_id")
    holes = t.scores.select(k, *[F.when(k % 6 != i, F.col(c)).alias(c) for i, c in enumerate(SCORES)])
    return rounded(composite(holes).select("site_id", "composite_risk_score", "risk_level"), "composite_risk_score")


@query(
    "ml_risk_pipeline",
    f"{W('scores')} SELECT site_id, {SCORES_ROUNDED}, {r('composite_risk_score')}, risk_level FROM scores",
)
def ml_risk_pipeline(t):
    return rounded(t.compute_scores(), *SCORES, "composite_risk_score")


@query(
    "ml_features",
    f"""{W('scores')} SELECT site_id, {', '.join(
        "0.0::DOUBLE AS coastal_risk_score" if c == 'coastal_risk_score'
        else f"CASE WHEN site_id % 4 = 1 THEN 0 ELSE round({c}, 6) + 0.0 END AS {c}" for c in SCORES6)} FROM scores""",
)
def ml_features(t):
    k = F.col("site_id")
    holes = t.scores.select(k, *[F.when(k % 4 != 1, F.col(c)).alias(c) for c in SCORES if c != "coastal_risk_score"])
    return rounded(fl.feature_matrix(holes), *SCORES)


@query("ml_isolation_forest", f"{W('forest')} SELECT site_id, {r('isolation_forest_score')}, is_anomaly FROM forest")
def ml_isolation_forest(t):
    return rounded(isolation_forest(t.scores), "isolation_forest_score")


@query(
    "ml_anomaly_flags",
    f"{W('flagged')} SELECT site_id, {r('composite_risk_score')}, risk_level, {r('isolation_forest_score')}, is_anomaly FROM flagged",
)
def ml_anomaly_flags(t):
    out = attach_anomalies(t.scores, isolation_forest(t.scores))
    return rounded(
        out.select("site_id", "composite_risk_score", "risk_level", "isolation_forest_score", "is_anomaly"),
        "composite_risk_score",
        "isolation_forest_score",
    )


_KDE = f"""m AS (SELECT id, 6378137.0::DOUBLE * radians(lon) AS mx, 6378137.0::DOUBLE * ln(tan(pi() / 4 + radians(lat) / 2)) AS my FROM urban0),
    kde AS (SELECT a.id, sum(exp(-(power(a.mx - b.mx, 2) + power(a.my - b.my, 2)) / 2e6::DOUBLE)) /
      ((SELECT count(*) FROM m) * {2 * math.pi * 1e6!r}::DOUBLE) AS density_score FROM m a, m b GROUP BY a.id)"""


@query("ml_kde", f"{W('urban0')}, {_KDE} SELECT id, {r('density_score * 1e12', 4, 'density_e12')} FROM kde")
def ml_kde(t):
    out = urban_kde(t.urban_raw.select("id", "rings"))
    return rounded(out.select("id", (F.col("density_score") * 1e12).alias("density_e12")), "density_e12", digits=4)


@query(
    "ml_density_pipeline",
    f"""{W('sites', 'urban')}, {_KDE} SELECT s.site_id, s.name AS site_name, count(d.id) AS density_feature_count,
    {r('coalesce(avg(d.density_score), 0) * 1e12', 4, 'avg_e12')}, {r('coalesce(max(d.density_score), 0) * 1e12', 4, 'max_e12')},
    {r('coalesce(stddev_samp(d.density_score), 0) * 1e12', 4, 'stddev_e12')}
    FROM sites s LEFT JOIN (SELECT u.*, k.density_score FROM urban u JOIN kde k ON u.id = k.id) d
      ON d.nearest_site_id = s.site_id AND d.distance_to_site_m <= 5000 GROUP BY s.site_id, s.name""",
)
def ml_density_pipeline(t):
    _, summary = densities.density(t.sites, t.urban, strategy=t.strategy)
    out = summary.select(
        "site_id",
        "site_name",
        "density_feature_count",
        *[(F.col(f"{c}_density") * 1e12).alias(f"{c}_e12") for c in ("avg", "max", "stddev")],
    )
    return rounded(out, "avg_e12", "max_e12", "stddev_e12", digits=4)
