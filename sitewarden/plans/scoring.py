"""The scoring plan: six feeds to one composite score per site."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewarden.constants import RISK_WEIGHTS, SCORE_COLUMNS
from sitewarden.operators import exposure as ex
from sitewarden.operators.scaling import composite, log_minmax_all
from sitewarden.session import resolve_strategy, stage

_SUMS = (
    "building_count",
    "total_area_m2",
    "extreme_days",
    "total_days",
    "total_energy",
    "total_fire_risk",
    "flood_count",
    "severity_sum",
    "severity_count",
)


def raw_metrics(
    sites: DataFrame,
    urban: DataFrame,
    climate: DataFrame,
    quakes: DataFrame,
    fires: DataFrame,
    floods: DataFrame,
    method: str = "spheroid",
    strategy: str = "auto",
) -> DataFrame:
    """Raw value of every hazard per site.

    The feeds are reduced per site, stacked and grouped once, which replaces five outer joins. The
    site rows themselves are part of the stack, so sites no feed mentions stay.
    """
    strategy = resolve_strategy(sites, strategy)
    coastal = ex.coastal_columns(sites)[2]
    parts = [
        sites.select("site_id", F.lit(True).alias("known"), coastal.alias("coastal_risk_score")),
        ex.urban_sums(urban),
        ex.climate_sums(sites, climate, strategy=strategy),
        ex.seismic_sums(sites, quakes, method=method, strategy=strategy).drop("earthquake_count"),
        ex.fire_sums(sites, fires, method=method, strategy=strategy).drop("fire_count"),
        ex.flood_sums(sites, floods, method=method, strategy=strategy),
    ]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    per_site = (
        stacked.groupBy("site_id")
        .agg(
            F.max("known").alias("known"),
            F.max("coastal_risk_score").alias("coastal_risk_score"),
            *[F.coalesce(F.max(c).cast("double"), F.lit(0.0)).alias(c) for c in _SUMS],
        )
        .where("known")
    )
    return per_site.select(
        "site_id",
        (F.col("building_count") + F.col("total_area_m2") / 1e6).alias("urban_density_raw"),
        ex.anomaly_ratio().alias("anomaly_ratio"),
        "total_energy",
        "total_fire_risk",
        (F.col("flood_count") * 0.5 + ex.mean_severity() * 0.5).alias("flood_risk_raw"),
        "coastal_risk_score",
    )


def risk_scores(
    sites: DataFrame,
    urban: DataFrame,
    climate: DataFrame,
    quakes: DataFrame,
    fires: DataFrame,
    floods: DataFrame,
    weights: dict[str, float] = RISK_WEIGHTS,
    method: str = "spheroid",
    strategy: str = "auto",
) -> DataFrame:
    """Six sub-scores, composite score and level of every site."""
    # one row per site, written once: the extremes are taken from the file, not from a second run of all feeds
    raw = stage(raw_metrics(sites, urban, climate, quakes, fires, floods, method, strategy), "raw_metrics")
    scaled = log_minmax_all(
        raw,
        {
            "urban_density_raw": "urban_density_score",
            "anomaly_ratio": "climate_anomaly_score",
            "total_energy": "seismic_risk_score",
            "total_fire_risk": "fire_risk_score",
            "flood_risk_raw": "flood_risk_score",
        },
        keep=["site_id", "coastal_risk_score"],
    )
    return composite(scaled.select("site_id", *SCORE_COLUMNS), weights)
