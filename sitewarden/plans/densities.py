"""Density plan: kernel density of features and its summary per site."""

from __future__ import annotations

from pyspark.sql import DataFrame

from sitewarden.constants import KDE_BANDWIDTH_M
from sitewarden.operators.density import urban_kde
from sitewarden.operators.exposure import site_density
from sitewarden.session import stage


def density(
    sites: DataFrame, urban: DataFrame, bandwidth_m: float = KDE_BANDWIDTH_M, strategy: str = "auto"
) -> tuple[DataFrame, DataFrame]:
    """(features with density_score, site summary)."""
    scored = stage(urban_kde(urban, bandwidth_m), "density")
    return scored, site_density(sites, scored, strategy=strategy)
