"""The spatial link step: hazards get their nearest site, features their distance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewarden.constants import NEAREST_KM
from sitewarden.operators.merge import update_matched
from sitewarden.operators.spatial import nearest_site, refresh_distance
from sitewarden.session import resolve_strategy


def link_hazard(
    events: DataFrame, sites: DataFrame, kind: str, key: str, rank: str = "degrees", strategy: str = "auto"
) -> DataFrame:
    """Events with nearest_site_id and distance_to_site_km updated where a site is in range."""
    links = nearest_site(events, sites, NEAREST_KM[kind], key, rank, strategy).select(
        key,
        F.col("site_id").alias("nearest_site_id"),
        F.col("distance_km").alias("distance_to_site_km"),
    )
    return update_matched(events, links, [key], ["nearest_site_id", "distance_to_site_km"])


def link_all(
    sites: DataFrame,
    urban: DataFrame,
    hazards: dict[str, tuple[DataFrame, str]],
    strategy: str = "auto",
) -> dict[str, DataFrame]:
    """Every linked table; `hazards` maps a kind to (events, key)."""
    strategy = resolve_strategy(sites, strategy)
    linked = {"urban": refresh_distance(urban, sites, strategy)}
    for kind, (events, key) in hazards.items():
        linked[kind] = link_hazard(events, sites, kind, key, strategy=strategy)
    return linked
