"""Per-site exposure aggregates: the raw side of the six sub-scores.

Each function returns one row per site of `sites`. Events are reduced per site before anything is
joined back, so the join back carries at most one row per site.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewarden.constants import (
    COASTAL_ELEVATION_M,
    FIRE_SCORE_M,
    FLOOD_SCORE_M,
    SEISMIC_SCORE_M,
    URBAN_LINK_M,
    URBAN_SCORE_M,
)
from sitewarden.functions.shapes import project_shape, shape_area, shape_of_rings
from sitewarden.functions.scalars import clip01
from sitewarden.operators.spatial import distance_sums
from sitewarden.session import resolve_strategy

_MIN_KM = 0.1


def _back_to_sites(sites: DataFrame, per_site: DataFrame, strategy: str) -> DataFrame:
    side = F.broadcast(per_site) if strategy == "broadcast" else per_site
    return sites.select("site_id").join(side, "site_id", "left")


def _inverse_km(power: int):
    def kernel(km: Column) -> Column:
        near = F.greatest(km, F.lit(_MIN_KM))
        return 1.0 / (near * near if power == 2 else near)

    return kernel


def _one(km: Column) -> Column:
    return F.lit(1.0)


def _count(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0.0)).cast("long").alias(name)


def _zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0.0)).alias(name)


def seismic_sums(
    sites: DataFrame, quakes: DataFrame, radius_m: float = SEISMIC_SCORE_M, method: str = "spheroid", strategy: str = "auto"
) -> DataFrame:
    """earthquake_count and total_energy of the sites that have a quake in range."""
    energy = F.pow(F.lit(10.0), 1.5 * F.col("magnitude"))
    terms = {"earthquake_count": (F.lit(1.0), _one), "total_energy": (energy, _inverse_km(2))}
    return distance_sums(sites, quakes, radius_m, terms, method, strategy)


def seismic_energy(
    sites: DataFrame, quakes: DataFrame, radius_m: float = SEISMIC_SCORE_M, method: str = "spheroid", strategy: str = "auto"
) -> DataFrame:
    """Sum of 10^(1.5 M) / max(d_km, 0.1)^2 within the radius, and the event count."""
    strategy = resolve_strategy(sites, strategy)
    sums = seismic_sums(sites, quakes, radius_m, method, strategy)
    return _back_to_sites(sites, sums, strategy).select("site_id", _count("earthquake_count"), _zero("total_energy"))


def fire_sums(
    sites: DataFrame, fires: DataFrame, radius_m: float = FIRE_SCORE_M, method: str = "spheroid", strategy: str = "auto"
) -> DataFrame:
    """fire_count and total_fire_risk of the sites that have a fire in range."""
    power = F.col("frp") * (F.col("confidence") / F.lit(100.0))
    terms = {"fire_count": (F.lit(1.0), _one), "total_fire_risk": (power, _inverse_km(1))}
    return distance_sums(sites, fires, radius_m, terms, method, strategy)


def fire_exposure(
    sites: DataFrame, fires: DataFrame, radius_m: float = FIRE_SCORE_M, method: str = "spheroid", strategy: str = "auto"
) -> DataFrame:
    """Sum of frp x confidence/100 / max(d_km, 0.1); a fire without frp counts but adds nothing."""
    strategy = resolve_strategy(sites, strategy)
    sums = fire_sums(sites, fires, radius_m, method, strategy)
    return _back_to_sites(sites, sums, strategy).select("site_id", _count("fire_count"), _zero("total_fire_risk"))


def flood_sums(
    sites: DataFrame, floods: DataFrame, radius_m: float = FLOOD_SCORE_M, method: str = "spheroid", strategy: str = "auto"
) -> DataFrame:
    """flood_count, severity_sum and severity_count of the sites that have a flood in range."""
    known = F.col("flood_intensity").isNotNull().cast("double")
    terms = {
        "flood_count": (F.lit(1.0), _one),
        "severity_sum": (F.col("flood_intensity"), _one),
        "severity_count": (known, _one),
    }
    return distance_sums(sites, floods, radius_m, terms, method, strategy)


def mean_severity() -> Column:
    return F.coalesce(F.try_divide(F.col("severity_sum"), F.col("severity_count")), F.lit(0.0))


def flood_exposure(
    sites: DataFrame, floods: DataFrame, radius_m: float = FLOOD_SCORE_M, method: str = "spheroid", strategy: str = "auto"
) -> DataFrame:
    """Count and mean intensity within the radius; raw value is half of each."""
    strategy = resolve_strategy(sites, strategy)
    sums = flood_sums(sites, floods, radius_m, method, strategy)
    joined = _back_to_sites(sites, sums, strategy)
    return joined.select("site_id", _count("flood_count"), mean_severity().alias("avg_severity")).withColumn(
        "flood_risk_raw", F.col("flood_count") * 0.5 + F.col("avg_severity") * 0.5
    )


def urban_sums(urban: DataFrame, radius_m: float = URBAN_SCORE_M, crs: int = 3035) -> DataFrame:
    """building_count (all features) and total_area_m2 (buildings only) per linked site.

    The area is that of all polygons of `shape`; features without one, or tables without the column, have the polygon `rings`.
    """
    near = urban.where((F.col("distance_to_site_m") <= radius_m) & F.col("nearest_site_id").isNotNull())
    shape = shape_of_rings(F.col("rings"))
    if "shape" in urban.columns:
        shape = F.coalesce("shape", shape)
    measured = near.withColumn("_shape", shape).withColumn("_plane", project_shape(F.col("_shape"), crs))
    area = F.when(F.col("feature_type") == "building", shape_area(F.col("_plane"))).otherwise(0.0)
    return (
        measured
        .groupBy(F.col("nearest_site_id").alias("site_id"))
        .agg(F.count("id").alias("building_count"), F.sum(area).alias("total_area_m2"))
    )


def urban_density(
    sites: DataFrame, urban: DataFrame, radius_m: float = URBAN_SCORE_M, crs: int = 3035, strategy: str = "auto"
) -> DataFrame:
    """Linked features within the radius: count + building area in km2."""
    strategy = resolve_strategy(sites, strategy)
    linked = _only_sites(urban_sums(urban, radius_m, crs), sites, strategy)
    return (
        _back_to_sites(sites, linked, strategy)
        .select(
            "site_id",
            F.coalesce(F.col("building_count"), F.lit(0)).cast("long").alias("building_count"),
            _zero("total_area_m2"),
        )
        .withColumn("urban_density_raw", F.col("building_count") + F.col("total_area_m2") / 1e6)
    )


def _only_sites(per_site: DataFrame, sites: DataFrame, strategy: str) -> DataFrame:
    """Rows of known sites: bounds a per-site aggregate by the number of sites."""
    ids = sites.select("site_id")
    return per_site.join(F.broadcast(ids) if strategy == "broadcast" else ids, "site_id", "left_semi")


def climate_stats(climate: DataFrame) -> DataFrame:
    """Mean, deviation and day count per site over the rows that have both measures."""
    return (
        climate.where(F.col("temp_max_c").isNotNull() & F.col("precipitation_mm").isNotNull())
        .groupBy("site_id")
        .agg(
            F.avg("temp_max_c").alias("temp_mean"),
            F.stddev_samp("temp_max_c").alias("temp_stddev"),
            F.avg("precipitation_mm").alias("precip_mean"),
            F.stddev_samp("precipitation_mm").alias("precip_stddev"),
            F.count(F.lit(1)).alias("total_days"),
        )
    )


def with_group_stats(climate: DataFrame, sites: DataFrame, strategy: str = "auto") -> DataFrame:
    """Each climate row of a known site next to that site's own statistics.

    An aggregate joined back rather than a window: a site holding a large share of the rows is
    combined map-side and never sorted in one task.
    """
    strategy = resolve_strategy(sites, strategy)
    stats = _only_sites(climate_stats(climate), sites, strategy)
    return climate.join(F.broadcast(stats) if strategy == "broadcast" else stats, "site_id")


def climate_sums(
    sites: DataFrame, climate: DataFrame, k_temp: float = 2, k_rain: float = 3, strategy: str = "auto"
) -> DataFrame:
    """extreme_days and total_days of the sites that have climate statistics.

    Statistics use rows with both measures; the extreme test runs over all rows, so a row with only
    one measure can be extreme without being counted as a day.
    """
    hot = F.col("temp_max_c") > F.col("temp_mean") + k_temp * F.col("temp_stddev")
    wet = F.col("precipitation_mm") > F.col("precip_mean") + k_rain * F.col("precip_stddev")
    slim = climate.select("site_id", "temp_max_c", "precipitation_mm")
    return (
        with_group_stats(slim, sites, strategy)
        .groupBy("site_id")
        .agg(F.count_if(hot | wet).alias("extreme_days"), F.max("total_days").alias("total_days"))
    )


def anomaly_ratio() -> Column:
    return F.coalesce(F.try_divide(F.col("extreme_days").cast("double"), F.col("total_days")), F.lit(0.0))


def climate_extremes(
    sites: DataFrame, climate: DataFrame, k_temp: float = 2, k_rain: float = 3, strategy: str = "auto"
) -> DataFrame:
    """Share of days with temperature above mean + k_temp sd or rain above mean + k_rain sd."""
    strategy = resolve_strategy(sites, strategy)
    joined = _back_to_sites(sites, climate_sums(sites, climate, k_temp, k_rain, strategy), strategy)
    return joined.select(
        "site_id",
        F.coalesce("extreme_days", F.lit(0)).cast("long").alias("extreme_days"),
        F.coalesce("total_days", F.lit(0)).cast("long").alias("total_days"),
    ).withColumn("anomaly_ratio", anomaly_ratio())


def coastal_columns(sites: DataFrame) -> tuple[Column, Column, Column]:
    """(elevation_m, is_coastal, coastal_risk_score); defaults unless both late columns exist."""
    if not {"elevation_m", "coastal_risk_score"} <= set(sites.columns):
        return F.lit(0.0), F.lit(False), F.lit(0.0)
    elevation = F.col("elevation_m")
    return (
        F.coalesce(elevation, F.lit(0.0)),
        F.coalesce(elevation < COASTAL_ELEVATION_M, F.lit(False)),
        clip01(F.coalesce(F.col("coastal_risk_score"), F.lit(0.0))),
    )


def coastal_scores(sites: DataFrame) -> DataFrame:
    """Coastal row per site."""
    elevation, is_coastal, score = coastal_columns(sites)
    return sites.select(
        "site_id",
        elevation.alias("elevation_m"),
        is_coastal.alias("is_coastal"),
        score.alias("coastal_risk_score"),
    )


def site_density(sites: DataFrame, urban: DataFrame, radius_m: float = URBAN_LINK_M, strategy: str = "auto") -> DataFrame:
    """Count, mean, max and deviation of density_score of the linked features, densest first."""
    strategy = resolve_strategy(sites, strategy)
    per_site = (
        urban.where((F.col("distance_to_site_m") <= radius_m) & F.col("density_score").isNotNull())
        .groupBy(F.col("nearest_site_id").alias("site_id"))
        .agg(
            F.count("id").alias("density_feature_count"),
            F.avg("density_score").alias("avg_density"),
            F.max("density_score").alias("max_density"),
            F.stddev_samp("density_score").alias("stddev_density"),
        )
    )
    side = _only_sites(per_site, sites, strategy)
    named = sites.select("site_id", F.col("name").alias("site_name"))
    return (
        named.join(F.broadcast(side) if strategy == "broadcast" else side, "site_id", "left")
        .select(
            "site_id",
            "site_name",
            F.coalesce("density_feature_count", F.lit(0)).cast("long").alias("density_feature_count"),
            _zero("avg_density"),
            _zero("max_density"),
            _zero("stddev_density"),
        )
        .orderBy(F.desc("avg_density"), "site_id")
    )
