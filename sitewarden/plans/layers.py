"""Map layers of the scored sites."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewarden.constants import RISK_COLORS, SCORE_COLUMNS, UNKNOWN_COLOR


def _color(level: Column) -> Column:
    chain = None
    for name, color in RISK_COLORS.items():
        chain = F.when(level == name, color) if chain is None else chain.when(level == name, color)
    return chain.otherwise(UNKNOWN_COLOR)


def markers(view: DataFrame) -> DataFrame:
    """One styled marker per site; popup scores carry two decimals."""
    flagged = F.col("is_anomaly")
    fill = _color(F.col("risk_level"))
    return view.select(
        "site_id",
        F.col("name").alias("tooltip"),
        "country",
        "category",
        "date_inscribed",
        "in_danger",
        F.col("lat").alias("latitude"),
        F.col("lon").alias("longitude"),
        F.when(flagged, RISK_COLORS["critical"]).otherwise(fill).alias("color"),
        fill.alias("fill_color"),
        F.when(flagged, 8).otherwise(5).alias("radius"),
        F.when(flagged, 3).otherwise(1).alias("weight"),
        F.when(flagged, 0.9).otherwise(0.7).alias("fill_opacity"),
        *[F.round(c, 2).alias(c) for c in (*SCORE_COLUMNS, "composite_risk_score")],
        F.initcap("risk_level").alias("level_label"),
        flagged.alias("is_anomaly"),
    )


def heat(view: DataFrame) -> DataFrame:
    """Heat map points weighted by the composite score."""
    return view.select(
        "site_id", F.col("lat").alias("latitude"), F.col("lon").alias("longitude"), "composite_risk_score"
    )


def clusters(view: DataFrame, cell_deg: float = 10.0) -> DataFrame:
    """Markers counted per grid cell, with the mean position and the highest score."""
    return (
        view.groupBy(
            F.floor((F.col("lon") + 180.0) / cell_deg).cast("long").alias("cell_x"),
            F.floor((F.col("lat") + 90.0) / cell_deg).cast("long").alias("cell_y"),
        )
        .agg(
            F.count(F.lit(1)).alias("sites"),
            F.avg("lat").alias("latitude"),
            F.avg("lon").alias("longitude"),
            F.max("composite_risk_score").alias("max_score"),
        )
    )


def map_layers(view: DataFrame, cell_deg: float = 10.0) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(markers, heat, clusters)."""
    return markers(view), heat(view), clusters(view, cell_deg)


def write_layers(view: DataFrame, path: str, cell_deg: float = 10.0) -> None:
    """The three layers as JSON files."""
    for name, layer in zip(("markers", "heat", "clusters"), map_layers(view, cell_deg), strict=True):
        layer.write.mode("overwrite").json(f"{path}/{name}")
