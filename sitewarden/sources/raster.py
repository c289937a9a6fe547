"""Raster sampling against a table of cells."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RasterTransform:
    """North-up raster: upper-left corner, cell size and the missing marker."""

    x0: float
    y0: float
    dx: float
    dy: float
    nodata: float | None = None


def sample_raster(
    points: DataFrame, cells: DataFrame, transform: RasterTransform, name: str = "value", salts: int = 1
) -> DataFrame:
    """Append the value of the cell (row, col, value) under each point; NULL outside and for nodata.

    An equi-join on (row, col). Where many points share few cells, `salts` spreads a cell's points
    over that many tasks.
    """
    t = transform
    value = F.col("value").cast("double")
    if t.nodata is not None:
        value = F.nullif(value, F.lit(float(t.nodata)))
    table = cells.select(F.col("row").cast("long").alias("_r"), F.col("col").cast("long").alias("_c"), value.alias(name))
    placed = points.withColumns(
        {
            "_r": F.floor((F.lit(t.y0) - F.col("lat")) / t.dy).cast("long"),
            "_c": F.floor((F.col("lon") - t.x0) / t.dx).cast("long"),
        }
    )
    keys = ["_r", "_c"]
    if salts > 1:
        placed = placed.withColumn("_s", F.pmod(F.xxhash64(*points.columns), F.lit(salts)))
        table = table.withColumn("_s", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
        keys.append("_s")
    return placed.join(table, keys, "left").select(*points.columns, name)
