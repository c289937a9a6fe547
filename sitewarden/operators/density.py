"""Gaussian kernel density at every point, linear in the number of points.

Plain grid KDE pairs each point with all points of the neighbouring cells, which is quadratic where
points crowd. Here a crowded box of side h is condensed: its points are replaced by p x p weighted
Chebyshev nodes (the transpose of polynomial interpolation), and the density inside it is evaluated
at those nodes and interpolated back to its points. The kernel is smooth on the scale of a box, so
with 12 nodes per side both steps are exact to about 1e-11 of the kernel's peak. Sparse boxes keep
their points. After condensing no box holds more than p*p sources, so the pair join is bounded by
the area covered, whatever the data volume and however much of it lies in one place.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewarden.constants import KDE_BANDWIDTH_M
from sitewarden.functions.cells import PlaneGrid
from sitewarden.functions.geodesy import let, to_3857
from sitewarden.functions.polygons import st_centroid
from sitewarden.session import stage

NODES = 12
_BOX = ["bx", "by"]
# tasks a full cell is split over; its sources, at most 64 boxes of nodes, are repeated as often
_SALTS = 16


def _with_basis(df: DataFrame, h: float) -> DataFrame:
    """Add arrays lx, ly: the Lagrange basis of the Chebyshev nodes of the point's box, per axis."""
    # factors[m][k - 1] = 2/p cos(k theta_m)
    factors = F.array(
        *[
            F.array(*[F.lit(2.0 / NODES * math.cos(k * (2 * m + 1) * math.pi / (2 * NODES))) for k in range(1, NODES)])
            for m in range(NODES)
        ]
    )

    def basis(v: str, box: str) -> Column:
        u = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), 2.0 * (F.col(v) / h - F.col(box)) - 1.0))
        # named values: inside a lambda an expression would be evaluated once per element
        waves = let(
            F.acos(u), lambda theta: F.transform(F.sequence(F.lit(1), F.lit(NODES - 1)), lambda k: F.cos(k * theta))
        )
        return let(waves, lambda w: F.transform(factors, lambda f: _dot(f, w, 1.0 / NODES)))

    return df.withColumns({"lx": basis("x", "bx"), "ly": basis("y", "by")})


def _dot(a: Column, b: Column, start: float = 0.0) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda p, q: p * q), F.lit(start), lambda acc, t: acc + t)


def _node_position(box: Column, angle: Column, h: float) -> Column:
    return (box + (F.cos(angle) + 1.0) / 2.0) * h


def _node_grid(boxes: DataFrame, h: float) -> DataFrame:
    """The p x p nodes of each box: bx, by, m, n, x, y."""
    index = F.sequence(F.lit(0), F.lit(NODES - 1))
    step = math.pi / (2 * NODES)
    return (
        boxes.withColumn("m", F.explode(index))
        .withColumn("n", F.explode(index))
        .withColumn("x", _node_position(F.col("bx"), (2 * F.col("m") + 1) * step, h))
        .withColumn("y", _node_position(F.col("by"), (2 * F.col("n") + 1) * step, h))
    )


def _condense(points: DataFrame, h: float) -> DataFrame:
    """Node weights of the points' boxes: bx, by, x, y, w."""
    based = _with_basis(points, h)
    per_row = based.select(
        *_BOX, "w", "ly", F.posexplode("lx").alias("m", "lx")
    )
    sums = per_row.groupBy(*_BOX, "m").agg(
        *[F.sum(F.col("w") * F.col("lx") * F.col("ly")[n]).alias(f"w{n}") for n in range(NODES)]
    )
    step = math.pi / (2 * NODES)
    return sums.select(
        *_BOX,
        _node_position(F.col("bx"), (2 * F.col("m") + 1) * step, h).alias("x"),
        F.posexplode(F.array(*[f"w{n}" for n in range(NODES)])).alias("n", "w"),
    ).select(*_BOX, "x", _node_position(F.col("by"), (2 * F.col("n") + 1) * step, h).alias("y"), "w")


def kernel_sums(
    targets: DataFrame, sources: DataFrame, h: float, cutoff: float, carry: Sequence[str] = ()
) -> DataFrame:
    """Per target: sum of w exp(-d^2 / 2h^2) over the sources within the 3 x 3 cells around it."""
    grid = PlaneGrid(cutoff * h)
    salt = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(_SALTS - 1).cast("long")))
    placed = sources.select(
        F.col("x").alias("sx"), F.col("y").alias("sy"), "w", grid.cell_of(F.col("x"), F.col("y")).alias("cell")
    ).withColumn("salt", salt)
    # few bytes but many pairs: a fixed partition count keeps AQE from merging the work into one task
    spread = int(targets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    reach = targets.select(
        "x",
        "y",
        *carry,
        F.pmod(F.xxhash64("x", "y"), F.lit(_SALTS)).alias("salt"),
        F.explode(grid.cover(F.col("x"), F.col("y"), cutoff * h)).alias("cell"),
    ).repartition(spread, "cell", "salt")
    dx, dy = F.col("x") - F.col("sx"), F.col("y") - F.col("sy")
    return (
        reach.join(placed, ["cell", "salt"])
        .groupBy("x", "y", *carry)
        .agg(F.sum(F.col("w") * F.exp((dx * dx + dy * dy) * (-0.5 / (h * h)))).alias("kernel_sum"))
    )


def gaussian_kde(
    points: DataFrame,
    bandwidth_m: float = KDE_BANDWIDTH_M,
    cutoff: float = 8.0,
    box_points: int = NODES * NODES,
) -> DataFrame:
    """Append density_score to points with x, y: (1 / (N 2 pi h^2)) sum exp(-d^2 / 2h^2), self included.

    `cutoff` is the cell size in bandwidths; pairs farther apart than that add less than exp(-32)
    each. Boxes of more than `box_points` distinct places are condensed.
    """
    h = float(bandwidth_m)
    places = (
        points.where(F.col("x").isNotNull() & F.col("y").isNotNull())
        .groupBy("x", "y")
        .agg(F.count(F.lit(1)).cast("double").alias("w"))
        .withColumns({"bx": F.floor(F.col("x") / h), "by": F.floor(F.col("y") / h)})
    )
    crowded = (
        places.groupBy(*_BOX).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > box_points).select(*_BOX, F.lit(True).alias("crowded"))
    )
    # written once: every later step starts from it
    places = stage(places.join(crowded, _BOX, "left").withColumn("crowded", F.coalesce("crowded", F.lit(False))), "places")
    total = places.agg(F.sum("w")).scalar()
    sparse, dense = places.where(~F.col("crowded")), places.where("crowded")
    if dense.isEmpty():
        sums = kernel_sums(places, places, h, cutoff)
    else:
        nodes = _node_grid(dense.select(*_BOX).distinct(), h)
        sources = sparse.select("x", "y", "w").unionByName(_condense(dense, h).select("x", "y", "w"))
        targets = sparse.select("x", "y", *_BOX, F.lit(-1).alias("i")).unionByName(
            nodes.select("x", "y", *_BOX, (F.col("m") * NODES + F.col("n")).alias("i"))
        )
        at = stage(kernel_sums(targets, sources, h, cutoff, [*_BOX, "i"]), "kernel_sums")
        sums = at.where("i < 0").select("x", "y", "kernel_sum").unionByName(_interpolate(dense, at.where("i >= 0"), h))
    density = sums.select("x", "y", (F.col("kernel_sum") / (total * (2 * math.pi * h * h))).alias("density_score"))
    return points.join(density, ["x", "y"], "left").select(*points.columns, "density_score")


def _interpolate(dense: DataFrame, at_nodes: DataFrame, h: float) -> DataFrame:
    """Kernel sums of the points of crowded boxes from the sums at the boxes' nodes."""
    # p*p values per box, node (m, n) at m*p + n
    per_box = at_nodes.groupBy(*_BOX).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("i", "kernel_sum"))), lambda v: v["kernel_sum"]).alias("values")
    )

    def combined(v: Column) -> Column:
        rows = F.transform(
            v.getField("lx"), lambda b, m: b * _dot(F.slice("values", m * NODES + 1, F.lit(NODES)), v.getField("ly"))
        )
        return F.aggregate(rows, F.lit(0.0), lambda acc, t: acc + t)

    based = _with_basis(dense.join(per_box, _BOX), h)
    return based.select("x", "y", let(F.struct("lx", "ly"), combined).alias("kernel_sum"))


def urban_kde(urban: DataFrame, bandwidth_m: float = KDE_BANDWIDTH_M, cutoff: float = 8.0) -> DataFrame:
    """density_score of each feature's centroid in EPSG:3857 (centroid first, then projected)."""
    centred = urban.where(F.col("rings").isNotNull()).withColumn("_c", st_centroid(F.col("rings")))
    placed = centred.withColumn("_p", to_3857(F.col("_c.x"), F.col("_c.y"))).select(
        *urban.columns, F.col("_p.x").alias("x"), F.col("_p.y").alias("y")
    )
    # written once: the density is joined back to exactly these rows
    return gaussian_kde(stage(placed, "centroids"), bandwidth_m, cutoff).drop("x", "y")
