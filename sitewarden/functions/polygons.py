"""Polygon measures over `array<array<struct<x,y>>>` columns.

The first ring is the shell, the others are holes; an open ring is a line, of area 0. A point is one ring of one
vertex. All measures fold over the arrays inside the JVM. Pass plain columns: an expression as
argument would be evaluated once per reference, so project the rings into a column first
(`with_plane_rings`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewarden.functions.geodesy import planar_m, project


def project_rings(rings: Column, crs: int = 3035) -> Column:
    """Project every vertex."""
    return F.transform(
        rings, lambda ring: F.transform(ring, lambda p: project(p.getField("x"), p.getField("y"), crs))
    )


def with_plane_rings(df: DataFrame, crs: int = 3035, name: str = "rings_m") -> DataFrame:
    """Add the projected rings as a column of their own."""
    return df.withColumn(name, project_rings(F.col("rings"), crs))


def ring_edges(ring: Column) -> Column:
    """array<struct<a,b>> of consecutive vertices; empty for a point."""
    last = F.size(ring) - 1
    return F.zip_with(
        F.slice(ring, F.lit(1), last), F.slice(ring, F.lit(2), last), lambda a, b: F.struct(a.alias("a"), b.alias("b"))
    )


def _fields(edge: Column) -> tuple[Column, Column, Column, Column]:
    a, b = edge.getField("a"), edge.getField("b")
    return a.getField("x"), a.getField("y"), b.getField("x"), b.getField("y")


def _moments(ring: Column, ox: Column, oy: Column) -> Column:
    """Signed shoelace sums of one ring around an origin, in one fold: area2, mx, my."""

    def add(acc: Column, edge: Column) -> Column:
        ax, ay, bx, by = _fields(edge)
        ax, ay, bx, by = ax - ox, ay - oy, bx - ox, by - oy
        cross = ax * by - bx * ay
        return F.struct(
            (acc.getField("area2") + cross).alias("area2"),
            (acc.getField("mx") + (ax + bx) * cross).alias("mx"),
            (acc.getField("my") + (ay + by) * cross).alias("my"),
        )

    zero = F.struct(F.lit(0.0).alias("area2"), F.lit(0.0).alias("mx"), F.lit(0.0).alias("my"))
    # an open ring is a line: it encloses nothing
    open_ring = F.element_at(ring, 1) != F.element_at(ring, -1)
    return F.when(open_ring, zero).otherwise(F.aggregate(ring_edges(ring), zero, add))


def shape_moments(rings: Column) -> Column:
    """Shell minus holes, whatever the direction of the rings: area, mx, my around the first vertex."""
    origin = F.element_at(F.element_at(rings, 1), 1)
    ox, oy = origin.getField("x"), origin.getField("y")
    per_ring = F.transform(rings, lambda ring: _moments(ring, ox, oy))
    signed = F.transform(
        per_ring,
        lambda m, i: F.struct(
            m.alias("m"), (F.signum(m.getField("area2")) * F.when(i == 0, 1.0).otherwise(-1.0)).alias("s")
        ),
    )

    def add(acc: Column, item: Column) -> Column:
        m, s = item.getField("m"), item.getField("s")
        return F.struct(
            (acc.getField("area") + s * m.getField("area2") / 2).alias("area"),
            (acc.getField("mx") + s * m.getField("mx") / 6).alias("mx"),
            (acc.getField("my") + s * m.getField("my") / 6).alias("my"),
        )

    zero = F.struct(F.lit(0.0).alias("area"), F.lit(0.0).alias("mx"), F.lit(0.0).alias("my"))
    return F.aggregate(signed, zero, add)


def st_area(rings: Column) -> Column:
    """Area in the units of the coordinates; 0 for points, NULL for NULL."""
    return shape_moments(rings).getField("area")


def st_centroid(rings: Column) -> Column:
    """Area-weighted centroid struct<x,y>; the mean vertex when the area is zero."""
    shell = F.element_at(rings, 1)
    origin = F.element_at(shell, 1)

    def mean(axis: str) -> Column:
        return F.aggregate(shell, F.lit(0.0), lambda acc, p: acc + p.getField(axis)) / F.size(shell)

    def from_moments(m: Column) -> Column:
        area = m.getField("area")
        x = origin.getField("x") + m.getField("mx") / area
        y = origin.getField("y") + m.getField("my") / area
        return F.when(area > 0, F.struct(x.alias("x"), y.alias("y"))).otherwise(
            F.struct(mean("x").alias("x"), mean("y").alias("y"))
        )

    # a one-element transform names the moments, so they are folded once
    return F.element_at(F.transform(F.array(shape_moments(rings)), from_moments), 1)


def st_within(x: Column, y: Column, rings: Column) -> Column:
    """Even-odd rule over shell and holes."""

    def hit(edge: Column) -> Column:
        ax, ay, bx, by = _fields(edge)
        at = ax + (y - ay) * F.try_divide(bx - ax, by - ay)
        return F.when(((ay > y) != (by > y)) & (x < at), 1).otherwise(0)

    hits = F.aggregate(
        rings, F.lit(0), lambda acc, ring: F.aggregate(ring_edges(ring), acc, lambda n, edge: n + hit(edge))
    )
    return hits % 2 == 1


def _segment_m(edge: Column, x: Column, y: Column) -> Column:
    ax, ay, bx, by = _fields(edge)
    dx, dy = bx - ax, by - ay
    along = F.try_divide((x - ax) * dx + (y - ay) * dy, dx * dx + dy * dy)
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(along, F.lit(0.0))))
    return planar_m(x, y, ax + t * dx, ay + t * dy)


def st_distance(rings: Column, x: Column, y: Column) -> Column:
    """0 inside, else the distance to the nearest edge (or vertex, for points)."""
    to_edge = F.array_min(F.transform(F.flatten(F.transform(rings, ring_edges)), lambda e: _segment_m(e, x, y)))
    to_vertex = F.array_min(
        F.transform(F.flatten(rings), lambda p: planar_m(x, y, p.getField("x"), p.getField("y")))
    )
    return F.when(st_within(x, y, rings), F.lit(0.0)).otherwise(F.coalesce(to_edge, to_vertex))


def max_vertex_m(rings: Column, x: Column, y: Column) -> Column:
    """Distance to the farthest vertex: below r exactly when the shape lies inside the r-circle."""
    return F.array_max(
        F.transform(F.flatten(rings), lambda p: planar_m(x, y, p.getField("x"), p.getField("y")))
    )
