"""Which areas contain a point: a join by a cover of quadtree cells.

Each area is covered by cells of a quadtree over degrees, whose sides are powers of two. A cell that no edge touches lies inside and accepts
its points by the equi-join alone. A border cell keeps the few edges that touch it and whether its centre is inside: a point is inside if
the way from the centre to it crosses an even number of these edges (odd if the centre is outside). Cells are split until EDGES edges are
left, so an area with many vertices becomes many small rows, whatever its size, and no test folds over a whole area.

The cover is built level by level, each written to the work folder. Each distinct place is searched once, in one cell per level in use, and its
points take its areas by an equi-join: only that last join grows with points times areas, as the rows do. The cover is broadcast if its
measured size allows; else both sides shuffle on the cell, and AQE splits hot cells.

Cases: null or empty shapes, lines and points cover nothing; points without a coordinate, or beyond 256 degrees, are in no area; a point in
several areas has a row for each; equal points and areas of one id are all kept. Points exactly on an edge may fall on either side.
Coordinates are plain numbers: an area over the antimeridian has to be cut there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewarden.functions.polygons import ring_edges
from sitewarden.session import stage

HALF_WORLD = 256.0
MAX_LEVEL = 24
EDGES = 8
BROADCAST_BYTES = 32_000_000
_EDGE = "struct<a:struct<x:double,y:double>,b:struct<x:double,y:double>>"


def _size(level: Column) -> Column:
    return F.lit(2 * HALF_WORLD) / F.pow(F.lit(2.0), level)


def _index(v: Column, level: Column) -> Column:
    return F.floor((v + HALF_WORLD) / _size(level)).cast("long")


def _key(level: Column, column: Column, row: Column) -> Column:
    return level.cast("long") * (1 << 2 * MAX_LEVEL) + column * (1 << MAX_LEVEL) + row


def _center(index: Column, level: Column) -> Column:
    return (index + F.lit(0.5)) * _size(level) - HALF_WORLD


def _ends(edge: Column) -> tuple[Column, Column, Column, Column]:
    a, b = edge["a"], edge["b"]
    return a["x"], a["y"], b["x"], b["y"]


def _touches(edge: Column, cx: Column, cy: Column, half: Column) -> Column:
    """Whether an edge meets the closed cell; never false for one that does."""
    ax, ay, bx, by = _ends(edge)
    reach = half * (1 + 1e-9)
    beside = (F.greatest(ax, bx) < cx - reach) | (F.least(ax, bx) > cx + reach) | (F.greatest(ay, by) < cy - reach) | (F.least(ay, by) > cy + reach)
    dx, dy = bx - ax, by - ay
    return ~beside & (F.abs(dx * (cy - ay) - dy * (cx - ax)) <= reach * (F.abs(dx) + F.abs(dy)))


def _crossings(edges: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Edges crossed on the way (x0, y0), (x1, y0), (x1, y1)."""

    def crossed(edge: Column) -> Column:
        ax, ay, bx, by = _ends(edge)
        at_x = ax + (y0 - ay) * F.try_divide(bx - ax, by - ay)
        at_y = ay + (x1 - ax) * F.try_divide(by - ay, bx - ax)
        along = ((ay > y0) != (by > y0)) & (F.least(x0, x1) < at_x) & (at_x <= F.greatest(x0, x1))
        across = ((ax > x1) != (bx > x1)) & (F.least(y0, y1) < at_y) & (at_y <= F.greatest(y0, y1))
        return F.coalesce(along, F.lit(False)).cast("int") + F.coalesce(across, F.lit(False)).cast("int")

    return F.aggregate(edges, F.lit(0), lambda n, edge: n + crossed(edge))


def _roots(areas: DataFrame) -> DataFrame:
    """(area_id, level, column, row, inside, edges): at most four cells that hold each polygon."""
    polygons = areas.where(F.col("shape.kind").isin("POLYGON", "MULTIPOLYGON")).select("area_id", F.explode("shape.polygons").alias("rings"))
    closed = F.filter("rings", lambda ring: (F.size(ring) > 3) & (F.element_at(ring, 1) == F.element_at(ring, -1)))
    shaped = polygons.select("area_id", F.flatten(F.transform(closed, ring_edges)).cast(f"array<{_EDGE}>").alias("edges")).where(F.size("edges") > 0)
    xs, ys = F.transform("edges", lambda e: e["a"]["x"]), F.transform("edges", lambda e: e["a"]["y"])
    boxed = shaped.select("*", F.array_min(xs).alias("x0"), F.array_max(xs).alias("x1"), F.array_min(ys).alias("y0"), F.array_max(ys).alias("y1"))
    wide = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"), F.lit(1e-9))
    level = F.greatest(F.lit(0), F.least(F.lit(MAX_LEVEL), F.floor(F.log2(F.lit(2 * HALF_WORLD) / wide)))).cast("int")
    placed = boxed.withColumn("level", level)

    def span(low: str, high: str) -> Column:
        return F.sequence(_index(F.col(low), F.col("level")), _index(F.col(high), F.col("level")))

    cells = placed.withColumn("column", F.explode(span("x0", "x1"))).withColumn("row", F.explode(span("y0", "y1")))
    cx, cy = _center(F.col("column"), F.col("level")), _center(F.col("row"), F.col("level"))
    # the way starts left of and below the polygon, which is outside
    crossed = _crossings(F.col("edges"), F.col("x0") - 1, F.col("cy"), F.col("cx"), F.col("cy"))
    cells = cells.withColumns({"cx": cx, "cy": cy}).withColumn("inside", crossed % 2 == 1)
    return cells.select("area_id", "level", "column", "row", "inside", _clipped().alias("edges"))


def _clipped() -> Column:
    half = _size(F.col("level")) / 2
    return F.filter("edges", lambda e: _touches(e, F.col("cx"), F.col("cy"), half))


def _children(cells: DataFrame) -> DataFrame:
    """The four parts of each cell, with their own edges."""
    old_x, old_y = _center(F.col("column"), F.col("level")), _center(F.col("row"), F.col("level"))
    corners = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1)])
    parts = cells.withColumns({"old_x": old_x, "old_y": old_y, "part": F.explode(corners)}).select(
        "area_id", (F.col("level") + 1).alias("level"), (F.col("column") * 2 + F.col("part.i")).alias("column"),
        (F.col("row") * 2 + F.col("part.j")).alias("row"), "inside", "edges", "old_x", "old_y",
    )
    cx, cy = _center(F.col("column"), F.col("level")), _center(F.col("row"), F.col("level"))
    parts = parts.withColumns({"cx": cx, "cy": cy})
    crossed = _crossings(F.col("edges"), F.col("old_x"), F.col("old_y"), F.col("cx"), F.col("cy"))
    return parts.select("area_id", "level", "column", "row", (F.col("inside") != (crossed % 2 == 1)).alias("inside"), _clipped().alias("edges"))


def cover(areas: DataFrame, max_edges: int = EDGES) -> DataFrame:
    """Cells of areas (area_id, shape): area_id, level, column, row, inside (of the centre) and the edges of border cells."""
    found = None
    cells = _roots(areas)
    while True:
        cells = stage(cells.where(F.col("inside") | (F.size("edges") > 0)), "cells")
        open_cell = (F.size("edges") > max_edges) & (F.col("level") < MAX_LEVEL)
        done = cells.where(~open_cell)
        found = done if found is None else found.unionByName(done)
        cells = cells.where(open_cell)
        if cells.isEmpty():
            return found
        cells = _children(cells)


def points_in_areas(points: DataFrame, areas: DataFrame, lon: str = "lon", lat: str = "lat", strategy: str = "auto", max_edges: int = EDGES) -> DataFrame:
    """The rows of `points` with the id of each area that contains them, as `area_id`."""
    if "area_id" in (c.lower() for c in points.columns):
        raise ValueError("points have a column area_id")
    cells = stage(cover(areas, max_edges), "cover").withColumn("key", _key(F.col("level"), F.col("column"), F.col("row")))
    used = cells.agg(F.collect_set("level"), F.sum(F.lit(100) + 32 * F.size("edges"))).first()
    levels = sorted(used[0])
    if strategy == "auto":
        strategy = "broadcast" if (used[1] or 0) <= BROADCAST_BYTES else "shuffle"
    x, y = F.col("_x"), F.col("_y")
    within = (F.abs(x) < HALF_WORLD) & (F.abs(y) < HALF_WORLD)
    placed = points.select(F.struct("*").alias("_row"), F.col(lon).cast("double").alias("_x"), F.col(lat).cast("double").alias("_y")).where(within)
    keys = F.array(*[_key(F.lit(n), _index(x, F.lit(n)), _index(y, F.lit(n))) for n in levels]).cast("array<bigint>")
    joined = placed.select("_x", "_y").distinct().withColumn("key", F.explode(keys)).join(F.broadcast(cells) if strategy == "broadcast" else cells, "key")
    crossed = _crossings(F.col("edges"), _center(F.col("column"), F.col("level")), _center(F.col("row"), F.col("level")), x, y)
    # inside cells have no edge to fold over
    found = joined.where(F.when(F.size("edges") == 0, F.col("inside")).otherwise(F.col("inside") != (crossed % 2 == 1))).select("_x", "_y", "area_id")
    # written, so that Spark knows its size before it plans the join
    return placed.join(stage(found, "place_areas"), ["_x", "_y"]).select("_row.*", "area_id")
