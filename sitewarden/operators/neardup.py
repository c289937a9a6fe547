"""Removal of near-duplicate fire detections, in order of arrival.

A detection is skipped if a kept one of the same satellite, date and time lies within the radius. Detections at one place decide alike after
the first of them, so only the first of each place takes part, counted map-side.

The rest is sequential by definition. Detections are dealt to blocks much larger than the radius, each also to the blocks its circle touches, and a task walks
through a block in order of arrival, as a stream: it holds only what it kept, found by a hash of small cells. A detection that hangs on one of
another block that is not decided there is left open, as are those that hang on it. Later rounds take the open ones and the kept ones near
them in blocks GROWTH times as large, up to the whole globe: a handful of rounds, whatever the chains, most often one.
Each round is a written table. The result equals the row-by-row rule.

Detections without satellite, date, time or coordinates have no duplicates and stay.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewarden.constants import NEAR_DUPLICATE_M
from sitewarden.functions.cells import GeoGrid
from sitewarden.functions.geodesy import MEAN_RADIUS_M, WGS84_A, WGS84_F, geodesic_m
from sitewarden.session import stage

BLOCK_KM = 25.0
GROWTH = 8.0
GLOBE_KM = 20_100.0
_KEYS = ["satellite", "acq_date", "acq_time"]
_AROUND = list(product((-1, 0, 1), repeat=3))


def _complete() -> Column:
    known = F.lit(True)
    for c in (*_KEYS, "lon", "lat"):
        known = known & F.col(c).isNotNull()
    return known & ~F.isnan("lon") & ~F.isnan("lat")


def _near_cells(rows: DataFrame, places: DataFrame, radius_m: float, how: str, condition: Column | None = None) -> DataFrame:
    """Semi or anti join of rows with the places (columns keys, lon, lat) whose circle touches the row's cell."""
    grid = GeoGrid(radius_m / 1000.0)
    around = places.select(
        *[F.col(c).alias(f"r_{c}") for c in _KEYS],
        F.col("lon").alias("o_lon"),
        F.col("lat").alias("o_lat"),
        F.explode(grid.cover(F.col("lon"), F.col("lat"), radius_m / 1000.0)).alias("r_cell"),
    )
    on = F.col("cell") == F.col("r_cell")
    for c in _KEYS:
        on = on & (F.col(c) == F.col(f"r_{c}"))
    if condition is not None:
        on = on & condition
    return rows.withColumn("cell", grid.cell_of(F.col("lon"), F.col("lat"))).join(around, on, how).drop("cell")


def not_near_stored(
    new: DataFrame, stored: DataFrame, radius_m: float = NEAR_DUPLICATE_M, method: str = "spheroid"
) -> DataFrame:
    """New detections without a stored one of the same satellite, date and time within the radius."""
    places = stored.select(*_KEYS, "lon", "lat").where(_complete()).distinct()
    near = geodesic_m(F.col("lat"), F.col("lon"), F.col("o_lat"), F.col("o_lon"), method) <= radius_m
    return _near_cells(new, places, radius_m, "left_anti", near)


class _Block:
    """What a walk through one block has kept or left open so far."""

    def __init__(self, radius_m: float, method: str):
        self.radius_m, self.spheroid = radius_m, method == "spheroid"
        self.cells: dict[tuple[int, int, int], list[tuple[float, float, bool]]] = {}

    def metres(self, b1: float, l1: float, b2: float, l2: float) -> float:
        """As chord_to_m, from latitudes on the auxiliary sphere and longitudes in radians."""
        s, t = math.sin((b2 - b1) / 2), math.sin((l2 - l1) / 2)
        h = min(1.0, s * s + math.cos(b1) * math.cos(b2) * t * t)
        sigma = 2 * math.asin(math.sqrt(h))
        if not self.spheroid:
            return MEAN_RADIUS_M * sigma
        sin_sigma = 2 * math.sqrt(h * (1 - h))
        p = math.sin((b1 + b2) / 2)
        near = (sigma - sin_sigma) * p * p * (1 - s * s) / (1 - h) if h < 1 else 0.0
        far = (sigma + sin_sigma) * (1 - p * p) * s * s / h if h > 0 else 0.0
        return WGS84_A * (sigma - WGS84_F / 2 * (near + far))

    def nearest_state(self, cell: tuple[int, int, int], b: float, lon: float) -> bool | None:
        """True if a kept place is within the radius, False if only open ones are, None if nothing is."""
        found = None
        x, y, z = cell
        for i, j, k in _AROUND:
            for other_b, other_lon, kept in self.cells.get((x + i, y + j, z + k), ()):
                if (kept or found is None) and self.metres(other_b, other_lon, b, lon) <= self.radius_m:
                    if kept:
                        return True
                    found = False
        return found

    def add(self, cell: tuple[int, int, int], b: float, lon: float, kept: bool) -> None:
        self.cells.setdefault(cell, []).append((b, lon, kept))


def _one_round(rows: DataFrame, order: str, radius_m: float, method: str, block_km: float) -> DataFrame:
    """The kept (decided) and open rows of `rows` (order, keys, lon, lat, decided); decided ones of before are not returned."""
    grid = GeoGrid(block_km)
    place = (F.col("lon"), F.col("lat"))
    blocks = F.explode(grid.cover(*place, radius_m / 1000.0)).alias("block")
    spread = rows.select("*", grid.cell_of(*place).alias("own"), blocks)
    dealt = spread.repartition(*_KEYS, "block").sortWithinPartitions(*_KEYS, "block", order)
    names = [order, *_KEYS, "lon", "lat"]
    # cubes of the auxiliary sphere, a little wider than the radius
    cube_m = 1.02 * radius_m
    sphere_m = WGS84_A if method == "spheroid" else MEAN_RADIUS_M

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, block = None, None
        for batch in batches:
            lon = np.radians(batch.column("lon").to_numpy())
            lat = np.radians(batch.column("lat").to_numpy())
            b = np.arctan((1 - WGS84_F) * np.tan(lat)) if method == "spheroid" else lat
            unit = np.stack([np.cos(b) * np.cos(lon), np.cos(b) * np.sin(lon), np.sin(b)], axis=1)
            cells = np.floor(unit * (sphere_m / cube_m)).astype(np.int64).tolist()
            walk = zip(*(batch.column(c).to_pylist() for c in (*_KEYS, "block")), strict=True)
            mine = [o == k for o, k in zip(batch.column("own").to_pylist(), batch.column("block").to_pylist(), strict=True)]
            before = batch.column("decided").to_pylist()
            at, decided = [], []
            for i, (where, cell, x, y) in enumerate(zip(walk, map(tuple, cells), b.tolist(), lon.tolist(), strict=True)):
                if where != last:
                    last, block = where, _Block(radius_m, method)
                if before[i]:
                    block.add(cell, x, y, True)
                    continue
                state = block.nearest_state(cell, x, y)
                if state:
                    continue
                # a guest may hang on rows that only its own block sees
                kept = state is None and mine[i]
                block.add(cell, x, y, kept)
                if mine[i]:
                    at.append(i)
                    decided.append(kept)
            if at:
                out = batch.select(names).take(pa.array(at))
                yield pa.RecordBatch.from_arrays([*out.columns, pa.array(decided)], [*names, "decided"])

    wanted = dealt.select(*names, "decided", "own", "block")
    return wanted.mapInArrow(task, rows.select(*names, "decided").schema)


def drop_near_duplicates(
    new: DataFrame,
    stored: DataFrame | None = None,
    radius_m: float = NEAR_DUPLICATE_M,
    order: str = "ord",
    method: str = "spheroid",
    block_km: float = BLOCK_KM,
) -> DataFrame:
    """Rows of `new` that the arrival-order rule keeps; `order` is unique."""
    if stored is not None:
        new = not_near_stored(new, stored, radius_m, method)
    places = new.where(_complete()).groupBy(*_KEYS, "lon", "lat").agg(F.min(order).alias(order))
    rows = places.select(order, *_KEYS, "lon", "lat", F.lit(False).alias("decided"))
    kept: list[DataFrame] = []
    while True:
        found = stage(_one_round(rows, order, radius_m, method, block_km), "decided")
        won, undecided = found.where("decided"), found.where("not decided")
        kept.append(won.select(order))
        if block_km >= GLOBE_KM or undecided.isEmpty():
            break
        # kept rows of earlier rounds have already met these
        rows = undecided.unionByName(_near_cells(won, undecided, radius_m, "left_semi"))
        block_km = min(block_km * GROWTH, GLOBE_KM)
    all_kept = kept[0]
    for more in kept[1:]:
        all_kept = all_kept.unionByName(more)
    return new.where(_complete()).join(all_kept, order, "left_semi").unionByName(new.where(~_complete()))
