"""Grid cells: they turn a distance predicate into an equi-join key.

`cell_of` puts a point into exactly one lon/lat cell, `cover` lists every cell that a circle can
touch. Bands have equal height; the number of cells in a band shrinks with the cosine of its
poleward edge, so no cell is narrower than the cell size. Poles and the antimeridian need no
special case. Keys are one long, which Spark's hash joins handle without boxing.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from sitewarden.functions.geodesy import MEAN_RADIUS_M

# a degree of latitude is nowhere shorter than 110.57 km
_KM_PER_DEGREE = 110.5
# sphere and spheroid distances differ by less than 0.6 %
_SPHEROID_SLACK = 1.01


def _never_null(key: Column) -> Column:
    """A join key the optimizer need not filter: an inferred `isnotnull` would evaluate it twice.

    -1 may meet a real cell; the exact distance test then drops the pair, as its distance is NULL.
    """
    return F.coalesce(key, F.lit(-1).cast("long"))


class GeoGrid:
    """Lon/lat grid with cells of at least `cell_km`."""

    def __init__(self, cell_km: float):
        self.step = min(cell_km / _KM_PER_DEGREE, 180.0)
        self.bands = max(1, math.ceil(180.0 / self.step))

    def _band(self, lat: Column) -> Column:
        raw = F.floor((lat + 90.0) / self.step)
        return F.greatest(F.lit(0), F.least(F.lit(self.bands - 1), raw)).cast("long")

    def _width(self, band: Column) -> Column:
        low = band * self.step - 90.0
        poleward = F.least(F.lit(90.0), F.greatest(F.abs(low), F.abs(low + self.step)))
        return F.greatest(F.lit(1), F.floor(360.0 * F.cos(F.radians(poleward)) / self.step)).cast("long")

    @staticmethod
    def _key(band: Column, column: Column) -> Column:
        return F.shiftleft(band, 32) + column

    def cell_of(self, lon: Column, lat: Column) -> Column:
        band = self._band(lat)
        width = self._width(band)
        column = F.floor(F.pmod(lon + 180.0, F.lit(360.0)) / 360.0 * width) % width
        return _never_null(self._key(band, column))

    def cover(self, lon: Column, lat: Column, radius_km: float) -> Column:
        """array<long> of the cells that hold any point within `radius_km`."""
        reach = _SPHEROID_SLACK * radius_km * 1000.0 / MEAN_RADIUS_M
        reach_deg = math.degrees(reach)
        to_pole = F.abs(lat) + reach_deg >= 90.0
        sin_reach = math.sin(min(reach, math.pi / 2))
        dlon = F.when(to_pole, F.lit(180.0)).otherwise(
            F.degrees(F.asin(F.least(F.lit(1.0), sin_reach / F.cos(F.radians(lat)))))
        )

        def in_band(band: Column) -> Column:
            width = self._width(band)
            first = F.floor((lon + 180.0 - dlon) / 360.0 * width)
            last = F.floor((lon + 180.0 + dlon) / 360.0 * width)
            return F.transform(
                F.sequence(first, F.least(last, first + width - 1)),
                lambda c: self._key(band, F.pmod(c, width)),
            )

        bands = F.sequence(self._band(lat - reach_deg), self._band(lat + reach_deg))
        return F.flatten(F.transform(bands, in_band))


class PlaneGrid:
    """Square cells in a projected CRS."""

    def __init__(self, cell_m: float):
        self.cell_m = float(cell_m)

    def _index(self, v: Column) -> Column:
        return F.floor(v / self.cell_m).cast("long")

    @staticmethod
    def key(column: Column, row: Column) -> Column:
        return F.shiftleft(row, 32) + F.pmod(column, F.lit(1 << 32))

    def cell_of(self, x: Column, y: Column) -> Column:
        return _never_null(self.key(self._index(x), self._index(y)))

    def cover(self, x: Column, y: Column, radius_m: float) -> Column:
        """array<long> of the cells that hold any point within `radius_m`."""
        rows = F.sequence(self._index(y - radius_m), self._index(y + radius_m))
        columns = F.sequence(self._index(x - radius_m), self._index(x + radius_m))
        return F.flatten(
            F.transform(rows, lambda r: F.transform(columns, lambda c: self.key(c, r)))
        )
