"""Projections and distances as Catalyst expressions (degrees in, metres out)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: GRS80 / EPSG:3035 -----------------------------------------
GRS80_A = 6378137.0
GRS80_F = 1 / 298.257222101
LAEA_LAT0 = 52.0
LAEA_LON0 = 10.0
LAEA_FALSE_EASTING = 4321000.0
LAEA_FALSE_NORTHING = 3210000.0
# --- fixed values: WGS84 and mean sphere -------------------------------------
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563
MEAN_RADIUS_M = 6371008.8

_E2 = GRS80_F * (2 - GRS80_F)
_E = math.sqrt(_E2)


def _authalic_q(sin_lat: float) -> float:
    return (1 - _E2) * (
        sin_lat / (1 - _E2 * sin_lat**2) - math.log((1 - _E * sin_lat) / (1 + _E * sin_lat)) / (2 * _E)
    )


_QP = _authalic_q(1.0)
_SIN0 = math.sin(math.radians(LAEA_LAT0))
_SIN_B0 = _authalic_q(_SIN0) / _QP
_COS_B0 = math.sqrt(1 - _SIN_B0**2)
LAEA_RADIUS_M = GRS80_A * math.sqrt(_QP / 2)
_D = GRS80_A * math.cos(math.radians(LAEA_LAT0)) / math.sqrt(1 - _E2 * _SIN0**2) / (LAEA_RADIUS_M * _COS_B0)


def _xy(x: Column, y: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"))


def st_point(lon: Column, lat: Column) -> Column:
    """Point as struct<x,y>; NULL if either coordinate is NULL."""
    return F.when(lon.isNotNull() & lat.isNotNull(), _xy(lon.cast("double"), lat.cast("double")))


def st_x(point: Column) -> Column:
    return point.getField("x")


def st_y(point: Column) -> Column:
    return point.getField("y")


_NUMBER = r"([-+]?[0-9]*\.?[0-9]+(?:[eE][-+]?[0-9]+)?)"
_POINT_PATTERN = r"(?i)^\s*(?:SRID=\d+;)?POINT\s*\(\s*" + _NUMBER + r"\s+" + _NUMBER + r"\s*\)\s*$"


def parse_point_wkt(wkt: Column) -> Column:
    """'POINT(lon lat)' -> struct<x=lon,y=lat>; anything else -> NULL."""
    lon = F.regexp_extract(wkt, _POINT_PATTERN, 1).try_cast("double")
    lat = F.regexp_extract(wkt, _POINT_PATTERN, 2).try_cast("double")
    return st_point(lon, lat)


def to_wkt(lon: Column, lat: Column) -> Column:
    """Point text with six decimals."""
    return F.format_string("POINT(%.6f %.6f)", lon, lat)


def let(value: Column, body) -> Column:
    """Evaluate `value` once and use it in `body`, by way of a one-element array."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _sin_beta(sin_lat: Column) -> Column:
    """Sine of the authalic latitude."""
    q = (1 - _E2) * (
        sin_lat / (1 - _E2 * sin_lat * sin_lat) - F.log((1 - _E * sin_lat) / (1 + _E * sin_lat)) / (2 * _E)
    )
    return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), q / _QP))


def _spread(sin_b: Column, cos_b: Column, dlon: Column) -> Column:
    return 1 + _SIN_B0 * sin_b + _COS_B0 * cos_b * F.cos(dlon)


def _scale(spread: Column) -> Column:
    """NULL at the antipode, where the projection is singular."""
    return F.when(spread > 1e-12, LAEA_RADIUS_M * F.sqrt(2 / spread))


def _easting(b: Column, cos_b: Column, dlon: Column) -> Column:
    return LAEA_FALSE_EASTING + b * _D * cos_b * F.sin(dlon)


def _northing(b: Column, sin_b: Column, cos_b: Column, dlon: Column) -> Column:
    return LAEA_FALSE_NORTHING + b / _D * (_COS_B0 * sin_b - _SIN_B0 * cos_b * F.cos(dlon))


def to_3035(lon: Column, lat: Column) -> Column:
    """ETRS89 / LAEA Europe as struct<x,y>; NULL coordinates at the antipode."""

    def placed(v: Column) -> Column:
        sin_b, cos_b, dlon, b = (v.getField(n) for n in ("s", "c", "d", "b"))
        return _xy(_easting(b, cos_b, dlon), _northing(b, sin_b, cos_b, dlon))

    def scaled(v: Column) -> Column:
        sin_b, cos_b, dlon = (v.getField(n) for n in ("s", "c", "d"))
        b = _scale(_spread(sin_b, cos_b, dlon))
        return let(F.struct(sin_b.alias("s"), cos_b.alias("c"), dlon.alias("d"), b.alias("b")), placed)

    def angled(sin_b: Column) -> Column:
        return F.struct(
            sin_b.alias("s"), F.sqrt(1 - sin_b * sin_b).alias("c"), F.radians(lon - LAEA_LON0).alias("d")
        )

    sin_b = let(F.sin(F.radians(lat)), _sin_beta)
    return let(let(sin_b, angled), scaled)


def with_3035(df: DataFrame, x: str = "x", y: str = "y", lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Add EPSG:3035 columns. Built in steps that stay inside generated code, each evaluated once."""
    sin_b, cos_b, dlon, b = (F.col(n) for n in ("_sin_b", "_cos_b", "_dlon", "_b"))
    return (
        df.withColumn("_sin_lat", F.sin(F.radians(F.col(lat))))
        .withColumns({"_sin_b": _sin_beta(F.col("_sin_lat")), "_dlon": F.radians(F.col(lon) - LAEA_LON0)})
        .withColumn("_cos_b", F.sqrt(1 - sin_b * sin_b))
        .withColumn("_b", _scale(_spread(sin_b, cos_b, dlon)))
        .select(*df.columns, _easting(b, cos_b, dlon).alias(x), _northing(b, sin_b, cos_b, dlon).alias(y))
    )


def from_3035(x: Column, y: Column) -> Column:
    """Inverse of `to_3035`: struct<x=lon,y=lat>; NULL outside the projected disc."""
    e2, e4, e6 = _E2, _E2**2, _E2**3

    def lonlat(v: Column) -> Column:
        lat = F.degrees(
            v.getField("beta")
            + (e2 / 3 + 31 * e4 / 180 + 517 * e6 / 5040) * F.sin(2 * v.getField("beta"))
            + (23 * e4 / 360 + 251 * e6 / 3780) * F.sin(4 * v.getField("beta"))
            + (761 * e6 / 45360) * F.sin(6 * v.getField("beta"))
        )
        lon = F.pmod(F.degrees(v.getField("lam")) + LAEA_LON0 + 180.0, F.lit(360.0)) - 180.0
        return _xy(lon, lat)

    def angles(v: Column) -> Column:
        dx, dy, rho, sin_c, cos_c = (v.getField(n) for n in ("dx", "dy", "rho", "sin_c", "cos_c"))
        sin_beta = cos_c * _SIN_B0 + _D * dy * sin_c * _COS_B0 / rho
        beta = F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), sin_beta)))
        lam = F.atan2(dx * sin_c, _D * rho * _COS_B0 * cos_c - _D * _D * dy * _SIN_B0 * sin_c)
        return let(F.struct(beta.alias("beta"), lam.alias("lam")), lonlat)

    def turned(v: Column) -> Column:
        c = 2 * F.asin(F.least(F.lit(1.0), v.getField("rho") / (2 * LAEA_RADIUS_M)))
        return F.struct(
            v.getField("dx").alias("dx"),
            v.getField("dy").alias("dy"),
            v.getField("rho").alias("rho"),
            F.sin(c).alias("sin_c"),
            F.cos(c).alias("cos_c"),
        )

    def placed(v: Column) -> Column:
        rho = v.getField("rho")
        return F.when(rho == 0, _xy(F.lit(LAEA_LON0), F.lit(LAEA_LAT0))).when(
            rho <= 2 * LAEA_RADIUS_M, let(turned(v), angles)
        )

    dx, dy = x - LAEA_FALSE_EASTING, y - LAEA_FALSE_NORTHING
    rho = F.sqrt(dx * dx / (_D * _D) + dy * dy * (_D * _D))
    return let(F.struct(dx.alias("dx"), dy.alias("dy"), rho.alias("rho")), placed)


def to_3857(lon: Column, lat: Column) -> Column:
    """Web Mercator as struct<x,y>."""
    x = WGS84_A * F.radians(lon)
    y = WGS84_A * F.log(F.tan(math.pi / 4 + F.radians(lat) / 2))
    return _xy(x, y)


def project(lon: Column, lat: Column, crs: int) -> Column:
    """struct<x,y> in EPSG:3035 or EPSG:3857."""
    if crs == 3035:
        return to_3035(lon, lat)
    if crs == 3857:
        return to_3857(lon, lat)
    raise ValueError(f"unsupported CRS: {crs}")


def planar_m(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Euclidean distance in a projected CRS."""
    dx, dy = x1 - x2, y1 - y2
    return F.sqrt(dx * dx + dy * dy)


def half_chord2(b1: Column, l1: Column, b2: Column, l2: Column) -> Column:
    """Haversine: squared half chord between two points given in radians."""
    s = F.sin((b2 - b1) / 2)
    t = F.sin((l2 - l1) / 2)
    return s * s + F.cos(b1) * F.cos(b2) * t * t


def chord_to_m(h: Column, b1: Column, b2: Column, method: str = "spheroid") -> Column:
    """Metres from the squared half chord and the latitudes on the auxiliary sphere.

    Spheroid: Lambert's closed form on WGS84, within 0.3 m of the geodesic at hazard radii.
    """
    h = F.when(h > 1, F.lit(1.0)).otherwise(h)
    sigma = 2 * F.asin(F.sqrt(h))
    if method == "haversine":
        return MEAN_RADIUS_M * sigma
    sin_sigma = 2 * F.sqrt(h * (1 - h))
    q = F.sin((b2 - b1) / 2)
    p = F.sin((b1 + b2) / 2)
    # the two terms vanish where they are undefined: at the antipode and at the point itself
    near = F.coalesce(F.try_divide((sigma - sin_sigma) * p * p * (1 - q * q), 1 - h), F.lit(0.0))
    far = F.coalesce(F.try_divide((sigma + sin_sigma) * (1 - p * p) * q * q, h), F.lit(0.0))
    return WGS84_A * (sigma - WGS84_F / 2 * (near + far))


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    b1, b2 = F.radians(lat1), F.radians(lat2)
    return chord_to_m(half_chord2(b1, F.radians(lon1), b2, F.radians(lon2)), b1, b2, "haversine")


def reduced_latitude(lat: Column, method: str = "spheroid") -> Column:
    """Latitude in radians on the auxiliary sphere of the distance method."""
    if method == "spheroid":
        return F.atan((1 - WGS84_F) * F.tan(F.radians(lat)))
    if method == "haversine":
        return F.radians(lat)
    raise ValueError(f"unknown distance method: {method}")


def spheroid_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Distance on the WGS84 spheroid."""
    b1, b2 = reduced_latitude(lat1), reduced_latitude(lat2)
    return chord_to_m(half_chord2(b1, F.radians(lon1), b2, F.radians(lon2)), b1, b2)


def geodesic_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column, method: str = "spheroid") -> Column:
    """Distance over the ground in metres."""
    if method == "spheroid":
        return spheroid_m(lat1, lon1, lat2, lon2)
    if method == "haversine":
        return haversine_m(lat1, lon1, lat2, lon2)
    raise ValueError(f"unknown distance method: {method}")
