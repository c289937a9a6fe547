"""Shapes of any kind: WKT and GeoJSON texts to polygons, and measures over several polygons.

A shape is struct<kind, polygons>: `kind` the upper-case type name, `polygons` an array of polygons in the form of `polygons.py` (shell,
then holes). A line or point is one ring, which encloses nothing even if it is closed. Texts are rewritten to JSON by regular
expressions and read by `from_json`, all inside the JVM.

Cases: null, empty or unreadable text gives a null shape; a third coordinate is ignored; collections are unreadable.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sitewarden.functions.polygons import project_rings, shape_moments, st_centroid

POLYGONS = "array<array<array<struct<x:double,y:double>>>>"
_NUMBER = r"([-+]?[0-9.]+(?:[eE][-+]?[0-9]+)?)"
_AREAL = ("POLYGON", "MULTIPOLYGON")


def _nested(kind: Column, body: Column, point_depth: int) -> Column:
    """Wrap the JSON `body` until it has the depth of a multi-polygon."""
    wraps = F.when(kind == "MULTIPOLYGON", 0).when(kind.isin("POLYGON", "MULTILINESTRING"), 1).when(kind.isin("LINESTRING", "MULTIPOINT"), 2)
    wraps = wraps.when(kind == "POINT", 3 - point_depth)
    text = F.concat(F.repeat(F.lit("["), wraps), body, F.repeat(F.lit("]"), wraps))
    polygons = F.from_json(text, POLYGONS)
    return F.when(F.size(polygons) > 0, F.struct(kind.alias("kind"), polygons.alias("polygons")))


def from_wkt(text: Column) -> Column:
    """WKT to a shape."""
    plain = F.trim(F.regexp_replace(text, r"(?i)^\s*SRID=\d+;", ""))
    kind = F.upper(F.regexp_extract(plain, r"^([A-Za-z]+)", 1))
    body = F.regexp_extract(plain, r"(?s)^[A-Za-z]+\s*(?:[zZmM]+\s*)?(\(.*\))$", 1)
    pairs = F.regexp_replace(body, rf"{_NUMBER}\s+{_NUMBER}(?:\s+{_NUMBER})*", '{"x":$1,"y":$2}')
    # MULTIPOINT ((0 0), (1 1)) is MULTIPOINT (0 0, 1 1)
    pairs = F.when(kind == "MULTIPOINT", F.regexp_replace(pairs, r"\((\s*\{[^}]*\}\s*)\)(?=\s*[,)])", "$1")).otherwise(pairs)
    return _nested(kind, F.translate(pairs, "()", "[]"), 1)


def from_geojson(text: Column) -> Column:
    """A GeoJSON geometry to a shape."""
    kind = F.upper(F.get_json_object(text, "$.type"))
    places = F.get_json_object(text, "$.coordinates")
    pairs = F.regexp_replace(places, rf"\[\s*{_NUMBER}\s*,\s*{_NUMBER}(?:\s*,\s*{_NUMBER})*\s*\]", '{"x":$1,"y":$2}')
    return _nested(kind, pairs, 0)


def shape_of_rings(rings: Column) -> Column:
    """The shape of one polygon, shell then holes; null for null."""
    return F.when(rings.isNotNull(), F.struct(F.lit("POLYGON").alias("kind"), F.array(rings).alias("polygons")))


def project_shape(shape: Column, crs: int = 3035) -> Column:
    """Project every vertex."""
    polygons = F.transform(shape.getField("polygons"), lambda rings: project_rings(rings, crs))
    return F.when(shape.isNotNull(), F.struct(shape.getField("kind").alias("kind"), polygons.alias("polygons")))


def _areal(shape: Column) -> Column:
    return shape.getField("kind").isin(*_AREAL)


def shape_area(shape: Column) -> Column:
    """Sum of the polygons' areas; 0 for lines and points, null for null. Pass a plain column."""
    total = F.aggregate(shape.getField("polygons"), F.lit(0.0), lambda acc, rings: acc + shape_moments(rings).getField("area"))
    return F.when(_areal(shape), total).when(shape.isNotNull(), F.lit(0.0))


def shape_centroid(shape: Column) -> Column:
    """Centroid struct<x,y> of the polygons, weighted by area; without any area that of the first ring's vertices."""
    parts = F.transform(
        shape.getField("polygons"), lambda rings: F.struct(shape_moments(rings).getField("area").alias("area"), st_centroid(rings).alias("c"))
    )
    zero = F.struct(F.lit(0.0).alias("area"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))

    def add(acc: Column, part: Column) -> Column:
        area, c = part.getField("area"), part.getField("c")
        return F.struct(
            (acc.getField("area") + area).alias("area"),
            (acc.getField("x") + area * c.getField("x")).alias("x"),
            (acc.getField("y") + area * c.getField("y")).alias("y"),
        )

    first = F.element_at(F.element_at(shape.getField("polygons"), 1), 1)

    def mean(axis: str) -> Column:
        return F.aggregate(first, F.lit(0.0), lambda acc, p: acc + p.getField(axis)) / F.size(first)

    def point(sums: Column) -> Column:
        area = sums.getField("area")
        weighted = F.struct((sums.getField("x") / area).alias("x"), (sums.getField("y") / area).alias("y"))
        return F.when(area > 0, weighted).otherwise(F.struct(mean("x").alias("x"), mean("y").alias("y")))

    sums = F.when(_areal(shape), F.aggregate(parts, zero, add)).otherwise(zero)
    return F.when(shape.isNotNull(), F.element_at(F.transform(F.array(sums), point), 1))
