"""Points in areas by a cover of cells, held against the test of every pair."""

import math
import random

import pytest
from pyspark.sql import functions as F

from sitewarden.operators import areas
from sitewarden.operators.areas import cover, points_in_areas

SHAPE = "area_id bigint, shape struct<kind:string,polygons:array<array<array<struct<x:double,y:double>>>>>"


def star(rng, x, y, size, corners):
    at = [(x + size * r * math.cos(a), y + size * r * math.sin(a)) for a, r in ((2 * math.pi * i / corners, rng.uniform(0.4, 1)) for i in range(corners))]
    return [*at, at[0]]


def inside(x, y, polygons):
    n = 0
    for ring in (ring for rings in polygons for ring in rings):
        for (ax, ay), (bx, by) in zip(ring, ring[1:], strict=False):
            if (ay > y) != (by > y) and x < ax + (y - ay) * (bx - ax) / (by - ay):
                n += 1
    return n % 2 == 1


@pytest.fixture(scope="module")
def world(spark):
    rng = random.Random(7)
    areas = []
    for i in range(30):
        x, y, size = rng.uniform(-160, 160), rng.uniform(-70, 70), 10 ** rng.uniform(-2, 1.3)
        polygons = [[star(rng, x, y, size, rng.choice([3, 12, 300])), star(rng, x, y, size * 0.3, 9)]]
        if i % 3 == 0:
            polygons.append([star(rng, x + 2.5 * size, y, size, 20)])
        areas.append((i, polygons))
    areas.append((30, [[[(-20.0, -20.0), (20.0, -20.0), (20.0, 20.0), (-20.0, 20.0), (-20.0, -20.0)]]]))
    points = [(n, rng.uniform(-175, 175), rng.uniform(-80, 80)) for n in range(300)]
    for n in range(600):
        x, y = rng.choice(rng.choice(areas)[1])[0][0]
        points.append((1000 + n, x + rng.uniform(-3, 3), y + rng.uniform(-2, 2)))
    return areas, points


@pytest.mark.parametrize(("strategy", "max_edges"), [("broadcast", 8), ("shuffle", 3)])
def test_equals_the_test_of_all_pairs(spark, world, strategy, max_edges):
    areas, points = world
    frame = spark.createDataFrame([(i, ("MULTIPOLYGON" if len(p) > 1 else "POLYGON", p)) for i, p in areas], SHAPE)
    places = spark.createDataFrame(points, "n bigint, lon double, lat double")
    found = sorted((r.n, r.area_id) for r in points_in_areas(places, frame, strategy=strategy, max_edges=max_edges).collect())
    assert found == sorted((n, i) for n, x, y in points for i, p in areas if inside(x, y, p))
    assert found


def test_border_cells_keep_few_edges(spark, world):
    areas = spark.createDataFrame([(i, ("MULTIPOLYGON", p)) for i, p in world[0]], SHAPE)
    cells = cover(areas)
    assert cells.agg(F.max(F.size("edges"))).first()[0] <= 8
    assert cells.where("size(edges) = 0 AND NOT inside").isEmpty()


def test_odd_rows(spark):
    square = [[[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0), (0.0, 0.0)]]]
    areas = [(1, ("POLYGON", square)), (1, ("POLYGON", square)), (None, ("POLYGON", square)), (2, None), (3, ("POLYGON", [])), (4, ("LINESTRING", square)), (5, ("POLYGON", [[[(0.0, 0.0), (1.0, 1.0)]]]))]
    frame = spark.createDataFrame(areas, SHAPE)
    places = spark.createDataFrame([(1, 0.5, 0.5, "a"), (1, 0.5, 0.5, "a"), (2, None, 0.5, "b"), (3, 900.0, 0.5, "c"), (4, 1.5, 0.5, "d")], "level int, lon double, lat double, key string")
    found = points_in_areas(places, frame)
    assert found.columns == ["level", "lon", "lat", "key", "area_id"]
    assert sorted((r.level, -1 if r.area_id is None else r.area_id) for r in found.collect()) == [(1, -1)] * 2 + [(1, 1)] * 4
    assert points_in_areas(places, frame.where("false")).count() == 0
    assert points_in_areas(places.where("false"), frame).count() == 0
    with pytest.raises(ValueError):
        points_in_areas(places.withColumnRenamed("key", "area_id"), frame)


@pytest.mark.parametrize("strategy", ["broadcast", "shuffle"])
def test_each_place_is_searched_once(spark, monkeypatch, strategy):
    """Points of one place take its areas: the areas found are written once for each place, however many points lie there."""
    square = [[[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0), (0.0, 0.0)]]]
    frame = spark.createDataFrame([(i, ("POLYGON", square)) for i in (1, 2)], SHAPE)
    points = spark.createDataFrame([(i, 0.3, 0.6) for i in range(50)] + [(50, 3.0, 3.0)], "n int, lon double, lat double")
    written = {}
    plain = areas.stage

    def counted(df, name):
        out = plain(df, name)
        written[name] = out.count()
        return out

    monkeypatch.setattr(areas, "stage", counted)
    found = points_in_areas(points, frame, strategy=strategy)
    assert written["place_areas"] == 2
    assert sorted((r.n, r.area_id) for r in found.collect()) == [(i, a) for i in range(50) for a in (1, 2)]
