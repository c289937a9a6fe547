import math
import random

import pytest
from pyspark.sql import functions as F

from sitewarden.functions import geodesy as g
from sitewarden.functions import polygons as pg
from sitewarden.operators.spatial import create_buffers, validate_projection


def vincenty(lat1, lon1, lat2, lon2):
    """Iterative geodesic on WGS84."""
    a, f = 6378137.0, 1 / 298.257223563
    b = a * (1 - f)
    u1, u2 = (math.atan((1 - f) * math.tan(math.radians(v))) for v in (lat1, lat2))
    gap = lam = math.radians(lon2 - lon1)
    for _ in range(200):
        s = math.hypot(
            math.cos(u2) * math.sin(lam),
            math.cos(u1) * math.sin(u2) - math.sin(u1) * math.cos(u2) * math.cos(lam),
        )
        if s == 0:
            return 0.0
        c = math.sin(u1) * math.sin(u2) + math.cos(u1) * math.cos(u2) * math.cos(lam)
        sigma = math.atan2(s, c)
        sin_a = math.cos(u1) * math.cos(u2) * math.sin(lam) / s
        cos2 = 1 - sin_a**2
        cm = c - 2 * math.sin(u1) * math.sin(u2) / cos2 if cos2 else 0.0
        k = f / 16 * cos2 * (4 + f * (4 - 3 * cos2))
        new = gap + (1 - k) * f * sin_a * (sigma + k * s * (cm + k * c * (-1 + 2 * cm**2)))
        if abs(new - lam) < 1e-13:
            break
        lam = new
    w = cos2 * (a**2 - b**2) / b**2
    big_a = 1 + w / 16384 * (4096 + w * (-768 + w * (320 - 175 * w)))
    big_b = w / 1024 * (256 + w * (-128 + w * (74 - 47 * w)))
    d = big_b * s * (cm + big_b / 4 * (c * (-1 + 2 * cm**2) - big_b / 6 * cm * (-3 + 4 * s**2) * (-3 + 4 * cm**2)))
    return b * big_a * (sigma - d)


def test_epsg_example_and_known_distances(spark):
    p = spark.range(1).select(g.to_3035(F.lit(5.0), F.lit(50.0)).alias("p")).first().p
    assert p.x == pytest.approx(3962799.451, abs=0.01)
    assert p.y == pytest.approx(2999718.853, abs=0.01)
    assert all(row.passed for row in validate_projection(spark).collect())


def test_spheroid_distance_against_iterative_solution(spark):
    rng = random.Random(7)
    rows = []
    for _ in range(300):
        lat, lon = rng.uniform(-84, 84), rng.uniform(-180, 180)
        rows.append((lat, lon, lat + rng.uniform(-1, 1), lon + rng.uniform(-1, 1)))
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    got = df.select("*", g.geodesic_m(*[F.col(x) for x in "abcd"]).alias("m")).collect()
    assert max(abs(r.m - vincenty(r.a, r.b, r.c, r.d)) for r in got) < 0.3
    same = spark.range(1).select(g.geodesic_m(*[F.lit(x) for x in (10.0, 20.0, 10.0, 20.0)]).alias("m"))
    assert same.first().m == 0.0


def test_projection_steps_equal_the_expression_and_invert(spark):
    rng = random.Random(3)
    rows = [(rng.uniform(-100, 120), rng.uniform(-60, 80)) for _ in range(200)] + [(10.0, 52.0)]
    df = spark.createDataFrame(rows, "lon double, lat double")
    both = g.with_3035(df).withColumn("p", g.to_3035(F.col("lon"), F.col("lat"))).withColumn(
        "back", g.from_3035(F.col("x"), F.col("y"))
    )
    for r in both.collect():
        assert r.x == pytest.approx(r.p.x, abs=1e-6) and r.y == pytest.approx(r.p.y, abs=1e-6)
        assert r.back.x == pytest.approx(r.lon, abs=1e-7) and r.back.y == pytest.approx(r.lat, abs=1e-7)


def test_wkt(spark):
    df = spark.createDataFrame([("POINT(12.5 -41.25)",), ("SRID=4326;POINT (1 2)",), ("LINESTRING(0 0, 1 1)",)], "w string")
    got = [r.p for r in df.select(g.parse_point_wkt(F.col("w")).alias("p")).collect()]
    assert (got[0].x, got[0].y) == (12.5, -41.25) and (got[1].x, got[1].y) == (1.0, 2.0) and got[2] is None


SQUARE = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)]
HOLE = [(1.0, 1.0), (2.0, 1.0), (2.0, 2.0), (1.0, 2.0), (1.0, 1.0)]


@pytest.mark.parametrize("flip", [False, True])
def test_polygon_measures(spark, flip):
    shell = SQUARE[::-1] if flip else SQUARE
    rows = [
        (1, [shell, HOLE], 1.5, 1.5),
        (2, [shell, HOLE], 3.0, 3.0),
        (3, [shell], 7.0, 8.0),
        (4, [[(5.0, 6.0)]], 8.0, 10.0),
        (5, [[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0)]], 3.0, 1.0),
    ]
    df = spark.createDataFrame(rows, "id int, rings array<array<struct<x:double,y:double>>>, x double, y double")
    r = F.col("rings")
    got = {
        v.id: v
        for v in df.select(
            "id",
            pg.st_area(r).alias("area"),
            pg.st_centroid(r).alias("c"),
            pg.st_within(F.col("x"), F.col("y"), r).alias("inside"),
            pg.st_distance(r, F.col("x"), F.col("y")).alias("d"),
        ).collect()
    }
    assert got[1].area == pytest.approx(15.0) and not got[1].inside and got[1].d == pytest.approx(0.5)
    assert got[1].c.x == pytest.approx((32.0 - 1.5) / 15.0)
    assert got[2].inside and got[2].d == 0.0
    assert got[3].d == pytest.approx(5.0) and not got[3].inside
    assert got[4].area == 0.0 and got[4].d == pytest.approx(5.0) and (got[4].c.x, got[4].c.y) == (5.0, 6.0)
    assert got[5].area == 0.0 and got[5].d == pytest.approx(2.0)


def test_buffer_area_grows_with_the_square(spark, cities):
    rings = create_buffers(cities, (5000, 10000)).withColumn("rings", F.array("ring"))
    areas = pg.with_plane_rings(rings).groupBy("buffer_m").agg(F.avg(pg.st_area(F.col("rings_m"))).alias("a"))
    by = {r.buffer_m: r.a for r in areas.collect()}
    assert by[10000] / by[5000] == pytest.approx(4.0, rel=1e-4)
