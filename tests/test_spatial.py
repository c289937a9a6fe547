import math
import random

import pytest
from pyspark.sql import functions as F

from sitewarden.functions.geodesy import geodesic_m, with_3035
from sitewarden.operators import spatial as sp
from sitewarden.operators.exposure import seismic_energy

ROUTES = ["broadcast", "shuffle"]


@pytest.fixture(scope="module")
def world(spark):
    """Sites and events everywhere, at both poles and on both sides of the antimeridian."""
    rng = random.Random(11)
    places = [(rng.uniform(-180, 180), rng.uniform(-90, 90)) for _ in range(60)]
    places += [(179.9, 10.0), (-179.9, 10.0), (180.0, -45.0), (0.0, 90.0), (120.0, -89.9), (-60.0, 89.5), (5.0, 89.99)]
    sites = [(i, lon, lat) for i, (lon, lat) in enumerate(places)]
    events = []
    for lon, lat in places * 6:
        la = max(-90.0, min(90.0, lat + rng.uniform(-2, 2)))
        lo = (lon + rng.uniform(-4, 4) + 180) % 360 - 180
        events.append((len(events), lo, la))
    # a third of all events at one spot
    events += [(len(events) + i, 179.95, 10.1) for i in range(200)]
    s = spark.createDataFrame(sites, "site_id bigint, lon double, lat double")
    e = spark.createDataFrame(events, "event_id bigint, lon double, lat double")
    return s.cache(), e.cache()


def every_pair(sites, events):
    s = sites.select("site_id", F.col("lon").alias("slon"), F.col("lat").alias("slat"))
    return events.crossJoin(s)


@pytest.mark.parametrize("route", ROUTES)
@pytest.mark.parametrize("radius", [50_000, 1_500_000])
def test_distance_join_equals_brute_force(world, route, radius):
    sites, events = world
    got = sp.pairs_within(sites, events, radius, strategy=route).select("event_id", "site_id").collect()
    d = geodesic_m(F.col("lat"), F.col("lon"), F.col("slat"), F.col("slon"))
    want = every_pair(sites, events).where(d <= radius).select("event_id", "site_id").collect()
    assert len(got) == len(want) > 0 and set(got) == set(want)


def degree_nearest(sites, events, max_km):
    s, e = with_3035(sites).collect(), with_3035(events).collect()
    out = set()
    for v in e:
        best = min(s, key=lambda w: ((v.lon - w.lon) ** 2 + (v.lat - w.lat) ** 2, w.site_id))
        if None not in (v.x, best.x) and math.hypot(v.x - best.x, v.y - best.y) <= max_km * 1000:
            out.add((v.event_id, best.site_id))
    return out


@pytest.mark.parametrize("route", ROUTES)
@pytest.mark.parametrize("max_km", [50.0, 400.0])
def test_nearest_by_degrees_equals_brute_force(world, route, max_km):
    sites, events = world
    got = {(r.event_id, r.site_id) for r in sp.nearest_site(events, sites, max_km, "event_id", strategy=route).collect()}
    assert got == degree_nearest(sites, events, max_km) and got


def test_lone_site_across_the_antimeridian_is_still_linked(spark):
    site = spark.createDataFrame([(1, 179.99, 60.0)], "site_id bigint, lon double, lat double")
    event = spark.createDataFrame([(1, -179.99, 60.0)], "event_id bigint, lon double, lat double")
    assert sp.nearest_site(event, site, 50.0, "event_id").count() == 1
    rival = site.unionByName(spark.createDataFrame([(2, 0.0, 60.0)], site.schema))
    assert sp.nearest_site(event, rival, 50.0, "event_id").count() == 0
    assert sp.nearest_site(event, rival, 50.0, "event_id", rank="metric").first().site_id == 1


@pytest.mark.parametrize("route", ROUTES)
def test_nearest_projected_keeps_ties(spark, route):
    sites = spark.createDataFrame([(1, 10.0, 50.0), (2, 10.0, 50.0), (3, 10.5, 50.0)], "site_id bigint, lon double, lat double")
    events = spark.createDataFrame([(7, 10.01, 50.0), (8, 20.0, 50.0)], "event_id bigint, lon double, lat double")
    rows = sp.nearest_site_projected(events, sites, 5000, "event_id", route).collect()
    assert sorted((r.event_id, r.site_id) for r in rows) == [(7, 1), (7, 2)]
    assert rows[0].distance_to_site_km == pytest.approx(rows[0].distance_to_site_m / 1000)


def test_hazards_near_and_far(spark):
    sites = spark.createDataFrame([(1, 2.3522, 48.8566), (2, 13.405, 52.52)], "site_id bigint, lon double, lat double")
    quakes = spark.createDataFrame(
        [("a", 2.40, 48.90), ("b", 13.45, 52.55), ("c", 30.0, 60.0)], "usgs_id string, lon double, lat double"
    )
    wide = sp.nearest_site_projected(quakes, sites, 100_000, "usgs_id")
    assert {(r.usgs_id, r.site_id) for r in wide.collect()} == {("a", 1), ("b", 2)}
    assert sp.nearest_site_projected(quakes, sites, 1_000, "usgs_id").count() == 0
    assert sp.nearest_site_projected(quakes.limit(0), sites, 100_000, "usgs_id").count() == 0
    assert sp.nearest_site_projected(quakes, sites.limit(0), 100_000, "usgs_id").count() == 0


def _building(fid, lon, lat, half=0.0002):
    ring = [(lon + a * half, lat + b * half) for a, b in ((-1, -1), (1, -1), (1, 1), (-1, 1), (-1, -1))]
    return (fid, [ring])


@pytest.mark.parametrize("route", ROUTES)
def test_features_in_buffer(spark, route):
    site = spark.createDataFrame([(1, 2.3522, 48.8566), (2, 2.36, 48.86)], "site_id bigint, lon double, lat double")
    urban = spark.createDataFrame(
        [_building(1, 2.36, 48.864), _building(2, 2.55, 48.99), _building(3, 2.3522, 48.8566)],
        "id bigint, rings array<array<struct<x:double,y:double>>>",
    )
    rows = sp.urban_in_buffer(urban, site, 5000, strategy=route).collect()
    assert {(r.id, r.nearest_site_id) for r in rows} == {(1, 1), (1, 2), (3, 1), (3, 2)}
    assert [r.distance_to_site_m for r in rows if (r.id, r.nearest_site_id) == (3, 1)] == [0.0]
    exact = sp.urban_in_buffer(urban, site, 5000, polygon=True, strategy=route)
    assert exact.count() == 4


def test_refresh_distance_keeps_unlinked_rows(spark):
    site = spark.createDataFrame([(1, 2.3522, 48.8566)], "site_id bigint, lon double, lat double")
    urban = spark.createDataFrame(
        [(*_building(1, 2.36, 48.864), 1, None), (*_building(2, 2.36, 48.864), None, 5.0)],
        "id bigint, rings array<array<struct<x:double,y:double>>>, nearest_site_id bigint, distance_to_site_m double",
    )
    got = {r.id: r.distance_to_site_m for r in sp.refresh_distance(urban, site).collect()}
    assert 900 < got[1] < 1100 and got[2] == 5.0


@pytest.mark.parametrize("route", ROUTES)
def test_seismic_energy_of_sites_without_events(world, route):
    sites, events = world
    quakes = events.withColumn("magnitude", F.lit(4.0))
    rows = seismic_energy(sites, quakes, 100_000, strategy=route).collect()
    assert len(rows) == sites.count() and min(r.earthquake_count for r in rows) >= 0
    other = seismic_energy(sites, quakes.repartition(3), 100_000, strategy="broadcast").collect()
    same = {r.site_id: r for r in other}
    for r in rows:
        assert r.earthquake_count == same[r.site_id].earthquake_count
        assert r.total_energy == pytest.approx(same[r.site_id].total_energy, rel=1e-9)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("route", ROUTES)
def test_no_join_compares_every_pair(world, route):
    sites, events = world
    frames = [
        sp.pairs_within(sites, events, 50_000, strategy=route),
        sp.nearest_site(events, sites, 50.0, "event_id", strategy=route),
        sp.nearest_site_projected(events, sites, 50_000, "event_id", strategy=route),
    ]
    for df in frames:
        plan = plan_of(df)
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_shuffled_routes_broadcast_nothing(world):
    sites, events = world
    nearest = sp.nearest_site(events, sites, 50.0, "event_id", strategy="shuffle")
    pairs = sp.pairs_within(sites, events, 50_000, strategy="shuffle")
    plans = [df._jdf.queryExecution().sparkPlan().toString() for df in (nearest, pairs)]
    assert "Broadcast" not in plans[1]
    # the last join, by the events' own place, may be a broadcast by size
    assert "LeftAnti, BuildRight" not in plans[0] and plans[0].count("BroadcastHashJoin") <= 1


def test_events_of_one_place_are_joined_once(world, monkeypatch):
    sites, events = world
    joined = []
    real = sp.join_on_cell
    monkeypatch.setattr(sp, "join_on_cell", lambda left, *rest: joined.append(left.count()) or real(left, *rest))
    seismic_energy(sites, events.withColumn("magnitude", F.lit(5.0)), 50_000, strategy="broadcast")
    sp.nearest_site(events, sites, 50.0, "event_id", strategy="broadcast")
    places = events.select("lon", "lat").distinct().count()
    assert joined[0] == places < events.count() and joined[1] <= places


def test_no_projection_is_evaluated_again_in_an_inferred_filter(world):
    sites, events = world
    plain = [df.selectExpr(*[f"{c} + 0 AS {c}" for c in df.columns]) for df in (sites, events)]
    pairs = sp.nearest_site(plain[1], plain[0], 50.0, "event_id", strategy="broadcast")
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if line.lstrip("+-: ").startswith("Filter")]
    assert filters and not any("sin(" in line.lower() or "sqrt(" in line.lower() for line in filters)


@pytest.mark.parametrize("route", ROUTES)
def test_event_beyond_180_degrees_is_suppressed_by_a_degree_closer_site(spark, route):
    sites = spark.createDataFrame([(1, 177.9, -68.25), (2, -170.0, -60.0)], "site_id bigint, lon double, lat double")
    event = spark.createDataFrame([(1, -182.14, -68.25)], "event_id bigint, lon double, lat double")
    assert sp.nearest_site(event, sites.where("site_id = 1"), 50.0, "event_id", strategy=route).count() == 1
    assert sp.nearest_site(event, sites, 50.0, "event_id", strategy=route).count() == 0


@pytest.mark.parametrize("strategy", ROUTES)
def test_distance_join_searches_each_place_once(spark, monkeypatch, strategy):
    """Events of one place take its pairs: what is searched and written does not grow with them, the rows do."""
    sites = spark.createDataFrame([(1, 10.0, 50.0), (2, 10.2, 50.0), (3, -60.0, 0.0)], "site_id bigint, lon double, lat double")
    places = [(10.1, 50.0)] * 40 + [(0.0, 0.0), (-0.0, 0.0), (10.1, None), (None, 50.0)]
    events = spark.createDataFrame([(i, lon, lat) for i, (lon, lat) in enumerate(places)], "event_id bigint, lon double, lat double")
    written = []
    plain = sp.stage

    def counted(df, name):
        out = plain(df, name)
        written.append(out.count())
        return out

    monkeypatch.setattr(sp, "stage", counted)
    rows = sp.distance_join(sites, events, 50_000.0, strategy=strategy).select("event_id", "site_id", "lon", "distance_m").collect()
    assert written == [2]
    assert sorted((r.event_id, r.site_id) for r in rows if r.event_id is not None) == [(i, s) for i in range(40) for s in (1, 2)]
    assert [r.site_id for r in rows if r.event_id is None] == [3]
    inner = sp.distance_join(sites, events, 50_000.0, how="inner", strategy=strategy)
    assert inner.count() == 80
