"""Spatial joins as grid-keyed equi-joins.

Every join puts the event into one cell and the site into each cell its circle touches, joins on
the cell and keeps the pairs whose exact distance passes. When the sites are proven small they are
broadcast and the events never move, so a hot cell costs nothing extra. Otherwise both sides are
shuffled on (cell, salt): the salt spreads a hot cell's events over several tasks, the sites are
repeated per salt, and AQE's skew handling splits further.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewarden.constants import BUFFER_DISTANCES_M, JOIN_SALTS, PLACE_SALTS
from sitewarden.functions.cells import GeoGrid, PlaneGrid
from sitewarden.functions.geodesy import (
    MEAN_RADIUS_M,
    chord_to_m,
    from_3035,
    geodesic_m,
    half_chord2,
    planar_m,
    reduced_latitude,
    to_3035,
    with_3035,
)
from sitewarden.functions.polygons import max_vertex_m, st_distance, with_plane_rings
from sitewarden.session import resolve_strategy, stage


def join_on_cell(events: DataFrame, sites: DataFrame, strategy: str, salts: int = JOIN_SALTS) -> DataFrame:
    """Inner join of single-cell events and cell-exploded sites on `cell`; the key columns are dropped."""
    if strategy == "broadcast":
        return events.join(F.broadcast(sites), "cell").drop("cell")
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in events.columns if _hashable(events, c)]), F.lit(salts))
    salted = events.withColumn("salt", salt)
    repeated = sites.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    # Spark guesses the size of the exploded sites from the file of the sites and would broadcast them
    return salted.join(repeated.hint("merge"), ["cell", "salt"]).drop("cell", "salt")


def _hashable(df: DataFrame, name: str) -> bool:
    return df.schema[name].dataType.typeName() not in ("map", "variant")


def _at_most(name: str, limit: float) -> Column:
    """`name` <= limit, false for NULL.

    From a bare comparison the optimizer would infer that the coordinates are not null and evaluate the whole projection, written out
    without its steps, once more for every row below the join.
    """
    return F.coalesce(F.col(name), F.lit(math.inf)) <= limit


def _site_points(sites: DataFrame) -> DataFrame:
    return sites.select("site_id", F.col("lon").alias("site_lon"), F.col("lat").alias("site_lat")).where(
        F.col("site_lon").isNotNull() & F.col("site_lat").isNotNull()
    )


def pairs_within(
    sites: DataFrame,
    events: DataFrame,
    radius_m: float,
    method: str = "spheroid",
    strategy: str = "auto",
    salts: int = JOIN_SALTS,
) -> DataFrame:
    """Each (event, site) pair at most `radius_m` apart: event columns, site_id, distance_m."""
    strategy = resolve_strategy(sites, strategy)
    grid = GeoGrid(radius_m / 1000.0)
    covered = _site_points(sites).select(
        "site_id",
        F.radians("site_lon").alias("_l2"),
        reduced_latitude(F.col("site_lat"), method).alias("_b2"),
        F.explode_outer(grid.cover(F.col("site_lon"), F.col("site_lat"), radius_m / 1000.0)).alias("cell"),
    )
    keyed = events.where(F.col("lon").isNotNull() & F.col("lat").isNotNull()).withColumns(
        {
            "_l1": F.radians("lon"),
            "_b1": reduced_latitude(F.col("lat"), method),
            "cell": grid.cell_of(F.col("lon"), F.col("lat")),
        }
    )
    b1, b2 = F.col("_b1"), F.col("_b2")
    # the half chord alone, with slack for the spheroid, rejects most candidates cheaply
    far = math.sin(min(1.01 * radius_m / MEAN_RADIUS_M / 2, math.pi / 2)) ** 2
    return (
        join_on_cell(keyed, covered, strategy, salts)
        .withColumn("_h", half_chord2(b1, F.col("_l1"), b2, F.col("_l2")))
        .withColumn("distance_m", chord_to_m(F.col("_h"), b1, b2, method))
        .where(_at_most("_h", far) & _at_most("distance_m", radius_m))
        .drop("_l1", "_b1", "_l2", "_b2", "_h")
    )


def distance_join(
    sites: DataFrame,
    events: DataFrame,
    radius_m: float,
    how: str = "left",
    method: str = "spheroid",
    strategy: str = "auto",
) -> DataFrame:
    """All pairs within the radius; `how='left'` keeps sites without events.

    Each distinct place is held against the sites once, its pairs are written, and its events take them. So the costly part grows with the
    distinct places, and the rows, which grow with events times sites, are made by one equi-join at the end and never written or moved.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"unsupported join type: {how}")
    pairs = stage(pairs_within(sites, events.select("lon", "lat").distinct(), radius_m, method, strategy, PLACE_SALTS), "place_pairs")
    rows = events.join(pairs, ["lon", "lat"])
    return rows if how == "inner" else _plus_lonely_sites(rows, sites, pairs)


def _plus_lonely_sites(rows: DataFrame, sites: DataFrame, found: DataFrame) -> DataFrame:
    """Rows plus one row of NULLs for each site that `found` does not hold."""
    lonely = sites.select("site_id").join(found.select("site_id").distinct(), "site_id", "left_anti")
    return rows.unionByName(lonely, allowMissingColumns=True)


def _with_lonely_sites(rows: DataFrame, sites: DataFrame) -> DataFrame:
    """Rows plus one row of NULLs for each site without any: a left join that never shuffles the rows.

    The rows are computed once, written and read for both uses. Only the distinct site ids move, so a site holding a large share of the
    rows makes no hot task.
    """
    rows = stage(rows, "site_rows")
    return _plus_lonely_sites(rows, sites, rows)


def distance_sums(
    sites: DataFrame,
    events: DataFrame,
    radius_m: float,
    terms: dict[str, tuple[Column, Callable[[Column], Column]]],
    method: str = "spheroid",
    strategy: str = "auto",
) -> DataFrame:
    """Per site, sums of `event value x kernel(distance in km)` over the events within the radius.

    One row per site that has an event; `terms` maps an output column to (event value, kernel). The events of one place are
    summed before the join, so pairs grow with the distinct places.
    """
    strategy = resolve_strategy(sites, strategy)
    slim = events.select("lon", "lat", *[value.cast("double").alias(name) for name, (value, _) in terms.items()])
    places = slim.groupBy("lon", "lat").agg(*[F.sum(name).alias(name) for name in terms])
    pairs = pairs_within(sites, places, radius_m, method, strategy, PLACE_SALTS)
    km = F.col("distance_m") / 1000.0
    return pairs.groupBy("site_id").agg(
        *[F.sum(F.col(name) * kernel(km)).alias(name) for name, (_, kernel) in terms.items()]
    )


def with_plane(df: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """Add EPSG:3035 coordinates of lon/lat; rows without a position are dropped.

    At the antipode x and y are NULL, which no join matches. Filtering on them would make the
    optimizer evaluate the projection a second time below the filter.
    """
    return with_3035(df.where(F.col("lon").isNotNull() & F.col("lat").isNotNull()), x, y)


def _plane_sites(sites: DataFrame, radius_m: float) -> DataFrame:
    placed = with_plane(sites.select("site_id", "lon", "lat"), "site_x", "site_y")
    cells = PlaneGrid(radius_m).cover(F.col("site_x"), F.col("site_y"), radius_m)
    return placed.select(
        "site_id",
        F.col("lon").alias("site_lon"),
        F.col("lat").alias("site_lat"),
        "site_x",
        "site_y",
        # a plain explode would filter by the whole expression below the projection
        F.explode_outer(cells).alias("cell"),
    )


def plane_pairs(
    events: DataFrame, sites: DataFrame, radius_m: float, strategy: str, salts: int = JOIN_SALTS
) -> DataFrame:
    """(event, site) pairs within `radius_m` in EPSG:3035; events must carry x and y."""
    keyed = events.withColumn("cell", PlaneGrid(radius_m).cell_of(F.col("x"), F.col("y")))
    return (
        join_on_cell(keyed, _plane_sites(sites, radius_m), strategy, salts)
        .withColumn("distance_m", planar_m(F.col("x"), F.col("y"), F.col("site_x"), F.col("site_y")))
        .where(_at_most("distance_m", radius_m))
    )


# Levels of the degree grid: cells of 1/4 degree doubling up to the whole globe.
_FINEST_DEGREES = 0.25
_LEVELS = 12


def _degree_level(width: Column) -> Column:
    """Smallest level whose cells are at least `width` degrees."""
    raw = F.ceil(F.log2(F.greatest(width, F.lit(_FINEST_DEGREES)) / _FINEST_DEGREES))
    return F.greatest(F.lit(0), F.least(F.lit(_LEVELS - 1), raw)).cast("int")


def _degree_cell(level: Column, column: Column, row: Column) -> Column:
    # distinct for negative columns and rows too: events may lie beyond 180 degrees
    return F.shiftleft(level.cast("long"), 48) + F.shiftleft(row, 24) + column


def _degree_index(value: Column, level: Column, low: float) -> Column:
    return F.floor((value - low) / (_FINEST_DEGREES * F.pow(F.lit(2.0), level))).cast("long")


def nearest_site(
    events: DataFrame,
    sites: DataFrame,
    max_km: float,
    key: str,
    rank: str = "degrees",
    strategy: str = "auto",
) -> DataFrame:
    """The closest site of each event, if within `max_km` in EPSG:3035: key, site_id, distance_km.

    rank='degrees' picks by planar degree distance over all sites and then applies the limit, so a
    degree-closer site beyond the limit suppresses the link. That is checked without comparing
    every site: the best candidate within the limit stands unless some site lies within its own
    degree distance, an anti-join on a grid whose cell size follows that distance.
    rank='metric' picks by the metric distance. Ties go to the smallest site_id.
    Each distinct place is searched once, its events take its site.
    """
    if rank not in ("degrees", "metric"):
        raise ValueError(f"unknown rank: {rank}")
    strategy = resolve_strategy(sites, strategy)
    placed = with_plane(events.select("lon", "lat").distinct())
    pairs = plane_pairs(placed, sites, max_km * 1000.0, strategy, PLACE_SALTS)
    degrees2 = (F.col("lon") - F.col("site_lon")) * (F.col("lon") - F.col("site_lon")) + (
        F.col("lat") - F.col("site_lat")
    ) * (F.col("lat") - F.col("site_lat"))
    order = F.col("distance_m") if rank == "metric" else degrees2
    best = pairs.groupBy("lon", "lat").agg(
        F.min(F.struct(order.alias("d"), "site_id", "distance_m")).alias("best")
    )
    found = best.select(
        "lon",
        "lat",
        F.col("best.site_id").alias("site_id"),
        F.col("best.d").alias("d"),
        (F.col("best.distance_m") / 1000.0).alias("distance_km"),
    )
    if rank == "degrees":
        found = _drop_suppressed(found, sites)
    return _of_places(events, key, found).select(key, "site_id", "distance_km")


def _of_places(events: DataFrame, key: str, found: DataFrame) -> DataFrame:
    """Each distinct (key, lon, lat) of the events next to the rows that `found` has for its place."""
    return events.select(key, "lon", "lat").join(found, ["lon", "lat"]).distinct()


def _drop_suppressed(found: DataFrame, sites: DataFrame) -> DataFrame:
    """Remove candidates that have a degree-closer site (or an equally close one of smaller id)."""
    level = F.col("level")
    # one place holds at most one rival worth testing: the smallest id
    rivals = _site_points(sites).groupBy("site_lon", "site_lat").agg(F.min("site_id").alias("rival_id"))
    around = F.sequence(F.lit(-1).cast("long"), F.lit(1).cast("long"))
    rival_cells = (
        rivals.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(_LEVELS - 1))))
        .withColumn("col0", _degree_index(F.col("site_lon"), level, -180.0))
        .withColumn("row0", _degree_index(F.col("site_lat"), level, -90.0))
        .withColumn("dc", F.explode(around))
        .withColumn("dr", F.explode(around))
        .select(
            "rival_id",
            F.col("site_lon").alias("rival_lon"),
            F.col("site_lat").alias("rival_lat"),
            _degree_cell(level, F.col("col0") + F.col("dc"), F.col("row0") + F.col("dr")).alias("cell"),
        )
    )
    keyed = found.withColumn("level", _degree_level(F.sqrt("d"))).withColumn(
        "cell",
        _degree_cell(
            level, _degree_index(F.col("lon"), level, -180.0), _degree_index(F.col("lat"), level, -90.0)
        ),
    )
    dx, dy = F.col("lon") - F.col("rival_lon"), F.col("lat") - F.col("rival_lat")
    closer = dx * dx + dy * dy
    beats = (closer < F.col("d")) | ((closer == F.col("d")) & (F.col("rival_id") < F.col("site_id")))
    # about 100 rows per site, which Spark does not foresee: it would broadcast them
    return keyed.join(rival_cells.hint("merge"), (keyed["cell"] == rival_cells["cell"]) & beats, "left_anti")


def nearest_site_projected(
    events: DataFrame, sites: DataFrame, max_m: float, key: str, strategy: str = "auto"
) -> DataFrame:
    """Nearest site in EPSG:3035 within `max_m`, all ties kept; unmatched events are dropped.

    Each distinct place is searched once. Its minimum comes from a map-side combined aggregate; the ties are then found by
    probing the grid again with the minimum in hand, so no set of pairs is ever shuffled.
    """
    strategy = resolve_strategy(sites, strategy)
    placed = with_plane(events.select("lon", "lat").distinct())
    nearest = (
        plane_pairs(placed, sites, max_m, strategy, PLACE_SALTS)
        .groupBy("lon", "lat", "x", "y")
        .agg(F.min("distance_m").alias("nearest_m"))
    )
    found = plane_pairs(nearest, sites, max_m, strategy, PLACE_SALTS).where(
        F.coalesce("distance_m", F.lit(math.inf)) == F.col("nearest_m")
    )
    return (
        _of_places(events, key, found.select("lon", "lat", "site_id", "distance_m"))
        .select(
            key,
            "site_id",
            F.col("distance_m").alias("distance_to_site_m"),
            (F.col("distance_m") / 1000.0).alias("distance_to_site_km"),
        )
    )


def urban_in_buffer(
    urban: DataFrame,
    sites: DataFrame,
    buffer_m: float = 5000.0,
    polygon: bool = False,
    segments: int = 16,
    strategy: str = "auto",
) -> DataFrame:
    """Features lying inside a site's buffer, with the site and the distance; a feature may match many.

    A feature lies inside the circle when its farthest vertex does. `polygon=True` tests against the
    circle's polygon with `segments` segments per quarter instead.
    """
    strategy = resolve_strategy(sites, strategy)
    grid = PlaneGrid(buffer_m)
    placed = (
        with_plane_rings(urban)
        .withColumn("_v", F.element_at(F.element_at("rings_m", 1), 1))
        .where(F.col("_v").isNotNull())
        .withColumn("cell", grid.cell_of(F.col("_v.x"), F.col("_v.y")))
        .drop("_v", "nearest_site_id", "distance_to_site_m")
    )
    x, y = F.col("site_x"), F.col("site_y")
    joined = join_on_cell(placed, _plane_sites(sites, buffer_m), strategy)
    if polygon:
        inside = F.forall(
            F.flatten("rings_m"),
            lambda p: _in_regular_polygon(p.getField("x") - x, p.getField("y") - y, buffer_m, segments),
        )
    else:
        inside = max_vertex_m(F.col("rings_m"), x, y) < buffer_m
    return (
        joined.where(inside)
        .withColumn("distance_to_site_m", st_distance(F.col("rings_m"), x, y))
        .withColumnRenamed("site_id", "nearest_site_id")
        .drop("rings_m", "site_lon", "site_lat", "site_x", "site_y")
    )


def _in_regular_polygon(dx: Column, dy: Column, radius_m: float, segments: int) -> Column:
    """Strictly inside the regular polygon of 4*segments vertices on the circle, one at angle 0."""
    step = math.pi / (2 * segments)
    angle = F.pmod(F.atan2(dy, dx), F.lit(step)) - step / 2
    return F.sqrt(dx * dx + dy * dy) * F.cos(angle) < radius_m * math.cos(step / 2)


def refresh_distance(urban: DataFrame, sites: DataFrame, strategy: str = "auto") -> DataFrame:
    """Recompute distance_to_site_m of features that know their site; other rows keep theirs."""
    strategy = resolve_strategy(sites, strategy)
    placed = with_plane(sites.select("site_id", "lon", "lat"), "site_x", "site_y").select(
        F.col("site_id").alias("nearest_site_id"), "site_x", "site_y"
    )
    if strategy == "broadcast":
        placed = F.broadcast(placed)
    measured = st_distance(F.col("rings_m"), F.col("site_x"), F.col("site_y"))
    known = F.col("distance_to_site_m") if "distance_to_site_m" in urban.columns else F.lit(None).cast("double")
    return (
        with_plane_rings(urban.join(placed, "nearest_site_id", "left"))
        .withColumn("distance_to_site_m", F.when(F.col("site_x").isNotNull(), measured).otherwise(known))
        .drop("site_x", "site_y", "rings_m")
    )


def sites_with_features(sites: DataFrame, urban: DataFrame, radius_m: float, strategy: str = "auto") -> DataFrame:
    """Sites left-joined to their linked features within the radius; sites without any stay."""
    near = urban.where(F.col("distance_to_site_m") <= radius_m).withColumnRenamed("nearest_site_id", "site_id")
    ids = sites.select("site_id")
    if resolve_strategy(sites, strategy) == "broadcast":
        ids = F.broadcast(ids)
    linked = near.select("site_id", "id", "feature_type", "distance_to_site_m").join(ids, "site_id", "left_semi")
    return _with_lonely_sites(linked, sites)


def create_buffers(
    sites: DataFrame, distances_m: tuple[int, ...] = BUFFER_DISTANCES_M, vertices: int = 64
) -> DataFrame:
    """One closed lon/lat ring per site and distance, drawn in EPSG:3035: site_id, buffer_m, ring."""
    placed = with_plane(sites.select("site_id", "lon", "lat"))
    steps = F.sequence(F.lit(0), F.lit(vertices))

    def vertex(i: Column) -> Column:
        angle = (i % vertices) * (2 * math.pi / vertices)
        return from_3035(F.col("x") + F.col("buffer_m") * F.cos(angle), F.col("y") + F.col("buffer_m") * F.sin(angle))

    return placed.withColumn("buffer_m", F.explode(F.array(*[F.lit(d) for d in distances_m]))).select(
        "site_id", "buffer_m", F.transform(steps, vertex).alias("ring")
    )


def validate_projection(spark) -> DataFrame:
    """Two known city distances in EPSG:3035 against their expected range."""
    # fixed values: city coordinates and accepted ranges in km
    cities = {
        "Paris": (2.3522, 48.8566),
        "London": (-0.1276, 51.5074),
        "Rome": (12.4964, 41.9028),
        "Athens": (23.7275, 37.9838),
    }
    checks = [("Paris", "London", 340.0, 350.0), ("Rome", "Athens", 1050.0, 1150.0)]
    rows = [(a, b, *cities[a], *cities[b], lo, hi) for a, b, lo, hi in checks]
    df = spark.createDataFrame(
        rows, "city_a string, city_b string, lon1 double, lat1 double, lon2 double, lat2 double, min_km double, max_km double"
    )
    p1, p2 = to_3035(F.col("lon1"), F.col("lat1")), to_3035(F.col("lon2"), F.col("lat2"))
    km = planar_m(p1.getField("x"), p1.getField("y"), p2.getField("x"), p2.getField("y")) / 1000.0
    return df.select("city_a", "city_b", km.alias("distance_km"), "min_km", "max_km").withColumn(
        "passed", F.col("distance_km").between(F.col("min_km"), F.col("max_km"))
    )


def projection_scale(linked: DataFrame, method: str = "spheroid") -> DataFrame:
    """Per site, the range of EPSG:3035 distance over ground distance of its linked points.

    Rows carry nearest_site_id, lon, lat, site_lon, site_lat. 1 is a faithful projection; far from
    its centre the range shows how much planar distances are off.
    """
    ground = geodesic_m(F.col("lat"), F.col("lon"), F.col("site_lat"), F.col("site_lon"), method)
    placed = with_3035(with_3035(linked, "_x1", "_y1"), "_x2", "_y2", "site_lon", "site_lat").withColumn("_m", ground)
    ratio = F.when(
        F.col("_m") > 0, planar_m(F.col("_x1"), F.col("_y1"), F.col("_x2"), F.col("_y2")) / F.col("_m")
    )
    return (
        placed.select(F.col("nearest_site_id").alias("site_id"), ratio.alias("ratio"))
        .groupBy("site_id")
        .agg(F.count("ratio").alias("features"), F.min("ratio").alias("min_ratio"), F.max("ratio").alias("max_ratio"))
    )
