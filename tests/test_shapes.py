"""Shapes from WKT and GeoJSON."""

from pyspark.sql import functions as F

from sitewarden.functions import shapes as sh
from sitewarden.operators.exposure import urban_sums
from sitewarden.sources.urban import parse_osm, with_shapes

WKT = {
    "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 2 1, 2 2, 1 2, 1 1))": (15.0, (16 * 2 - 1.5) / 15),
    "SRID=4326;MULTIPOLYGON (((0 0, 1 0, 1 1, 0 1, 0 0)), ((5 0, 5 1, 6 1, 6 0, 5 0)))": (2.0, 3.0),
    "polygon z ((0 0 7, 2 0 7, 2 2 7, 0 2 7, 0 0 7))": (4.0, 1.0),
    "LINESTRING (0 0, 1 0, 1 1, 0 0)": (0.0, 0.5),
    "MULTIPOINT ((1 2), (3 4))": (0.0, 2.0),
    "POINT (-3.5 2e1)": (0.0, -3.5),
}


def test_wkt(spark):
    df = spark.createDataFrame([(t,) for t in WKT], "t string").withColumn("s", sh.from_wkt(F.col("t")))
    rows = {r.t: r for r in df.select("t", sh.shape_area(F.col("s")).alias("a"), sh.shape_centroid(F.col("s")).alias("c")).collect()}
    for text, (area, cx) in WKT.items():
        assert abs(rows[text].a - area) < 1e-12, text
        assert abs(rows[text].c.x - cx) < 1e-12, text


def test_unreadable_texts_have_no_shape(spark):
    texts = [None, "", "POLYGON EMPTY", "nonsense", "GEOMETRYCOLLECTION (POINT (1 1))", "POLYGON ((a b))"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for read in (sh.from_wkt, sh.from_geojson):
        out = df.select(read(F.col("t")).alias("s"))
        assert out.where("s is null").count() == len(texts)
        assert out.where(sh.shape_area(F.col("s")).isNotNull()).count() == 0


def test_geojson_features_get_an_area(spark):
    square = '{"type":"Polygon","coordinates":[[[10,52],[10.01,52],[10.01,52.01],[10,52.01],[10,52]]]}'
    line = '{"type":"LineString","coordinates":[[10,52],[10.01,52],[10,52]]}'
    rows = {r.k: r.area_m2 for r in with_shapes(spark.createDataFrame([(1, square), (2, line), (3, None)], "k int, geometry string")).collect()}
    assert abs(rows[1] / (1113.2 * 0.6157 * 1112.0) - 1) < 0.01
    assert rows[2] == 0.0 and rows[3] is None


def test_features_of_several_polygons_add_up(spark):
    def square(x, size):
        return [[x, 52], [x + size, 52], [x + size, 52 + size], [x, 52 + size], [x, 52]]

    shapes = [
        (1, f'{{"type":"MultiPolygon","coordinates":[[{square(10, 0.01)}],[{square(10.1, 0.01)}]]}}'),
        (2, f'{{"type":"Polygon","coordinates":[{square(10, 0.01)}]}}'),
        (3, f'{{"type":"LineString","coordinates":{square(10, 0.01)}}}'),
        (4, None),
    ]
    rows = spark.createDataFrame(shapes, "osm_id bigint, geometry string").withColumns(
        {"site_id": F.col("osm_id"), "osm_type": F.lit("way"), "tags": F.create_map(F.lit("building"), F.lit("yes"))}
    )
    read = parse_osm(rows)
    assert {r.osm_id: r.n for r in read.select("osm_id", F.size("rings").alias("n")).collect() if r.osm_id < 4} == {1: 2, 2: 1, 3: 1}
    sums = urban_sums(read.withColumns({"id": F.col("osm_id"), "distance_to_site_m": F.lit(1.0)}))
    area = {r.site_id: r.total_area_m2 for r in sums.collect()}
    assert abs(area[1] / area[2] - 2) < 1e-3
    assert area[3] == 0.0 and area[4] is None
    # tables without shapes have one polygon
    plain = urban_sums(read.where("osm_id = 2").drop("shape").withColumns({"id": F.col("osm_id"), "distance_to_site_m": F.lit(1.0)}))
    assert plain.first().total_area_m2 == area[2]
