"""Registered queries against their SQL on the smallest data; tools/compare.py runs all of them."""

import os

import duckdb
import pytest

import __spark_entry__ as contract

DATA = "/root/testdata/sf0.001"
KEYS = [
    "agg_climate_extremes",
    "agg_country_risk",
    "join_nearest_lateral",
    "join_within_distance",
    "ml_risk_pipeline",
    "snk_upsert_quakes",
    "src_sites_xml",
    "val_sites",
]

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(DATA):
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{DATA}/{name}'")
    return con


def canonical(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([tuple(str(row[i]) for i in order) for row in rows])


@pytest.mark.parametrize("key", KEYS)
def test_query_equals_sql(spark, duck, key):
    df = contract.queries()[key](spark, DATA)
    result = duck.execute(contract.oracle_sql()[key])
    names = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(names)
    assert canonical(df.collect(), df.columns) == canonical(result.fetchall(), names)


def test_entry(spark):
    assert contract.entry(spark).count() == 10


def test_every_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_scores_do_not_depend_on_the_join_route(spark):
    from sitewarden.plans import registry
    from sitewarden.plans.scoring import risk_scores

    t = registry.Tables(spark, DATA)
    tables = (t.sites, t.urban, t.climate, t.quakes, t.fires, t.floods)
    small = {r.site_id: r for r in risk_scores(*tables, strategy="broadcast").collect()}
    large = {r.site_id: r for r in risk_scores(*tables, strategy="shuffle").collect()}
    assert small.keys() == large.keys() and len(small) == 10
    for site, row in small.items():
        assert row.risk_level == large[site].risk_level
        assert abs(row.composite_risk_score - large[site].composite_risk_score) < 1e-9
