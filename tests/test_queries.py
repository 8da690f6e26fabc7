"""Every registered query against its SQL twin on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_points

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = entry_points.queries()
SQL = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in ("events", "documents", "benchmark", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return con


def test_every_query_has_a_twin():
    from zonewatch.plans import oracles, queries

    assert set(queries.registry()) == set(oracles.build())
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, name):
    found = QUERIES[name](spark, SF_DIR)
    columns = sorted(found.columns)
    ours = sorted((tuple(r) for r in found.select(*[f"`{c}`" for c in columns]).collect()), key=str)
    twin = duck.execute(SQL[name])
    names = [c[0] for c in twin.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    theirs = sorted((tuple(r[i] for i in places) for r in twin.fetchall()), key=str)
    assert ours == theirs


def test_entry_is_lazy_and_has_rows(spark):
    found = entry_points.entry(spark)
    assert "alert_level" in found.columns
    assert found.count() > 0
