"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

from textloom.plans.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return con


def _plain(value):
    return round(value, 6) + 0.0 if isinstance(value, float) else value


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, tables, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    mine = sorted((tuple(_plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    assert name in ORACLES
    result = tables.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    theirs = sorted((tuple(_plain(r[p]) for p in places) for r in result.fetchall()), key=repr)
    assert mine == theirs
