"""Every registered query against its check SQL, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from ledgerlark.checks import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
QUERIES, ORACLE = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_its_check():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLE) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
    cur = con.execute(ORACLE[name])
    names = [d[0] for d in cur.description]
    at = [names.index(c) for c in cols]
    want = sorted((tuple(r[i] for i in at) for r in cur.fetchall()), key=repr)
    assert sorted(names) == cols and got == want


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
