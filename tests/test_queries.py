"""Every query with a SQL counterpart agrees with it on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check import NAMES, canonical

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for n in NAMES:
        con.execute(f"CREATE VIEW {n} AS SELECT * FROM '{FOLDER}/{n}.parquet'")
    return con


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query(spark, sql, key):
    got, want = QUERIES[key](spark, FOLDER).toPandas(), sql.execute(ORACLES[key]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns[0] < df.columns[-1]
