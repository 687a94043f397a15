import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, normalized

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def test_every_statement_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_statement(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    mine = normalized(df.columns, [tuple(r) for r in df.collect()])
    assert mine[1]
    if name in ORACLES:
        cursor = con.execute(ORACLES[name])
        assert mine == normalized([d[0] for d in cursor.description], cursor.fetchall())


def test_entry(spark):
    assert entry.entry(spark).columns == ["word", "n"]
