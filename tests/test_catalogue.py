"""The driver contract, and the batch queries against their SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as registered
from check import TABLES, table_of

FOLDER = "/root/testdata/sf0.001"


def test_entry(spark):
    result = registered.entry(spark)
    assert result.columns[:3] == ["continent", "country", "state"] and result.count() > 0


def test_every_query_has_sql():
    """Text-corpus queries (op..., pipeline) without SQL have brute-force tests of their own."""
    own = {name for name in registered.queries() if not name.startswith("op") and name != "pipeline"}
    assert own == {name for name in registered.oracle_sql() if not name.startswith("op") and name != "pipeline"}


@pytest.mark.parametrize("name", sorted(registered.oracle_sql()))
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    answer = db.execute(registered.oracle_sql()[name])
    wanted = table_of([d[0] for d in answer.description], answer.fetchall())
    result = registered.queries()[name](spark, FOLDER)
    assert table_of(result.columns, [tuple(r) for r in result.collect()]) == wanted
