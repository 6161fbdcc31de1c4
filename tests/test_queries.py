"""Every registered query against its SQL, value by value."""

from pathlib import Path

import pytest

import __spark_entry__ as entry_module
from gridpulse.plans import batch, oracle, stored, stream

duckdb = pytest.importorskip("duckdb")
QUERIES, SQL = batch.queries() | stream.queries() | stored.queries(), oracle.oracle_sql()  # those of gridpulse.llm have tests of their own


@pytest.fixture(scope="module")
def database(sf_dir):
    connection = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def exact(rows):
    """Rows as a sorted list in which floats compare bit by bit and types count."""


    def bits(value):
        return type(value).__name__, value.hex() if isinstance(value, float) else value

    return sorted((tuple(map(bits, row)) for row in map(tuple, rows)), key=repr)


def test_each_query_has_its_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_module.queries()) and set(SQL) <= set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, database, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    expected = database.sql(SQL[name])
    assert sorted(df.columns) == sorted(expected.columns)
    got = exact(df.select(*expected.columns).collect())
    assert got == exact(expected.fetchall())
    assert got, "no rows compared"


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n.startswith("panel_")))
def test_series_are_in_order(spark, sf_dir, name):
    times = [r["time"] for r in QUERIES[name](spark, sf_dir).collect()]
    assert times == sorted(times)


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["time", "value"] and df.count() > 0
