"""Every registered query against the same question in SQL on another engine."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from tests.helpers import by_column
from workload import oracle, registry

# Types as the two engines name them.
SPARK_TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "DATE": "date",
    "VARCHAR": "string",
}

QUERIES = registry.queries()
SQL = oracle.oracle_sql()


@pytest.fixture(scope="module")
def other_engine(sf_dir):
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    yield connection
    connection.close()


def test_every_query_has_sql_and_is_registered():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries())
    assert set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(name, spark, sf_dir, other_engine):
    result = QUERIES[name](spark, sf_dir)
    expected = other_engine.execute(SQL[name])
    columns = [column[0] for column in expected.description]
    types = {column[0]: SPARK_TYPES[str(column[1])] for column in expected.description}
    assert dict(result.dtypes) == types
    assert result.columns == columns
    got = by_column(result.columns, result.collect())
    assert got
    assert got == by_column(columns, expected.fetchall())


@pytest.mark.parametrize("table", ["users", "reviews", "elites", "friends"])
def test_key_lookups_keep_the_column_order_of_the_table(table, spark, sf_dir):
    found = QUERIES[f"{table}_for_keys"](spark, sf_dir)
    assert found.columns == QUERIES[f"scan_{table}"](spark, sf_dir).columns


def test_entry_is_the_flagship(spark):
    result = entry.entry(spark)
    assert result.columns[:2] == ["user_id", "name"]
    assert result.count() > 0
