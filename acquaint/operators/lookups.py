"""Scans, first rows, equality lookups and counts over one stored table.

Each function takes the stored frame, filters on stored values, and types the
surviving rows, so the key comparison reaches the Parquet or JDBC scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acquaint.functions import equals_key, typed
from acquaint.functions.buckets import within_bucket


def scan(stored: DataFrame, table: str) -> DataFrame:
    """All rows, typed."""
    return typed(stored, table)


def first_rows(stored: DataFrame, table: str, n: int, *order_by: str) -> DataFrame:
    """``n`` rows: any ``n`` without an order, the smallest ``n`` with one.

    With an order Spark keeps ``n`` rows per task and merges those, it does not
    sort the table. 0 gives no rows, a negative ``n`` raises.
    """
    rows = typed(stored, table)
    if order_by:
        rows = rows.orderBy(*order_by)
    return rows.limit(n)


def by_key(stored: DataFrame, table: str, column: str, key: object) -> DataFrame:
    """All rows whose column equals the key; a NULL key matches nothing."""
    return typed(_with_key(stored, column, key), table)


def _with_key(stored: DataFrame, column: str, key: object) -> DataFrame:
    if column == "user_id":
        stored = within_bucket(stored, F.lit(key))
    return stored.where(equals_key(column, key))


def one_by_key(
    stored: DataFrame, table: str, column: str, key: object, *order_by: str
) -> DataFrame:
    """At most one row whose column equals the key."""
    rows = by_key(stored, table, column, key)
    if order_by:
        rows = rows.orderBy(*order_by)
    return rows.limit(1)


def count_by_key(stored: DataFrame, column: str, key: object) -> DataFrame:
    """One row with the number of rows whose column equals the key, 0 if none."""
    return count_rows(_with_key(stored, column, key))


def count_rows(rows: DataFrame) -> DataFrame:
    """One row with the number of rows."""
    return rows.agg(F.count(F.lit(1)).alias("count"))


def for_keys(stored: DataFrame, table: str, column: str, keys: DataFrame) -> DataFrame:
    """Rows whose column equals any key of a key table, in one job.

    ``keys`` has one column. It may hold repeats and NULLs: repeats do not
    repeat rows and NULL matches nothing. Columns are in the table's own order.
    """
    rows = typed(stored, table)
    return rows.join(keys.toDF(column), column, "left_semi").select(*rows.columns)


def wide_for_keys(stored: DataFrame, table: str, column: str, keys: DataFrame) -> DataFrame:
    """The rows of ``for_keys``, for a table of long rows that may come from a join.

    Spark leaves a semi join above computed columns, where all rows would be
    shuffled with their text. It moves a filter below them and below a join that
    adds text, so only the rows of a key are carried on. Keys of another type
    than the column are compared as a join does, not as IN does.
    """
    rows = typed(stored, table)
    wanted = keys.toDF(column)
    if wanted.schema[column].dataType != rows.schema[column].dataType:
        return for_keys(stored, table, column, keys)
    key = F.col(column)
    return rows.where(key.isNotNull() & key.isin(wanted.where(key.isNotNull())))
