"""What the stored tables hold: inventory, column profile, one row as text."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acquaint.functions import name_sql, text_sql


def table_inventory(tables: Iterable[tuple[str, DataFrame]]) -> DataFrame:
    """One row per table: name, number of columns, number of rows."""
    counted = [
        frame.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(table).alias("table_name"),
            F.lit(len(frame.columns)).alias("column_count"),
            "row_count",
        )
        for table, frame in tables
    ]
    return reduce(DataFrame.unionByName, counted)


def profile_columns(tables: Iterable[tuple[str, DataFrame]]) -> DataFrame:
    """One row per column: position, name, type, NULLs and longest value as text.

    Each table is read once; its columns are measured side by side in a single
    aggregate and turned into rows afterwards. Stored files declare neither a
    column size nor whether NULL may occur, so both are measured.
    """
    return reduce(DataFrame.unionByName, [_profile(t, frame) for t, frame in tables])


def _profile(table: str, frame: DataFrame) -> DataFrame:
    measured = [
        f"named_struct('position', {position}, 'column_name', {text_sql(name)},"
        f" 'data_type', {text_sql(data_type)},"
        f" 'null_count', count(*) - count({name_sql(name)}),"
        f" 'longest_text', {_longest_text(name_sql(name), data_type)})"
        for position, (name, data_type) in enumerate(frame.dtypes, start=1)
    ]
    return frame.selectExpr(f"array({', '.join(measured)}) AS measured").select(
        F.lit(table).alias("table_name"), F.inline("measured")
    )


def _longest_text(column: str, data_type: str) -> str:
    """Length of the longest value as text.

    Among whole numbers that is the smallest or the largest one, so they are
    compared as numbers and only those two are turned into text.
    """
    if data_type in ("tinyint", "smallint", "int", "bigint"):
        return f"greatest(length(string(min({column}))), length(string(max({column}))))"
    return f"max(length(string({column})))"


def first_row(frame: DataFrame, *order_by: str) -> DataFrame:
    """One stored row as position, column name and value; no rows if empty.

    Values are as stored, as text (NULL stays NULL). Without an order it is any row.
    """
    row = (frame.orderBy(*order_by) if order_by else frame).limit(1)
    fields = [
        f"named_struct('position', {position}, 'column_name', {text_sql(name)},"
        f" 'value', string({name_sql(name)}))"
        for position, name in enumerate(frame.columns, start=1)
    ]
    return row.selectExpr(f"inline(array({', '.join(fields)}))")
