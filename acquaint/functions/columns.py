"""Column expressions shared by the operators; all are built-in Spark functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from acquaint.schemas import SUMMARY_TEXT_LENGTH


def name_sql(column: str) -> str:
    """A column's exact name in a Spark SQL expression, dots and backticks included."""
    return "`" + column.replace("`", "``") + "`"


def text_sql(value: str) -> str:
    """A text constant in a Spark SQL expression."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def equals_key(column: str, key: object) -> Column:
    """SQL equality with a bound value: a NULL key matches nothing."""
    return F.col(column) == F.lit(key)


def shorten(text: Column, length: int = SUMMARY_TEXT_LENGTH) -> Column:
    """First ``length`` characters and ``...`` when the text is longer than that."""
    return F.when(
        F.length(text) > length, F.concat(F.substring(text, 1, length), F.lit("..."))
    ).otherwise(text)
