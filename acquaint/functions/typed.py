"""Fixed-type views of a stored table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from acquaint.schemas import schema_of


def cast_fields(stored: DataFrame, table: str) -> DataFrame:
    """The table's fixed columns in their fixed types, every NULL kept.

    A date that carries a time part loses it. Casts follow the session's ANSI
    mode, so a malformed value raises.
    """
    return stored.selectExpr(*[f"{_cast(f)} AS `{f.name}`" for f in schema_of(table).fields])


def typed(stored: DataFrame, table: str) -> DataFrame:
    """``cast_fields`` with NULL numbers as 0, the form callers see.

    Filters on stored values belong *before* this projection: SQL equality sees
    the stored NULL (which matches nothing), the typed column shows 0. Applying
    it twice changes nothing.
    """
    return stored.selectExpr(
        *[f"{_zero_for_null(f)} AS `{f.name}`" for f in schema_of(table).fields]
    )


def _cast(field: T.StructField) -> str:
    return f"CAST(`{field.name}` AS {field.dataType.simpleString()})"


def _zero_for_null(field: T.StructField) -> str:
    value = _cast(field)
    return f"coalesce({value}, 0)" if isinstance(field.dataType, T.NumericType) else value
