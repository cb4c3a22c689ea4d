"""Folders by a hash of the user id: how stored tables name and find them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Folder column of a stored table; the number of buckets follows.
PREFIX = "user_bucket_of_"


def bucket_column(buckets: int) -> str:
    return f"{PREFIX}{buckets}"


def bucket_of(user_id: Column, buckets: int) -> Column:
    """Bucket of an id, NULL included, from 0."""
    return F.pmod(F.xxhash64(user_id.cast("string")), F.lit(buckets)).cast("int")


def layout_columns(columns: Sequence[str]) -> list[str]:
    """Columns that only name folders."""
    return [c for c in columns if c.startswith(PREFIX)]


def within_bucket(stored: DataFrame, user_id: Column) -> DataFrame:
    """Rows of the folders that can hold a user; all rows of a table without buckets."""
    for column in layout_columns(stored.columns):
        buckets = int(column.removeprefix(PREFIX))
        stored = stored.where(F.col(column) == bucket_of(user_id, buckets))
    return stored
