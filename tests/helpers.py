"""Small hand-written tables and comparison of results."""

from __future__ import annotations

import datetime as dt
from collections import Counter

from pyspark.sql import DataFrame, SparkSession

from acquaint import SocialTables
from acquaint.schemas import REVIEW, SCHEMAS, USER


def rows(frame: DataFrame) -> Counter:
    """Rows as a multiset of tuples."""
    return Counter(tuple(row) for row in frame.collect())


def by_column(names: list[str], values) -> Counter:
    """Rows as a multiset, columns in name order."""
    order = sorted(range(len(names)), key=names.__getitem__)
    return Counter(tuple(repr(row[i]) for i in order) for row in values)


def frame(spark: SparkSession, table: str, values: list[dict]) -> DataFrame:
    """A stored table from partial rows; columns left out are NULL."""
    schema = SCHEMAS[table]
    filled = [tuple(value.get(f.name) for f in schema.fields) for value in values]
    return spark.createDataFrame(filled, schema)


def tables(spark: SparkSession, **values: list[dict]) -> SocialTables:
    return SocialTables(lambda table: frame(spark, table, values.get(table, [])))


def user(user_id, name=None, **columns) -> dict:
    return {"user_id": user_id, "name": name, **columns}


def review(review_id, user_id, text=None, **columns) -> dict:
    return {"review_id": review_id, "user_id": user_id, "text": text, **columns}


def elite(user_id, year) -> dict:
    return {"user_id": user_id, "year": year}


def friend(user_id, friend_id) -> dict:
    return {"user_id": user_id, "friend_id": friend_id}


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


USER_COLUMNS = USER.fieldNames()
REVIEW_COLUMNS = REVIEW.fieldNames()
