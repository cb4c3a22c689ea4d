"""Fixed table layouts of the social-review dataset.

Column names, their order and their types are fixed values: stored tables and
callers rely on them.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Columns and types of each table, in stored order.
USER = T.StructType(
    [
        T.StructField("average_stars", T.DoubleType()),
        T.StructField("compliment_cool", T.LongType()),
        T.StructField("compliment_cute", T.LongType()),
        T.StructField("compliment_funny", T.LongType()),
        T.StructField("compliment_hot", T.LongType()),
        T.StructField("compliment_list", T.LongType()),
        T.StructField("compliment_more", T.LongType()),
        T.StructField("compliment_note", T.LongType()),
        T.StructField("compliment_photos", T.LongType()),
        T.StructField("compliment_plain", T.LongType()),
        T.StructField("compliment_profile", T.LongType()),
        T.StructField("compliment_writer", T.LongType()),
        T.StructField("cool", T.LongType()),
        T.StructField("fans", T.LongType()),
        T.StructField("funny", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("review_count", T.LongType()),
        T.StructField("useful", T.LongType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("yelping_since", T.DateType()),
    ]
)

REVIEW = T.StructType(
    [
        T.StructField("business_id", T.StringType()),
        T.StructField("cool", T.LongType()),
        T.StructField("date", T.DateType()),
        T.StructField("funny", T.LongType()),
        T.StructField("review_id", T.StringType()),
        T.StructField("stars", T.DoubleType()),
        T.StructField("text", T.StringType()),
        T.StructField("useful", T.LongType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("spark_partition", T.IntegerType()),
    ]
)

ELITE = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("year", T.IntegerType()),
    ]
)

FRIEND = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("friend_id", T.StringType()),
    ]
)

SCHEMAS = {"user": USER, "review": REVIEW, "elite": ELITE, "friend": FRIEND}

# Short columns that tell the rows of a table apart.
ROW_KEYS = {
    "user": ("user_id",),
    "review": ("review_id",),
    "elite": ("user_id", "year"),
    "friend": ("user_id", "friend_id"),
}

# Columns of the short form of a user and of a review, in order,
# and the longest review text shown in full.
USER_SUMMARY = (
    "user_id",
    "name",
    "average_stars",
    "review_count",
    "fans",
    "yelping_since",
    "cool",
    "funny",
    "useful",
)
REVIEW_SUMMARY = (
    "review_id",
    "user_id",
    "business_id",
    "stars",
    "date",
    "text",
    "useful",
    "funny",
    "cool",
)
SUMMARY_TEXT_LENGTH = 50


def schema_of(table: str) -> T.StructType:
    """Layout of a table by its exact name; an unknown name raises."""
    if table not in SCHEMAS:
        raise ValueError(f"unknown table {table!r}; expected one of {sorted(SCHEMAS)}")
    return SCHEMAS[table]
