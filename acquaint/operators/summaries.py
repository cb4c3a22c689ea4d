"""Short forms of users and reviews for display."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acquaint.functions import shorten, typed
from acquaint.schemas import REVIEW_SUMMARY, USER_SUMMARY


def user_summary(users: DataFrame) -> DataFrame:
    return typed(users, "user").select(*USER_SUMMARY)


def review_summary(reviews: DataFrame) -> DataFrame:
    """Summary columns with the text shortened; NULL text stays NULL."""
    return (
        typed(reviews, "review")
        .withColumn("text", shorten(F.col("text")))
        .select(*REVIEW_SUMMARY)
    )
