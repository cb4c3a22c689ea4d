"""Counts and joins over users, reviews, friend links and elite years.

Every function takes stored frames. Child tables are counted per user before
they meet the users, so no join multiplies rows and a user with a very large
share of a child table reaches the shuffle as a few partial counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acquaint.functions import typed
from acquaint.operators.summaries import review_summary
from acquaint.schemas import REVIEW_SUMMARY, USER_SUMMARY


def one_row_per_user(users: DataFrame, *columns: str) -> DataFrame:
    """One row per user id with the given columns, all from the same stored row.

    Among repeated ids the smallest row is kept, so reruns agree. A row without
    an id names no user and is left out.
    """
    kept = F.struct(*columns)
    return (
        typed(users, "user")
        .where(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(F.min(kept).alias("kept"))
        .select("user_id", *[F.col(f"kept.{c}").alias(c) for c in columns if c != "user_id"])
    )


def friend_counts(users: DataFrame, friends: DataFrame) -> DataFrame:
    """Outgoing links of every user, repeats counted, 0 for users with none."""
    counted = _links_per_user(friends)
    return (
        typed(users, "user")
        .select("user_id")
        .where(F.col("user_id").isNotNull())
        .distinct()
        .join(counted, "user_id", "left")
        .select("user_id", F.coalesce("friend_count", F.lit(0)).alias("friend_count"))
    )


def review_counts(users: DataFrame, reviews: DataFrame) -> DataFrame:
    """Name and number of reviews of every user, 0 for users with none."""
    counted = (
        typed(reviews, "review").groupBy("user_id").agg(F.count(F.lit(1)).alias("review_count"))
    )
    return (
        one_row_per_user(users, "name")
        .join(counted, "user_id", "left")
        .select(
            "user_id", "name", F.coalesce("review_count", F.lit(0)).alias("review_count")
        )
    )


def friend_names(friends: DataFrame, users: DataFrame) -> DataFrame:
    """Links with the name of the friend; links to unknown users are skipped.

    Repeated links repeat the name and links are not mirrored.
    """
    named = one_row_per_user(users, "name").withColumnRenamed("user_id", "friend_id")
    links = typed(friends, "friend").join(named, "friend_id")
    return links.select("user_id", "friend_id", "name")


def dangling_friends(friends: DataFrame, users: DataFrame) -> DataFrame:
    """Links whose friend is not a known user, NULL friends included."""
    known = typed(users, "user").select(F.col("user_id").alias("friend_id")).distinct()
    links = typed(friends, "friend").join(known, "friend_id", "left_anti")
    return links.select("user_id", "friend_id")


def user_profiles(
    users: DataFrame,
    reviews: DataFrame,
    friends: DataFrame,
    elites: DataFrame,
    user_columns: Sequence[str] = ("name",),
    review_columns: Sequence[str] = ("stars",),
) -> DataFrame:
    """One row per user: own columns, reviews, friend links and elite years.

    ``first_review_*`` columns come from the user's review with the smallest id;
    a review without an id comes after all others.
    ``elite_year_list`` lists the years in order; a year stored ``n`` times
    (``n`` > 1) is written ``year(n)``, so ``elite_years`` rows are all in it.

    All five frames are grouped by ``user_id`` before the joins and the joins
    use that same key, so no table is shuffled again for them. A filter on
    ``user_id`` after this function reaches every scan.
    """
    people = one_row_per_user(users, *user_columns)
    profile = (
        people.join(_reviews_per_user(reviews, review_columns), "user_id", "left")
        .join(_links_per_user(friends), "user_id", "left")
        .join(_years_per_user(elites), "user_id", "left")
    )
    zero = F.lit(0)
    return profile.select(
        "user_id",
        *user_columns,
        F.coalesce("reviews_written", zero).alias("reviews_written"),
        F.col("first_review.review_id").alias("first_review_id"),
        *[F.col(f"first_review.{c}").alias(f"first_review_{c}") for c in review_columns],
        F.coalesce("friend_count", zero).alias("friend_count"),
        F.coalesce("elite_years", zero).alias("elite_years"),
        "elite_year_list",
    )


def user_profile_details(
    users: DataFrame, reviews: DataFrame, friends: DataFrame, elites: DataFrame
) -> DataFrame:
    """Profiles with every column of the short user and review forms."""
    return user_profiles(
        users,
        reviews,
        friends,
        elites,
        user_columns=[c for c in USER_SUMMARY if c != "user_id"],
        review_columns=[c for c in REVIEW_SUMMARY if c not in ("review_id", "user_id")],
    )


def _reviews_per_user(reviews: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of reviews and the review with the smallest id, text shortened."""
    first = F.struct(F.col("review_id").isNull().alias("no_id"), "review_id", *columns)
    return (
        review_summary(reviews)
        .groupBy("user_id")
        .agg(F.count(F.lit(1)).alias("reviews_written"), F.min(first).alias("first_review"))
    )


def _links_per_user(friends: DataFrame) -> DataFrame:
    return (
        typed(friends, "friend").groupBy("user_id").agg(F.count(F.lit(1)).alias("friend_count"))
    )


def _years_per_user(elites: DataFrame) -> DataFrame:
    """Elite rows per user and their years as text.

    Repeated rows are counted first, so what is gathered for one user is its
    distinct years, however many rows it has.
    """
    year = F.col("year").cast("string")
    per_year = typed(elites, "elite").groupBy("user_id", "year").agg(F.count(F.lit(1)).alias("n"))
    shown = F.when(F.col("n") == 1, year).otherwise(
        F.concat(year, F.lit("("), F.col("n").cast("string"), F.lit(")"))
    )
    return (
        per_year.groupBy("user_id")
        .agg(
            F.sum("n").alias("elite_years"),
            F.sort_array(F.collect_list(F.struct("year", shown.alias("shown")))).alias("listed"),
        )
        .select(
            "user_id",
            "elite_years",
            F.array_join(F.col("listed.shown"), ",").alias("elite_year_list"),
        )
    )
