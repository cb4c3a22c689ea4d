"""Named queries: every operator on the derived tables, whole tables throughout."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from acquaint import SocialTables
from acquaint.operators import lookups, social
from workload.standins import hot_links, social_tables

Query = Callable[[SparkSession, str], DataFrame]

USER_ID = "u7"
UNKNOWN_USER_ID = "nope"
REVIEW_ID = "r7"
YEAR = 1998
FIRST = 5


def _elite_users(t: SocialTables) -> DataFrame:
    """Key table: users who were elite in the year."""
    return t.elites_in(YEAR).select("user_id")


_ON_TABLES: dict[str, Callable[[SocialTables], DataFrame]] = {
    # Scans.
    "scan_users": lambda t: t.users(),
    "scan_reviews": lambda t: t.reviews(),
    "scan_elites": lambda t: t.elites(),
    "scan_friends": lambda t: t.friends(),
    # First rows.
    "limit_users": lambda t: t.first_users(FIRST, "user_id"),
    "limit_reviews": lambda t: t.first_reviews(FIRST, "review_id"),
    "limit_elites": lambda t: t.first_elites(FIRST, "user_id", "year"),
    "limit_friends": lambda t: t.first_friends(FIRST, "user_id", "friend_id"),
    # Lookups.
    "user_by_id": lambda t: t.user_by_id(USER_ID),
    "review_by_id": lambda t: t.review_by_id(REVIEW_ID),
    "reviews_by_user": lambda t: t.reviews_of(USER_ID),
    "elites_by_user": lambda t: t.elites_of(USER_ID),
    "elites_by_year": lambda t: t.elites_in(YEAR),
    "friends_by_user": lambda t: t.friends_of(USER_ID),
    # Lookups for a table of keys.
    "users_for_keys": lambda t: t.users_by_ids(_elite_users(t)),
    "reviews_for_keys": lambda t: t.reviews_of_all(_elite_users(t)),
    "elites_for_keys": lambda t: t.elites_of_all(_elite_users(t)),
    "friends_for_keys": lambda t: t.friends_of_all(_elite_users(t)),
    # Counts.
    "count_friends": lambda t: t.count_friends(USER_ID),
    "count_friends_missing": lambda t: t.count_friends(UNKNOWN_USER_ID),
    "count_reviews_of_user": lambda t: lookups.count_rows(t.reviews_of(USER_ID)),
    "friend_counts_all": lambda t: t.friend_counts(),
    "review_counts_all": lambda t: t.review_counts(),
    # Joins.
    "friends_with_names": lambda t: t.friend_names_of(USER_ID),
    "friend_names_all": lambda t: t.friend_names(),
    "dangling_friends": lambda t: t.dangling_friends(),
    # The same with a third of all links on one friend; adaptive execution splits it.
    "hot_friend_names": lambda t: social.friend_names(hot_links(t.friend), t.user),
    "hot_friend_names_plain": lambda t: social.friend_names(hot_links(t.friend), t.user),
    "user_review_count": lambda t: t.review_counts().where(f"user_id = '{USER_ID}'"),
    "user_profile": lambda t: t.profile_of(USER_ID),
    "user_profiles_all": lambda t: t.profiles(),
    "user_profile_details": lambda t: t.profile_details_of(USER_ID),
    "user_profile_details_all": lambda t: t.profile_details(),
    "first_user_profile": lambda t: t.first_user_profile(),
    # Short forms.
    "user_summary": lambda t: t.user_summaries(),
    "review_summary": lambda t: t.review_summaries(),
    # Inspection.
    "table_inventory": lambda t: t.inventory(),
    "profile_columns": lambda t: t.column_profiles(),
    "first_row": lambda t: t.first_row("review", "review_id"),
    "first_row_user": lambda t: t.first_row("user", "user_id"),
    "first_row_elite": lambda t: t.first_row("elite", "user_id", "year"),
    "first_row_friend": lambda t: t.first_row("friend", "user_id", "friend_id"),
}


def _on_standins(run: Callable[[SocialTables], DataFrame]) -> Query:
    return lambda spark, sf_dir: run(social_tables(spark, sf_dir))


def queries() -> dict[str, Query]:
    return {name: _on_standins(run) for name, run in _ON_TABLES.items()}


def on_tables(name: str, tables: SocialTables) -> DataFrame:
    """A named query over tables from any source."""
    return _ON_TABLES[name](tables)
