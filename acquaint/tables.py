"""The four stored tables as one value, with the accessors callers use."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acquaint.functions import equals_key
from acquaint.functions.buckets import layout_columns, within_bucket
from acquaint.operators import inspection, lookups, social, summaries
from acquaint.schemas import SCHEMAS, USER, schema_of


class SocialTables:
    """The stored (untyped) tables of any source; accessors return lazy DataFrames.

    ``load`` gives the stored frame of a table name. It is called when a table
    is first used, so a query opens only the tables it reads.
    """

    def __init__(self, load: Callable[[str], DataFrame]):
        self._load = load
        self._stored: dict[str, DataFrame] = {}

    def stored(self, table: str) -> DataFrame:
        """A stored frame by its exact table name; an unknown name raises."""
        schema_of(table)
        if table not in self._stored:
            self._stored[table] = self._load(table)
        return self._stored[table]

    @property
    def user(self) -> DataFrame:
        return self.stored("user")

    @property
    def review(self) -> DataFrame:
        return self.stored("review")

    @property
    def elite(self) -> DataFrame:
        return self.stored("elite")

    @property
    def friend(self) -> DataFrame:
        return self.stored("friend")

    def plain(self, table: str) -> DataFrame:
        """A stored frame without columns that only name folders."""
        stored = self.stored(table)
        return stored.drop(*layout_columns(stored.columns))

    def items(self) -> Iterator[tuple[str, DataFrame]]:
        return ((table, self.plain(table)) for table in SCHEMAS)

    def _of_user(self, user_id: Column) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
        """Users, reviews, links and elite rows of the folders that can hold a user."""
        tables = ("user", "review", "friend", "elite")
        return tuple(within_bucket(self.stored(table), user_id) for table in tables)

    def create_views(self, prefix: str = "") -> None:
        """Register the stored frames for ``spark.sql(..., args={...})``."""
        for table, frame in self.items():
            frame.createOrReplaceTempView(f"{prefix}{table}")

    # Users.

    def users(self) -> DataFrame:
        return lookups.scan(self.user, "user")

    def first_users(self, n: int, *order_by: str) -> DataFrame:
        return lookups.first_rows(self.user, "user", n, *order_by)

    def user_by_id(self, user_id: str | None) -> DataFrame:
        return lookups.one_by_key(self.user, "user", "user_id", user_id)

    def users_by_ids(self, user_ids: DataFrame) -> DataFrame:
        """One row per known id of a one-column key table."""
        found = lookups.for_keys(self.user, "user", "user_id", user_ids)
        return lookups.scan(social.one_row_per_user(found, *USER.fieldNames()), "user")

    def user_summaries(self) -> DataFrame:
        return summaries.user_summary(self.user)

    # Reviews.

    def reviews(self) -> DataFrame:
        return lookups.scan(self.review, "review")

    def first_reviews(self, n: int, *order_by: str) -> DataFrame:
        return lookups.first_rows(self.review, "review", n, *order_by)

    def review_by_id(self, review_id: str | None) -> DataFrame:
        return lookups.one_by_key(self.review, "review", "review_id", review_id)

    def reviews_of(self, user_id: str | None) -> DataFrame:
        return lookups.by_key(self.review, "review", "user_id", user_id)

    def reviews_of_all(self, user_ids: DataFrame) -> DataFrame:
        return lookups.wide_for_keys(self.review, "review", "user_id", user_ids)

    def review_summaries(self) -> DataFrame:
        return summaries.review_summary(self.review)

    def review_counts(self) -> DataFrame:
        return social.review_counts(self.user, self.review)

    # Elite years.

    def elites(self) -> DataFrame:
        return lookups.scan(self.elite, "elite")

    def first_elites(self, n: int, *order_by: str) -> DataFrame:
        return lookups.first_rows(self.elite, "elite", n, *order_by)

    def elites_of(self, user_id: str | None) -> DataFrame:
        return lookups.by_key(self.elite, "elite", "user_id", user_id)

    def elites_of_all(self, user_ids: DataFrame) -> DataFrame:
        return lookups.for_keys(self.elite, "elite", "user_id", user_ids)

    def elites_in(self, year: int | None) -> DataFrame:
        return lookups.by_key(self.elite, "elite", "year", year)

    # Friend links.

    def friends(self) -> DataFrame:
        return lookups.scan(self.friend, "friend")

    def first_friends(self, n: int, *order_by: str) -> DataFrame:
        return lookups.first_rows(self.friend, "friend", n, *order_by)

    def friends_of(self, user_id: str | None) -> DataFrame:
        return lookups.by_key(self.friend, "friend", "user_id", user_id)

    def friends_of_all(self, user_ids: DataFrame) -> DataFrame:
        return lookups.for_keys(self.friend, "friend", "user_id", user_ids)

    def count_friends(self, user_id: str | None) -> DataFrame:
        return lookups.count_by_key(self.friend, "user_id", user_id)

    def friend_counts(self) -> DataFrame:
        return social.friend_counts(self.user, self.friend)

    def friend_names(self) -> DataFrame:
        return social.friend_names(self.friend, self.user)

    def friend_names_of(self, user_id: str | None) -> DataFrame:
        return social.friend_names(self.friends_of(user_id), self.user)

    def dangling_friends(self) -> DataFrame:
        return social.dangling_friends(self.friend, self.user)

    # Profiles.

    def profiles(self) -> DataFrame:
        return social.user_profiles(self.user, self.review, self.friend, self.elite)

    def profile_of(self, user_id: str | None) -> DataFrame:
        profiles = social.user_profiles(*self._of_user(F.lit(user_id)))
        return profiles.where(equals_key("user_id", user_id))

    def profile_details(self) -> DataFrame:
        return social.user_profile_details(self.user, self.review, self.friend, self.elite)

    def profile_details_of(self, user_id: str | None) -> DataFrame:
        profiles = social.user_profile_details(*self._of_user(F.lit(user_id)))
        return profiles.where(equals_key("user_id", user_id))

    def first_user_profile(self) -> DataFrame:
        """Detailed profile of the user with the smallest id."""
        smallest = self.user.agg(F.min("user_id")).scalar()
        profiles = social.user_profile_details(*self._of_user(smallest))
        return profiles.where(F.col("user_id") == smallest)

    # Inspection.

    def inventory(self) -> DataFrame:
        return inspection.table_inventory(self.items())

    def column_profiles(self, *tables: str) -> DataFrame:
        chosen = tables or tuple(SCHEMAS)
        return inspection.profile_columns([(t, self.plain(t)) for t in chosen])

    def first_row(self, table: str, *order_by: str) -> DataFrame:
        return inspection.first_row(self.plain(table), *order_by)
