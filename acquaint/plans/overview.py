"""A first look at the tables: what there is, samples, one profile, columns."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

from acquaint.operators import inspection
from acquaint.schemas import SCHEMAS
from acquaint.sources import database as db
from acquaint.tables import SocialTables

FIRST_ROWS = 5

Shown = Iterator[tuple[str, DataFrame]]


def overview(tables: SocialTables, n: int = FIRST_ROWS) -> Shown:
    """Titles and small results for stored tables, which are counted and measured."""
    yield "Tables", tables.inventory()
    yield f"First {n} users", tables.first_users(n, "user_id")
    yield f"First {n} reviews", tables.first_reviews(n, "review_id")
    yield f"First {n} elite rows", tables.first_elites(n, "user_id", "year")
    yield f"First {n} friend links", tables.first_friends(n, "user_id", "friend_id")
    yield "Profile of the first user", tables.first_user_profile()
    for table in SCHEMAS:
        yield f"Columns of {table}", tables.column_profiles(table)
        yield f"A row of {table}", tables.first_row(table)


def database_overview(
    spark: SparkSession, database: db.Database, n: int = FIRST_ROWS
) -> Shown:
    """The same for a database, from its own listings and by lookups only.

    No table is read whole: first rows carry their limit in the query, and the
    profile is that of the first user the database returns.
    """
    yield "Tables", db.list_tables(spark, database)
    for table in SCHEMAS:
        yield f"First {n} rows of {table}", db.first_rows(spark, database, table, n)
    first_user = db.first_rows(spark, database, "user", 1).select("user_id").first()
    if first_user is not None:
        # One user's rows, so each table is one indexed query.
        in_one_task = {table: db.Split() for table in SCHEMAS}
        tables = db.read_database_tables(spark, database, in_one_task)
        yield "Profile of the first user", tables.profile_details_of(first_user["user_id"])
    for table in SCHEMAS:
        yield f"Columns of {table}", db.list_columns(spark, database, table)
        row = db.first_stored_rows(spark, database, table, 1)
        yield f"A row of {table}", inspection.first_row(row)
