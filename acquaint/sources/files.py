"""Parquet source: one folder per table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from acquaint.functions.buckets import layout_columns
from acquaint.schemas import schema_of
from acquaint.tables import SocialTables


def read_parquet_tables(spark: SparkSession, root: str) -> SocialTables:
    """The four tables stored as ``<root>/<table>`` (see ``plans.extraction``)."""

    def load(table: str) -> DataFrame:
        stored = spark.read.parquet(f"{root.rstrip('/')}/{table}")
        # Columns that name folders stay, so that lookups can choose folders by them.
        return stored.select(*schema_of(table).fieldNames(), *layout_columns(stored.columns))

    return SocialTables(load)
