"""Extraction job: the four tables of any source into Parquet.

The layout serves the lookups that follow. Users, reviews and links are stored by
a hash of the user id, elite rows by year, so a lookup opens only the folder that
can hold its key. Within files rows are sorted by user, and ids carry Bloom
filters, so it skips row groups and pages too.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acquaint.functions import cast_fields
from acquaint.functions.buckets import bucket_column, bucket_of
from acquaint.schemas import ROW_KEYS, SCHEMAS
from acquaint.tables import SocialTables

#: Folders of a table by user id. A lookup by user reads one of them: choose so
#: many that a folder of the largest table holds a few files.
BUCKETS = 64

#: Tasks that write one folder where adaptive execution is off and cannot cut one.
SLICES = 4


@dataclass(frozen=True)
class Layout:
    """Order inside files, indexed ids, and the stored column that names folders;
    without one, folders are by user."""

    sort_by: tuple[str, ...]
    ids: tuple[str, ...] = ("user_id",)
    folder_by: str | None = None


LAYOUTS = {
    "user": Layout(("user_id",)),
    "review": Layout(("user_id", "review_id"), ids=("user_id", "review_id")),
    "elite": Layout(("user_id",), folder_by="year"),
    "friend": Layout(("user_id", "friend_id")),
}


def extract_tables(
    tables: SocialTables, root: str, mode: str = "errorifexists", buckets: int = BUCKETS
) -> None:
    """Write every table as ``<root>/<table>``, in fixed types."""
    for table in SCHEMAS:
        extract_table(tables.stored(table), table, root, mode, buckets)


def extract_table(
    stored: DataFrame,
    table: str,
    root: str,
    mode: str = "errorifexists",
    buckets: int = BUCKETS,
) -> None:
    """Write one table as ``<root>/<table>``, in fixed types.

    NULLs are stored as NULLs: the typed form is made on reading, so lookups and
    column profiles give the same on the written tables as on the source.

    Rows are gathered by folder. Adaptive execution cuts a folder that is too
    large (a user or a year with a third of all rows) into several files and
    merges small ones; without it every folder is written by ``SLICES`` tasks.
    The source is read once.
    """
    layout = LAYOUTS[table]
    rows = cast_fields(stored, table)
    folder = layout.folder_by
    if folder is None:
        folder = bucket_column(buckets)
        rows = rows.withColumn(folder, bucket_of(F.col("user_id"), buckets))
    rows = _gathered(rows, F.col(folder), ROW_KEYS[table]).sortWithinPartitions(
        folder, *layout.sort_by
    )
    writer = rows.write.mode(mode).option("parquet.bloom.filter.adaptive.enabled", "true")
    for column in layout.ids:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    writer.partitionBy(folder).parquet(f"{root.rstrip('/')}/{table}")


def _gathered(rows: DataFrame, folder: Column, row_key: tuple[str, ...]) -> DataFrame:
    if rows.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
        return rows.hint("rebalance", folder)
    # Rows that are equal in their key are dealt out by their task.
    slice_ = F.pmod(F.xxhash64(F.spark_partition_id(), *row_key), F.lit(SLICES))
    return rows.repartition(folder, slice_)
