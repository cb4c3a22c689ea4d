"""Relational database source over JDBC, read by many tasks at once.

Connection options come from the caller or the environment, never from code.
A table is split by a numeric column (``range_split``), by a hash of key columns
(``hash_split``) or, on PostgreSQL, by storage page (``page_split``). Pages suit
a whole table best: tasks get equal shares whatever the keys, and the database
reads the table once, where hash splits make it read the table once per task.
Each task reads in its own transaction, so a table that is being written to is
not read as one snapshot. Whole-table joins read their tables more than once;
extract a large database first and join the Parquet copy.
"""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from acquaint.functions import equals_key, typed
from acquaint.schemas import SCHEMAS, schema_of
from acquaint.tables import SocialTables

ENVIRONMENT_PREFIX = "ACQUAINT_JDBC_"

JDBC_CATALOG = "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog"

# Of a table split by pages, what a task reads unless a number of parts is given.
BYTES_PER_PART = 128 << 20

DEFAULT_OPTIONS = {
    # Rows per round trip; the PostgreSQL driver otherwise fetches a whole result.
    "fetchsize": "10000",
    # Times without a zone stay as they are, whatever the session's time zone.
    "preferTimestampNTZ": "true",
}


@dataclass(frozen=True)
class Split:
    """How a table read is cut into tasks: reader options or one filter per task."""

    options: Mapping[str, str] = field(default_factory=dict)
    predicates: Sequence[str] = ()


@dataclass(frozen=True)
class Database:
    """Where the tables are: Spark JDBC options and the schema that holds them."""

    options: Mapping[str, str]
    schema: str | None = None

    @classmethod
    def from_environment(cls, environment: Mapping[str, str] | None = None) -> Database:
        """Options from ``ACQUAINT_JDBC_URL``, ``_USER``, ``_PASSWORD``, ``_DRIVER``
        and the schema from ``ACQUAINT_JDBC_SCHEMA``."""
        environment = os.environ if environment is None else environment
        given = {
            name.lower(): environment[ENVIRONMENT_PREFIX + name]
            for name in ("URL", "USER", "PASSWORD", "DRIVER", "SCHEMA")
            if ENVIRONMENT_PREFIX + name in environment
        }
        if "url" not in given:
            raise ValueError(f"{ENVIRONMENT_PREFIX}URL is not set")
        schema = given.pop("schema", None)
        return cls(given, schema)

    def qualified(self, table: str) -> str:
        return qualified_name(table, self.schema)


def qualified_name(table: str, schema: str | None = None) -> str:
    """Quoted table name; quotes inside a name cannot end it."""
    return ".".join(quoted(part) for part in (schema, table) if part is not None)


def quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def read_database_tables(
    spark: SparkSession, database: Database, splits: Mapping[str, Split] | None = None
) -> SocialTables:
    """The four tables of a database, each read by many tasks.

    A table without a split is measured when it is first used and split by its
    pages. Give ``Split()`` to read one in one task, as lookups of a key do well.
    """
    splits = splits or {}

    def load(table: str) -> DataFrame:
        split = splits.get(table)
        if split is None:
            split = measured_page_split(spark, database, table)
        return read_table(spark, database, table, split)

    return SocialTables(load)


def read_table(
    spark: SparkSession, database: Database, table: str, split: Split | None = None
) -> DataFrame:
    """A table as stored; filters and column choices made later reach the database."""
    split = split or Split()
    options = {**DEFAULT_OPTIONS, **database.options, **split.options}
    if split.predicates:
        return spark.read.jdbc(
            url=options.pop("url"),
            table=database.qualified(table),
            predicates=list(split.predicates),
            properties=options,
        )
    return spark.read.format("jdbc").options(**options, dbtable=database.qualified(table)).load()


def read_catalog_tables(spark: SparkSession, *namespace: str) -> SocialTables:
    """The four tables of a catalog Spark knows, such as one from ``register_catalog``."""

    def load(table: str) -> DataFrame:
        parts = (*namespace, table)
        return spark.table(".".join("`" + part.replace("`", "``") + "`" for part in parts))

    return SocialTables(load)


def register_catalog(spark: SparkSession, name: str, database: Database) -> None:
    """Make the database a Spark catalog, so that counts and limits run inside it.

    Read this way a table is scanned by one task: use it for lookups and counts,
    and ``read_database_tables`` with splits for whole tables.
    """
    prefix = f"spark.sql.catalog.{name}"
    spark.conf.set(prefix, JDBC_CATALOG)
    for option, value in {**DEFAULT_OPTIONS, **database.options}.items():
        spark.conf.set(f"{prefix}.{option}", value)


def first_rows(spark: SparkSession, database: Database, table: str, n: int) -> DataFrame:
    """Any ``n`` typed rows, with the limit inside the database's own query."""
    schema_of(table)
    return typed(first_stored_rows(spark, database, table, n), table)


def first_stored_rows(spark: SparkSession, database: Database, table: str, n: int) -> DataFrame:
    """Any ``n`` rows of any table of the database, as stored."""
    if n < 0:
        raise ValueError(f"cannot read {n} rows")
    return _query(spark, database, f"SELECT * FROM {database.qualified(table)} LIMIT {int(n)}")


def list_tables(spark: SparkSession, database: Database) -> DataFrame:
    """Schema and name of every base table the database shows to this login.

    The database's own catalog tables are left out.
    """
    return _query(
        spark,
        database,
        "SELECT CAST(table_schema AS varchar) AS table_schema,"
        " CAST(table_name AS varchar) AS table_name"
        " FROM information_schema.tables WHERE table_type = 'BASE TABLE'"
        " AND table_schema NOT IN ('pg_catalog', 'information_schema')",
    )


def list_columns(spark: SparkSession, database: Database, table: str) -> DataFrame:
    """Position, name, type, size and nullability of the columns of one table.

    The name is matched exactly, within the database's schema if it has one.
    """
    columns = _query(
        spark,
        database,
        "SELECT CAST(table_schema AS varchar) AS table_schema,"
        " CAST(table_name AS varchar) AS table_name,"
        " CAST(ordinal_position AS integer) AS position,"
        " CAST(column_name AS varchar) AS column_name,"
        " CAST(data_type AS varchar) AS data_type,"
        " CAST(coalesce(character_maximum_length, numeric_precision) AS integer) AS column_size,"
        " CAST(is_nullable AS varchar) AS is_nullable"
        " FROM information_schema.columns",
    ).where(equals_key("table_name", table))
    if database.schema is not None:
        columns = columns.where(equals_key("table_schema", database.schema))
    return columns


def range_split(column: str, lower: int, upper: int, parts: int) -> Split:
    """Equal ranges of a numeric column. Rows outside the bounds or NULL are read too."""
    return Split(
        options={
            "partitionColumn": column,  # Spark quotes it.
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(parts),
        }
    )


def measured_range_split(
    spark: SparkSession, database: Database, table: str, column: str, parts: int
) -> Split:
    """``range_split`` with the smallest and largest value asked from the database."""
    name = quoted(column)
    bounds = _query(
        spark,
        database,
        f"SELECT min({name}) AS lower_bound, max({name}) AS upper_bound"
        f" FROM {database.qualified(table)}",
    ).first()
    if bounds["lower_bound"] is None:
        return Split()
    return range_split(column, bounds["lower_bound"], bounds["upper_bound"], parts)


def hash_split(
    columns: Sequence[str], parts: int, hash_expression: str = "hashtext({key})"
) -> Split:
    """Rows dealt out by a hash of key columns, in any database with ``concat_ws``.

    ``hash_expression`` is the database's integer hash of the text ``{key}``; the
    default is PostgreSQL's. ``concat_ws`` leaves NULLs out, so every row has a
    hash. Name enough columns to tell rows apart: equal keys share a task.
    """
    key = f"concat_ws(',', {', '.join(quoted(column) for column in columns)})"
    hashed = f"({hash_expression.format(key=key)} & 2147483647) % {parts}"
    return Split(predicates=[f"{hashed} = {part}" for part in range(parts)])


def page_split(pages: int, parts: int) -> Split:
    """Ranges of PostgreSQL storage pages; the last one is open so no page is missed."""
    parts = max(1, min(parts, pages))
    starts = [pages * part // parts for part in range(parts)]
    predicates = []
    for part, start in enumerate(starts):
        bounds = [f"ctid >= '({start},0)'::tid"]
        if part + 1 < parts:
            bounds.append(f"ctid < '({starts[part + 1]},0)'::tid")
        predicates.append(" AND ".join(bounds))
    return Split(predicates=predicates)


def measured_page_splits(
    spark: SparkSession, database: Database, parts: int | None = None
) -> dict[str, Split]:
    """``measured_page_split`` of every table."""
    return {t: measured_page_split(spark, database, t, parts) for t in SCHEMAS}


def measured_page_split(
    spark: SparkSession, database: Database, table: str, parts: int | None = None
) -> Split:
    """``page_split`` by the pages that PostgreSQL says a table has.

    Without ``parts`` each task gets ``BYTES_PER_PART``. A partitioned table holds
    no pages itself: each of its leaves is split by its own, in parts in
    proportion to its size. A view has no pages and raises an error.
    """
    name = database.qualified(table).replace("'", "''")
    block = "CAST(current_setting('block_size') AS bigint)"
    # One row for each leaf of the table; a plain table is its own leaf.
    leaves = _query(
        spark,
        database,
        "SELECT CAST(c.relkind AS varchar) AS kind,"
        " CAST(CAST(coalesce(t.relid, c.oid) AS oid) AS bigint) AS leaf,"
        f" pg_relation_size(coalesce(t.relid, c.oid)) / {block} AS pages, {block} AS page_bytes"
        " FROM pg_class c LEFT JOIN LATERAL pg_partition_tree(c.oid) t ON true"
        f" WHERE c.oid = CAST('{name}' AS regclass) AND coalesce(t.isleaf, true)",
    ).collect()
    kinds = {leaf["kind"] for leaf in leaves}
    if kinds - {"r", "p", "m"}:
        raise ValueError(
            f"{database.qualified(table)} is a view or foreign table and has no pages to"
            " split; give read_database_tables a hash_split or range_split for it"
        )
    if len(leaves) == 1 and kinds != {"p"}:
        pages = leaves[0]["pages"]
        return page_split(pages, parts or _parts_of(pages, leaves[0]["page_bytes"]))
    whole = sum(leaf["pages"] for leaf in leaves)
    predicates = []
    for leaf in leaves:
        if parts:
            own = max(1, round(parts * leaf["pages"] / max(1, whole)))
        else:
            own = _parts_of(leaf["pages"], leaf["page_bytes"])
        ranges = page_split(leaf["pages"], own).predicates
        predicates += [f"tableoid = {leaf['leaf']} AND {r}" for r in ranges]
    return Split(predicates=predicates)


def _parts_of(pages: int, page_bytes: int) -> int:
    return max(1, -(-pages * page_bytes // BYTES_PER_PART))


def _query(spark: SparkSession, database: Database, query: str) -> DataFrame:
    options = {**DEFAULT_OPTIONS, **database.options}
    return spark.read.format("jdbc").options(**options, query=query).load()
