"""Command line: copy a PostgreSQL database into Parquet, or show what it holds.

    python -m acquaint extract --to FOLDER [--parts N] [--mode MODE] [--buckets N]
    python -m acquaint overview [--tables FOLDER]
    python -m acquaint columns TABLE
    python -m acquaint row TABLE

The database is named by the environment, see ``Database.from_environment``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame

from acquaint.operators import inspection
from acquaint.plans.extraction import BUCKETS, extract_tables
from acquaint.plans.overview import database_overview, overview
from acquaint.session import recommended_builder
from acquaint.sources import (
    Database,
    measured_page_splits,
    read_database_tables,
    read_parquet_tables,
)
from acquaint.sources.database import first_stored_rows, list_columns


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="acquaint")
    commands = parser.add_subparsers(dest="command", required=True)
    extract = commands.add_parser("extract", help="copy the database tables into Parquet")
    extract.add_argument("--to", required=True, help="folder for the four tables")
    extract.add_argument("--parts", type=int, help="tasks that read each table; default: by size")
    extract.add_argument("--buckets", type=int, default=BUCKETS, help="folders by user")
    extract.add_argument("--mode", default="errorifexists", help="Spark save mode")
    overview_ = commands.add_parser("overview", help="show samples, counts and columns")
    overview_.add_argument("--tables", help="folder written by extract; default: the database")
    for name, about in (("columns", "list the columns of"), ("row", "show a row of")):
        one = commands.add_parser(name, help=f"{about} any table of the database")
        one.add_argument("table")
    chosen = parser.parse_args(arguments)

    spark = recommended_builder().appName("acquaint").getOrCreate()
    if chosen.command == "extract":
        database = Database.from_environment()
        splits = measured_page_splits(spark, database, chosen.parts)
        tables = read_database_tables(spark, database, splits)
        extract_tables(tables, chosen.to, chosen.mode, chosen.buckets)
        return
    if chosen.command == "columns":
        columns = list_columns(spark, Database.from_environment(), chosen.table)
        return show(f"Columns of {chosen.table}", columns.orderBy("table_schema", "position"))
    if chosen.command == "row":
        row = first_stored_rows(spark, Database.from_environment(), chosen.table, 1)
        return show(f"A row of {chosen.table}", inspection.first_row(row))
    if chosen.tables:
        parts = overview(read_parquet_tables(spark, chosen.tables))
    else:
        parts = database_overview(spark, Database.from_environment())
    for title, rows in parts:
        show(title, rows)


def show(title: str, rows: DataFrame) -> None:
    """Print all rows and their number, one partition at a time."""
    print(title)
    print("\t".join(rows.columns))
    total = 0
    for row in rows.toLocalIterator():
        print("\t".join("NULL" if value is None else str(value) for value in row))
        total += 1
    print(f"{total} in total\n")


if __name__ == "__main__":
    main()
