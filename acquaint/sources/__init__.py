from acquaint.sources.database import (
    Database,
    hash_split,
    measured_page_split,
    measured_page_splits,
    measured_range_split,
    page_split,
    range_split,
    read_catalog_tables,
    read_database_tables,
    register_catalog,
)
from acquaint.sources.files import read_parquet_tables

__all__ = [
    "Database",
    "hash_split",
    "measured_page_split",
    "measured_page_splits",
    "measured_range_split",
    "page_split",
    "range_split",
    "read_catalog_tables",
    "read_database_tables",
    "read_parquet_tables",
    "register_catalog",
]
