"""Extraction into Parquet: same answers from the written tables, pruned reads."""

from __future__ import annotations

import re
from pathlib import Path

import duckdb
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from acquaint.__main__ import main, show
from acquaint.functions.buckets import bucket_column, bucket_of
from acquaint.plans.extraction import BUCKETS, extract_table, extract_tables
from acquaint.schemas import SCHEMAS
from acquaint.sources import read_parquet_tables
from tests.helpers import day, elite, friend, review, rows, tables, user
from tests.plans import plan_of
from workload.registry import on_tables, queries
from workload.standins import social_tables

# These show types of the stored dates, which extraction changes by design.
SHOW_STORED_DATES = {"profile_columns", "first_row", "first_row_user"}


@pytest.fixture(scope="module")
def source(spark, small_sf_dir):
    return social_tables(spark, small_sf_dir)


@pytest.fixture(scope="module")
def extracted(spark, source, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("extracted") / "tables")
    extract_tables(source, root)
    return root


@pytest.mark.parametrize("name", sorted(set(queries()) - SHOW_STORED_DATES))
def test_same_answer_from_written_tables(spark, source, extracted, name):
    written = read_parquet_tables(spark, extracted)
    assert rows(on_tables(name, written)) == rows(on_tables(name, source))


def test_null_counts_survive(spark, source, extracted):
    def null_counts(t):
        return rows(t.column_profiles().select("table_name", "column_name", "null_count"))

    written = read_parquet_tables(spark, extracted)
    stored_names = {(t, c) for t, c, _ in null_counts(source)}
    assert {k: v for k, v in null_counts(written).items() if k[:2] in stored_names} == dict(
        null_counts(source)
    )


def test_written_types(spark, extracted):
    for table, schema in SCHEMAS.items():
        read = spark.read.parquet(f"{extracted}/{table}")
        types = dict(read.dtypes)
        for field in schema.fields:
            assert types[field.name] == field.dataType.simpleString()


def test_ids_carry_bloom_filters(extracted):
    # Parquet leaves the filter out where a dictionary already lists the values.
    filters = duckdb.sql(
        "SELECT count(*), count(bloom_filter_offset)"
        f" FROM parquet_metadata('{extracted}/review/*/*.parquet')"
        " WHERE path_in_schema = 'review_id'"
    ).fetchall()[0]
    assert filters[0] == filters[1] > 0


def test_year_reads_only_its_folder(spark, extracted):
    written = read_parquet_tables(spark, extracted)
    plan = plan_of(written.elites_in(1998))
    assert "PartitionFilters: [isnotnull(year" in plan
    assert len(written.elites_in(1998).inputFiles()) <= len(written.elites().inputFiles())
    assert any("year=1998" in f for f in written.elites().inputFiles())


def test_nulls_repeats_and_missing_years(spark, tmp_path):
    t = tables(
        spark,
        user=[user("a", "Ann"), user(None)],
        review=[review("r1", "a", date=day("2010-01-01")), review("r2", None), review("r2", None)],
        elite=[elite("a", 2001), elite("a", None), elite("a", None)],
        friend=[friend("a", None), friend("a", "b"), friend("a", "b")],
    )
    root = str(tmp_path / "out")
    extract_tables(t, root)
    written = read_parquet_tables(spark, root)
    for name in ("users", "reviews", "elites", "friends"):
        assert rows(getattr(written, name)()) == rows(getattr(t, name)())
    assert written.elites_in(0).count() == 0


def test_existing_tables_are_not_overwritten_unasked(spark, tmp_path):
    root = str(tmp_path / "out")
    t = tables(spark, elite=[elite("a", 2001)])
    extract_table(t.elite, "elite", root)
    with pytest.raises(AnalysisException):
        extract_table(t.elite, "elite", root)
    more = tables(spark, elite=[elite("b", 2002)])
    extract_table(more.elite, "elite", root, mode="overwrite")
    assert rows(read_parquet_tables(spark, root).elites()) == {("b", 2002): 1}


def test_one_large_year_is_written_as_several_files(spark, tmp_path):
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        many = spark.range(0, 60_000, 1, 8).selectExpr(
            "concat('u', id % 997) AS user_id",
            "CASE WHEN id % 10 < 9 THEN 2001 ELSE 2002 END AS year",
        )
        extract_table(many, "elite", str(tmp_path))
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert len(list(Path(tmp_path, "elite", "year=2001").glob("*.parquet"))) > 1
    assert spark.read.parquet(f"{tmp_path}/elite").count() == 60_000


def test_a_user_lies_in_few_files(spark, extracted):
    for table in ("user", "review", "friend"):
        files = list(Path(extracted, table).glob("*/*.parquet"))
        stored = spark.read.parquet(f"{extracted}/{table}")
        mine = stored.where("user_id = 'u7'").select(F.input_file_name()).distinct().count()
        bucket = bucket_of(F.lit("u7"), BUCKETS)
        folder = spark.range(1).select(bucket).first()[0]
        held = list(Path(extracted, table, f"{bucket_column(BUCKETS)}={folder}").glob("*.parquet"))
        assert mine <= len(held) <= max(1, len(files) // 16)


@pytest.mark.parametrize(
    "read",
    [
        lambda t: t.reviews_of("u7"),
        lambda t: t.user_by_id("u7"),
        lambda t: t.friends_of("u7"),
        lambda t: t.count_friends("u7"),
        lambda t: t.profile_of("u7"),
        lambda t: t.profile_details_of("u7"),
        lambda t: t.first_user_profile(),
    ],
)
def test_lookups_choose_folders(spark, extracted, read):
    plan = plan_of(read(read_parquet_tables(spark, extracted)))
    scans = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan)
    assert scans and any(bucket_column(BUCKETS) in filters for filters in scans)
    unread = [f for f in scans if bucket_column(BUCKETS) not in f]
    assert len(unread) <= plan.count("/elite]") + plan.count("min(user_id")


def test_null_keys_are_kept_with_any_number_of_buckets(spark, tmp_path):
    t = tables(spark, friend=[friend(None, "a"), friend("a", None), friend(None, None)])
    for buckets in (1, 7):
        extract_table(t.friend, "friend", f"{tmp_path}/{buckets}", buckets=buckets)
        written = read_parquet_tables(spark, f"{tmp_path}/{buckets}")
        assert rows(written.friends()) == rows(t.friends())
        assert rows(written.friends_of("a")) == rows(t.friends_of("a"))
        assert written.friends_of(None).count() == 0


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_a_hot_user_is_cut_into_several_files(spark, tmp_path, adaptive):
    settings = {
        "spark.sql.adaptive.enabled": adaptive,
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        many = spark.range(0, 60_000, 1, 8).selectExpr(
            "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('u', id % 997) END AS user_id",
            "concat('u', id) AS friend_id",
        )
        extract_table(many, "friend", str(tmp_path), buckets=4)
    finally:
        for key in settings:
            spark.conf.unset(key)
    found = spark.read.parquet(f"{tmp_path}/friend")
    assert found.count() == 60_000
    assert found.where("user_id = 'hot'").select(F.input_file_name()).distinct().count() > 1


def test_overview_command_reads_written_tables(spark, extracted, capsys):
    main(["overview", "--tables", extracted])
    shown = capsys.readouterr().out
    assert "First 5 users" in shown and "Columns of friend" in shown


def test_long_lists_are_shown_whole(spark, capsys):
    names = spark.range(150).selectExpr("concat('t', id, '-', repeat('x', 300)) AS table_name")
    show("Tables", names)
    shown = capsys.readouterr().out.splitlines()
    assert shown[0] == "Tables" and shown[-2] == "150 in total"
    assert {line for line in shown if line.startswith("t") and line != "table_name"} == {
        f"t{i}-{'x' * 300}" for i in range(150)
    }
