"""What the plans must show: pushed filters, pruned columns, no pairing of all rows."""

from __future__ import annotations

import re

import pytest

from acquaint.plans.extraction import extract_tables
from acquaint.sources import read_parquet_tables
from tests.plans import plan_of
from workload.registry import on_tables, queries
from workload.standins import social_tables


@pytest.fixture(scope="module")
def stored(spark, small_sf_dir, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("plans") / "tables")
    extract_tables(social_tables(spark, small_sf_dir), root)
    return read_parquet_tables(spark, root)


@pytest.fixture(autouse=True)
def whole_plan_text(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


@pytest.mark.parametrize("name", list(queries()))
def test_no_cross_product_and_no_python(stored, name):
    plan = plan_of(on_tables(name, stored))
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert unwanted not in plan


@pytest.mark.parametrize(
    "name, column, key",
    [
        ("user_by_id", "user_id", "u7"),
        ("review_by_id", "review_id", "r7"),
        ("reviews_by_user", "user_id", "u7"),
        ("elites_by_user", "user_id", "u7"),
        ("friends_by_user", "user_id", "u7"),
        ("count_friends", "user_id", "u7"),
        ("user_review_count", "user_id", "u7"),
        ("user_profile", "user_id", "u7"),
        ("user_profile_details", "user_id", "u7"),
    ],
)
def test_key_reaches_every_scan(stored, name, column, key):
    scans = re.findall(r"PushedFilters: \[([^\]]*)\]", plan_of(on_tables(name, stored)))
    assert scans
    for pushed in scans:
        assert f"EqualTo({column},{key})" in pushed


def read_columns(plan: str) -> list[set[str]]:
    return [
        {column.split(":")[0] for column in schema.split(",") if column}
        for schema in re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    ]


def test_counts_read_only_what_they_count(stored):
    assert read_columns(plan_of(on_tables("friend_counts_all", stored))) == [
        {"user_id"},
        {"user_id"},
    ]


def test_profiles_read_no_text(stored):
    columns = read_columns(plan_of(on_tables("user_profiles_all", stored)))
    assert columns == [
        {"name", "user_id"},
        {"review_id", "stars", "user_id"},
        {"user_id"},
        {"user_id"},
    ]


def test_profile_joins_reuse_the_grouping_shuffles(spark, stored):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(on_tables("user_profiles_all", stored))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("SortMergeJoin") == 3
    # One shuffle per table, and one more that counts repeated elite rows.
    assert plan.count("Exchange hashpartitioning") == 5


def test_ordered_first_rows_do_not_sort_the_table(stored):
    for name in ("limit_users", "limit_reviews", "limit_elites", "limit_friends"):
        plan = plan_of(on_tables(name, stored))
        assert "TakeOrderedAndProject" in plan and "Exchange" not in plan


def test_text_lookup_is_not_joined_in_when_unread(spark, small_sf_dir):
    derived = social_tables(spark, small_sf_dir)
    assert "documents" not in plan_of(on_tables("user_profiles_all", derived))
    assert "documents" in plan_of(on_tables("review_summary", derived))
