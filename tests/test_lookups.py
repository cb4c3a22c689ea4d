"""Scans, first rows, lookups and counts on hand-written tables."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

from acquaint import SocialTables
from acquaint.functions import typed
from acquaint.operators import lookups
from acquaint.schemas import SCHEMAS
from tests.helpers import elite, friend, review, rows, tables, user
from tests.plans import plan_of
from workload.standins import reviews


@pytest.fixture(scope="module")
def t(spark):
    return tables(
        spark,
        user=[user("a", "Ann", fans=3), user("b"), user("b", "Bo"), user(None, "No id")],
        review=[
            review("r1", "a", "one", stars=4.0),
            review("r2", "a"),
            review("r2", "b", "again"),
            review(None, "b"),
            review("r5", "o'hara"),
        ],
        elite=[elite("a", 2001), elite("a", 1999), elite("b", None), elite("b", 2001)],
        friend=[friend("a", "b"), friend("a", "b"), friend("a", "zz"), friend("b", None)],
    )


@pytest.mark.parametrize("table", list(SCHEMAS))
def test_typed_columns_and_types(spark, t, table):
    schema = typed(t.stored(table), table).schema
    assert [(f.name, f.dataType) for f in schema] == [
        (f.name, f.dataType) for f in SCHEMAS[table]
    ]


def test_null_numbers_read_as_zero(t):
    row = t.user_by_id("a").first()
    assert row["fans"] == 3
    assert (row["cool"], row["average_stars"], row["compliment_writer"]) == (0, 0.0, 0)
    assert rows(t.elites_of("b")) == {("b", 0): 1, ("b", 2001): 1}


def test_null_text_and_dates_stay_null(t):
    row = t.review_by_id("r5").first()
    assert row["text"] is None and row["date"] is None
    assert row["stars"] == 0.0 and row["spark_partition"] == 0


def test_time_part_of_a_date_is_dropped(spark):
    stored = spark.sql(
        "SELECT 'u' AS user_id, 1 AS year, TIMESTAMP_NTZ '2020-02-03 23:59:59' AS yelping_since"
    )
    all_columns = stored.selectExpr(
        *[
            "yelping_since" if f.name == "yelping_since" else f"NULL AS {f.name}"
            for f in SCHEMAS["user"]
        ]
    )
    assert typed(all_columns, "user").first()["yelping_since"] == dt.date(2020, 2, 3)


def test_numbers_stored_as_other_types_are_cast(spark):
    stored = spark.sql("SELECT 'u' AS user_id, CAST(1999 AS decimal(10,0)) AS year")
    assert rows(typed(stored, "elite")) == {("u", 1999): 1}


def test_malformed_number_raises(spark):
    stored = spark.sql("SELECT 'u' AS user_id, 'soon' AS year")
    with pytest.raises(PySparkException):
        typed(stored, "elite").collect()


def test_typing_twice_changes_nothing(t):
    once = typed(t.review, "review")
    assert rows(typed(once, "review")) == rows(once)


def test_missing_column_raises(spark):
    with pytest.raises(AnalysisException):
        typed(spark.sql("SELECT 'u' AS user_id"), "elite")


def test_unknown_table_raises(t):
    with pytest.raises(ValueError, match="unknown table"):
        t.stored("Users")


@pytest.mark.parametrize("n, expected", [(0, 0), (1, 1), (3, 3), (10, 4)])
def test_first_rows(t, n, expected):
    assert t.first_elites(n).count() == expected
    assert len(t.first_elites(n, "user_id", "year").collect()) == expected


def test_first_rows_in_order(t):
    assert [tuple(r) for r in t.first_elites(2, "user_id", "year").collect()] == [
        ("a", 1999),
        ("a", 2001),
    ]


def test_negative_number_of_rows_raises(t):
    with pytest.raises(AnalysisException):
        t.first_users(-1).collect()


def test_lookup_by_id(t):
    assert t.user_by_id("a").first()["name"] == "Ann"
    assert t.user_by_id("b").count() == 1
    assert t.review_by_id("r2").count() == 1
    assert t.user_by_id("unknown").count() == 0
    assert t.review_by_id("unknown").count() == 0


def test_lookup_by_id_in_order_is_definite(t):
    row = lookups.one_by_key(t.review, "review", "review_id", "r2", "user_id").first()
    assert row["user_id"] == "a"


def test_lookup_of_many_rows(t):
    assert t.reviews_of("a").count() == 2
    assert t.friends_of("a").count() == 3
    assert rows(t.elites_in(2001)) == {("a", 2001): 1, ("b", 2001): 1}
    assert t.elites_in(1990).count() == 0


def test_null_key_matches_nothing(t):
    assert t.user_by_id(None).count() == 0
    assert t.review_by_id(None).count() == 0
    assert t.reviews_of(None).count() == 0
    assert t.elites_in(None).count() == 0
    assert rows(t.count_friends(None)) == {(0,): 1}


def test_stored_null_does_not_match_zero(t):
    assert t.elites_of("b").where("year = 0").count() == 1
    assert t.elites_in(0).count() == 0


def test_quotes_in_a_key_are_data(t):
    assert t.reviews_of("o'hara").count() == 1
    assert t.reviews_of("x' OR '1'='1").count() == 0


def test_count_friends(t):
    assert rows(t.count_friends("a")) == {(3,): 1}
    assert rows(t.count_friends("nobody")) == {(0,): 1}
    assert t.count_friends("a").columns == ["count"]


def test_lookup_of_a_key_table(spark, t):
    keys = spark.createDataFrame([("a",), ("a",), (None,), ("nobody",)], "k string")
    assert rows(t.reviews_of_all(keys)) == rows(t.reviews_of("a"))
    assert t.reviews_of_all(keys).columns == t.reviews().columns
    assert rows(t.elites_of_all(keys)) == rows(t.elites_of("a"))
    assert rows(t.friends_of_all(keys)) == rows(t.friends_of("a"))


def test_lookup_of_keys_from_the_table_itself(t):
    own = t.review.where("user_id = 'a'").select("user_id")
    assert rows(t.reviews_of_all(own)) == rows(t.reviews_of("a"))
    everyone = t.reviews().select("user_id")
    assert rows(t.reviews_of_all(everyone)) == rows(t.reviews())


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_keys_of_another_type_compare_as_in_a_join(spark, ansi):
    t = tables(spark, review=[review("r1", "1"), review("r2", "01"), review("r3", "2")])
    keys = spark.createDataFrame([(1,), (1,), (None,)], "k bigint")
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        found = sorted(r["review_id"] for r in t.reviews_of_all(keys).collect())
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert found == ["r1", "r2"]


def test_reviews_without_a_key_do_not_meet_the_texts(spark):
    """Keys are looked up in the orders, before reviews are as long as their texts."""
    orders = spark.createDataFrame(
        [(0, 1), (1, 1), (2, 2), (2, 2), (3, 3), (4, None), (None, 1), (14, 2)],
        "o_orderkey bigint, o_custkey bigint",
    ).withColumn("o_orderdate", F.lit("2020-02-03").cast("timestamp_ntz"))
    documents = spark.createDataFrame(
        [(0, "zero"), (1, "b"), (1, "a"), (2, "two"), (None, "none"), (9, "unused")],
        "doc_id bigint, text string",
    )
    t = SocialTables(lambda table: reviews(orders, documents))
    keys = spark.createDataFrame([("u1",), ("u2",), ("u2",), (None,), ("u9",)], "k string")
    found = t.reviews_of_all(keys)
    assert rows(found.select("review_id", "user_id", "text")) == {
        ("r0", "u1", None): 1,
        ("r1", "u1", "a"): 1,
        ("r2", "u2", "two"): 2,
        (None, "u1", None): 1,
        ("r14", "u2", "two"): 1,
    }
    plan = plan_of(t.reviews_of_all(keys))
    assert plan.count("LeftOuter") == plan.count("LeftSemi") == 1
    assert plan.index("LeftOuter") < plan.index("LeftSemi")


def test_key_table_gives_one_row_per_user(spark, t):
    keys = spark.createDataFrame([("a",), ("b",), ("b",), (None,), ("zz",)], "k string")
    found = t.users_by_ids(keys)
    assert found.columns == t.users().columns
    assert sorted(r["user_id"] for r in found.collect()) == ["a", "b"]


def test_empty_tables(spark):
    empty = tables(spark)
    assert empty.users().count() == 0
    assert empty.first_reviews(5).count() == 0
    assert rows(empty.count_friends("a")) == {(0,): 1}
    assert empty.friend_counts().count() == 0
    assert empty.friend_names().count() == 0
    assert empty.profiles().count() == 0
    assert empty.first_user_profile().count() == 0


# The statements callers send, in plain SQL with bound values.
STATEMENTS = {
    "SELECT * FROM t_user": ({}, lambda t: t.user),
    "SELECT * FROM t_user WHERE user_id = :key": (
        {"key": "a"},
        lambda t: t.user.where("user_id = 'a'"),
    ),
    "SELECT * FROM t_user ORDER BY user_id LIMIT :n": (
        {"n": 2},
        lambda t: t.user.orderBy("user_id").limit(2),
    ),
    "SELECT * FROM t_review": ({}, lambda t: t.review),
    "SELECT * FROM t_review WHERE review_id = :key": (
        {"key": "r1"},
        lambda t: t.review.where("review_id = 'r1'"),
    ),
    "SELECT * FROM t_review WHERE user_id = :key": (
        {"key": "o'hara"},
        lambda t: t.review.where(F.col("user_id") == "o'hara"),
    ),
    "SELECT * FROM t_elite WHERE user_id = :key": (
        {"key": "a"},
        lambda t: t.elite.where("user_id = 'a'"),
    ),
    "SELECT * FROM t_elite WHERE year = :year": (
        {"year": 2001},
        lambda t: t.elite.where("year = 2001"),
    ),
    "SELECT * FROM t_friend WHERE user_id = :key": (
        {"key": "a"},
        lambda t: t.friend.where("user_id = 'a'"),
    ),
    "SELECT COUNT(*) AS count FROM t_friend WHERE user_id = :key": (
        {"key": "a"},
        lambda t: t.count_friends("a"),
    ),
    "SELECT * FROM IDENTIFIER(:t) ORDER BY user_id, year LIMIT 1": (
        {"t": "t_elite"},
        lambda t: t.elite.orderBy("user_id", "year").limit(1),
    ),
}


@pytest.mark.parametrize("statement", list(STATEMENTS))
def test_statements_run_on_views(spark, t, statement):
    t.create_views("t_")
    values, expected = STATEMENTS[statement]
    assert rows(spark.sql(statement, args=values)) == rows(expected(t))


def test_injected_text_in_a_bound_value_is_data(spark, t):
    t.create_views("t_")
    found = spark.sql("SELECT * FROM t_user WHERE user_id = :k", args={"k": "a' OR 'a' = 'a"})
    assert found.count() == 0
