"""Counts, friend names and profiles on hand-written tables."""

from __future__ import annotations

import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from acquaint.operators import social
from tests.helpers import day, elite, friend, review, rows, tables, user
from workload import oracle


@pytest.fixture(scope="module")
def t(spark):
    return tables(
        spark,
        user=[
            user(
                "a",
                "Ann",
                average_stars=4.5,
                review_count=40,
                fans=2,
                yelping_since=day("2010-05-06"),
            ),
            user("b", "Bo"),
            user("b", "Abe"),
            user("c"),
            user(None, "No id"),
        ],
        review=[
            review("r2", "a", "x" * 51, stars=2.0, date=day("2012-01-02"), business_id="s1"),
            review("r10", "a", "short", stars=5.0, date=day("2011-01-02"), cool=7),
            review("r3", "b"),
            review("r4", None),
            review("r5", "gone"),
        ],
        elite=[
            elite("a", 2012),
            elite("a", 2010),
            elite("a", 2012),
            elite("c", None),
            elite(None, 2001),
        ],
        friend=[
            friend("a", "b"),
            friend("a", "b"),
            friend("a", "zz"),
            friend("a", None),
            friend("b", "a"),
            friend("gone", "a"),
            friend(None, "a"),
        ],
    )


def test_friend_counts_start_from_users(t):
    assert rows(t.friend_counts()) == {("a", 4): 1, ("b", 1): 1, ("c", 0): 1}


def test_friend_counts_sum_to_links_of_users(t):
    users = t.users().select("user_id").distinct()
    links = t.friends().join(users, "user_id", "left_semi").count()
    assert t.friend_counts().agg(F.sum("friend_count")).first()[0] == links


def test_friend_counts_equal_single_lookups(t):
    for user_id, count in t.friend_counts().where("user_id IS NOT NULL").collect():
        assert t.count_friends(user_id).first()["count"] == count


def test_review_counts(t):
    assert rows(t.review_counts()) == {
        ("a", "Ann", 2): 1,
        ("b", "Abe", 1): 1,
        ("c", None, 0): 1,
    }


def test_friend_names_skip_unknown_and_keep_repeats(t):
    assert rows(t.friend_names()) == {
        ("a", "b", "Abe"): 2,
        ("b", "a", "Ann"): 1,
        ("gone", "a", "Ann"): 1,
        (None, "a", "Ann"): 1,
    }
    assert t.friend_names().columns == ["user_id", "friend_id", "name"]


def test_friend_names_of_one_user(t):
    assert rows(t.friend_names_of("a")) == {("a", "b", "Abe"): 2}
    assert t.friend_names_of("c").count() == 0
    assert t.friend_names_of(None).count() == 0


def test_dangling_friends(t):
    assert rows(t.dangling_friends()) == {("a", "zz"): 1, ("a", None): 1}


def test_named_and_dangling_links_are_all_links(t):
    assert t.friend_names().count() + t.dangling_friends().count() == t.friends().count()


def test_profiles(t):
    assert t.profiles().columns == [
        "user_id",
        "name",
        "reviews_written",
        "first_review_id",
        "first_review_stars",
        "friend_count",
        "elite_years",
        "elite_year_list",
    ]
    assert rows(t.profiles()) == {
        ("a", "Ann", 2, "r10", 5.0, 4, 3, "2010,2012(2)"): 1,
        ("b", "Abe", 1, "r3", 0.0, 1, 0, None): 1,
        ("c", None, 0, None, None, 0, 1, "0"): 1,
    }


def test_profile_of_one_user_is_its_row_of_all_profiles(t):
    for row in t.profiles().collect():
        assert rows(t.profile_of(row["user_id"])) == {tuple(row): 1}
    assert t.profile_of("nobody").count() == 0
    assert t.profile_of(None).count() == 0


def test_profile_details(t):
    row = t.profile_details_of("a").first().asDict()
    assert row == {
        "user_id": "a",
        "name": "Ann",
        "average_stars": 4.5,
        "review_count": 40,
        "fans": 2,
        "yelping_since": day("2010-05-06"),
        "cool": 0,
        "funny": 0,
        "useful": 0,
        "reviews_written": 2,
        "first_review_id": "r10",
        "first_review_business_id": None,
        "first_review_stars": 5.0,
        "first_review_date": day("2011-01-02"),
        "first_review_text": "short",
        "first_review_useful": 0,
        "first_review_funny": 0,
        "first_review_cool": 7,
        "friend_count": 4,
        "elite_years": 3,
        "elite_year_list": "2010,2012(2)",
    }


def test_first_user_profile(t):
    assert rows(t.first_user_profile()) == rows(t.profile_details_of("a"))


def test_repeated_user_ids_give_one_row_from_one_stored_row(spark):
    repeated = tables(
        spark,
        user=[user("a", "Zed", fans=1), user("a", "Amy", fans=9), user("a", "Amy", fans=2)],
        friend=[friend("x", "a")],
    )
    assert rows(social.one_row_per_user(repeated.user, "name", "fans")) == {("a", "Amy", 2): 1}
    assert rows(repeated.friend_names()) == {("x", "a", "Amy"): 1}
    assert rows(repeated.friend_counts()) == {("a", 0): 1}
    assert repeated.profiles().count() == 1


def test_children_do_not_multiply_each_other(spark):
    many = tables(
        spark,
        user=[user("a", "Ann")],
        review=[review(f"r{i}", "a") for i in range(7)],
        friend=[friend("a", f"f{i}") for i in range(11)],
        elite=[elite("a", 2000 + i) for i in range(5)],
    )
    row = many.profiles().first()
    assert (row["reviews_written"], row["friend_count"], row["elite_years"]) == (7, 11, 5)


def test_a_review_without_an_id_comes_last(spark):
    t = tables(
        spark,
        user=[user("a"), user("b")],
        review=[
            review(None, "a", stars=1.0),
            review("r1", "a", stars=5.0),
            review(None, "b", stars=3.0),
            review(None, "b", stars=2.0),
        ],
    )
    found = {
        r["user_id"]: (r["reviews_written"], r["first_review_id"], r["first_review_stars"])
        for r in t.profiles().collect()
    }
    assert found == {"a": (2, "r1", 5.0), "b": (2, None, 2.0)}


def test_profiles_and_counts_agree_with_sql_on_missing_ids(spark):
    """The SQL of the queries, on hand-made tables."""
    t = tables(
        spark,
        user=[user("a", "Ann"), user(None, "No id"), user("b", "Bo")],
        review=[review(None, "a", stars=1.0), review("r1", "a", stars=5.0), review(None, None)],
        friend=[friend("a", "b"), friend(None, "a"), friend("b", None)],
        elite=[elite("a", 2001), elite(None, 2002)],
    )
    connection = duckdb.connect()
    for name, stored in (("review", t.review), ("users", t.user), ("friend", t.friend), ("elite", t.elite)):
        held = stored.toArrow()
        connection.register(f"{name}_arrow", held)
        connection.execute(f"CREATE TABLE {name} AS SELECT * FROM {name}_arrow")
    queries = {
        "user_profiles_all": t.profiles(),
        "friend_counts_all": t.friend_counts(),
        "review_counts_all": t.review_counts(),
        "friend_names_all": t.friend_names(),
        "dangling_friends": t.dangling_friends(),
    }
    derived = (oracle._REVIEW, oracle._ELITE, oracle._FRIEND, oracle._USER)
    for name, found in queries.items():
        sql = oracle.oracle_sql()[name]
        # Without the definitions that derive the tables from the test tables.
        for definition in derived:
            sql = sql.replace(definition + ",", "").replace(definition, "")
        sql = re.sub(r"^WITH\s+SELECT", "SELECT", re.sub(r",\s*SELECT", "\nSELECT", sql))
        assert rows(found) == Counter(connection.execute(sql).fetchall()), name
