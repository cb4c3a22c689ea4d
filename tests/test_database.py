"""Database source without a database: what is asked of Spark's JDBC reader, and
that the filters cut every row into exactly one task."""

from __future__ import annotations

import re
from types import SimpleNamespace

import duckdb
import pytest

from acquaint.plans.overview import database_overview
from acquaint.sources import database as db
from tests.helpers import elite, friend, review, tables, user


class Reader:
    """Records what a JDBC read asks for and hands back a prepared frame."""

    def __init__(self, frame=None):
        self.frame, self.calls = frame, []

    def format(self, name):
        assert name == "jdbc"
        return self

    def options(self, **options):
        self.calls.append(options)
        return self

    def jdbc(self, **arguments):
        self.calls.append(arguments)
        return self.frame

    def load(self):
        return self.frame


def session(frame=None):
    return SimpleNamespace(read=Reader(frame))


HOME = db.Database({"url": "jdbc:postgresql://host/base", "user": "me"}, "social")


def test_options_come_from_the_environment():
    made = db.Database.from_environment(
        {
            "ACQUAINT_JDBC_URL": "jdbc:x",
            "ACQUAINT_JDBC_USER": "me",
            "ACQUAINT_JDBC_PASSWORD": "secret",
            "ACQUAINT_JDBC_SCHEMA": "social",
            "OTHER": "no",
        }
    )
    assert made == db.Database({"url": "jdbc:x", "user": "me", "password": "secret"}, "social")


def test_missing_url_raises():
    with pytest.raises(ValueError, match="ACQUAINT_JDBC_URL"):
        db.Database.from_environment({"ACQUAINT_JDBC_USER": "me"})


def test_names_are_quoted():
    assert db.qualified_name("user", "social") == '"social"."user"'
    assert db.qualified_name("user") == '"user"'
    assert db.quoted('a"; DROP TABLE b') == '"a""; DROP TABLE b"'


def test_plain_read():
    spark = session("frame")
    assert db.read_table(spark, HOME, "user") == "frame"
    assert spark.read.calls == [
        {
            "fetchsize": "10000",
            "preferTimestampNTZ": "true",
            "url": "jdbc:postgresql://host/base",
            "user": "me",
            "dbtable": '"social"."user"',
        }
    ]


def test_own_options_win():
    spark = session()
    db.read_table(spark, db.Database({"url": "u", "fetchsize": "7"}), "user")
    assert spark.read.calls[0]["fetchsize"] == "7"


def test_read_by_range():
    spark = session()
    db.read_table(spark, HOME, "review", db.range_split("spark_partition", 0, 64, 16))
    asked = spark.read.calls[0]
    assert asked["partitionColumn"] == "spark_partition"
    assert (asked["lowerBound"], asked["upperBound"], asked["numPartitions"]) == ("0", "64", "16")


def test_read_by_predicates():
    spark = session("frame")
    split = db.hash_split(["user_id"], 4)
    assert db.read_table(spark, HOME, "user", split) == "frame"
    asked = spark.read.calls[0]
    assert asked["url"] == "jdbc:postgresql://host/base"
    assert asked["table"] == '"social"."user"'
    assert asked["predicates"] == list(split.predicates)
    assert asked["properties"]["user"] == "me" and "url" not in asked["properties"]


def test_tables_are_opened_when_used():
    spark = session("frame")
    opened = db.read_database_tables(spark, HOME, {"elite": db.range_split("year", 2004, 2020, 4)})
    assert spark.read.calls == []
    assert opened.elite == "frame" and opened.elite == "frame"
    assert len(spark.read.calls) == 1 and "partitionColumn" in spark.read.calls[0]


def test_limit_is_part_of_the_query(spark):
    stored = spark.sql("SELECT 'a' AS user_id, CAST(NULL AS int) AS year")
    fake = session(stored)
    assert [tuple(r) for r in db.first_rows(fake, HOME, "elite", 5).collect()] == [("a", 0)]
    assert fake.read.calls[0]["query"] == 'SELECT * FROM "social"."elite" LIMIT 5'


def test_catalog_options(spark):
    db.register_catalog(spark, "far", HOME)
    try:
        assert spark.conf.get("spark.sql.catalog.far").endswith(".JDBCTableCatalog")
        assert spark.conf.get("spark.sql.catalog.far.url") == "jdbc:postgresql://host/base"
        assert spark.conf.get("spark.sql.catalog.far.user") == "me"
    finally:
        for option in ("", ".url", ".user", ".fetchsize", ".preferTimestampNTZ"):
            spark.conf.unset(f"spark.sql.catalog.far{option}")


def test_catalog_names_are_quoted():
    asked = []
    fake = SimpleNamespace(table=asked.append)
    assert db.read_catalog_tables(fake, "far", "so`cial").user is None
    assert asked == ["`far`.`so``cial`.`user`"]


def test_tables_of_a_catalog(spark):
    stored = tables(spark, user=[user("a", "Ann")], friend=[friend("a", "b")])
    stored.create_views()
    found = db.read_catalog_tables(spark)
    assert found.user_by_id("a").first()["name"] == "Ann"
    assert found.count_friends("a").first()["count"] == 1


class Base:
    """Answers queries from prepared tables, as the database would."""

    def __init__(self, stored, spark):
        self.stored, self.spark, self.asked = stored, spark, []
        self.read = self

    def format(self, name):
        return self

    def options(self, **options):
        self.asked.append(options)
        return self

    def load(self):
        options = self.asked[-1]
        if "information_schema.tables" in options.get("query", ""):
            return self.spark.sql("SELECT 'social' AS table_schema, 'user' AS table_name")
        if "information_schema.columns" in options.get("query", ""):
            return self.spark.sql(
                "SELECT 'social' AS table_schema, 'user' AS table_name, 1 AS position,"
                " 'user_id' AS column_name, 'text' AS data_type, 9 AS column_size,"
                " 'YES' AS is_nullable"
            )
        wanted = options.get("query", options.get("dbtable"))
        table = re.search(r'"social"\."(\w+)"', wanted).group(1)
        limit = re.search(r"LIMIT (\d+)", wanted)
        frame = self.stored.stored(table)
        return frame.limit(int(limit.group(1))) if limit else frame


def test_overview_of_a_database(spark):
    stored = tables(
        spark,
        user=[user("a", "Ann")],
        review=[review("r1", "a", "hello")],
        friend=[friend("a", "b")],
        elite=[elite("a", 2001)],
    )
    base = Base(stored, spark)
    shown = {title: frame.collect() for title, frame in database_overview(base, HOME)}
    assert shown["Tables"][0]["table_name"] == "user"
    assert shown["Columns of user"][0]["column_name"] == "user_id"
    assert shown["Columns of elite"] == []
    assert shown["Profile of the first user"][0]["first_review_text"] == "hello"
    assert [r["value"] for r in shown["A row of elite"]] == ["a", "2001"]
    # Whole tables are named only where the profile's key filter follows.
    assert sum("dbtable" in asked for asked in base.asked) == 4


def test_overview_of_an_empty_database(spark):
    shown = dict(database_overview(Base(tables(spark), spark), HOME))
    assert "Profile of the first user" not in shown
    assert shown["A row of user"].count() == 0


def test_bad_first_rows_raise():
    with pytest.raises(ValueError):
        db.first_rows(session(), HOME, "elite", -1)
    with pytest.raises(ValueError, match="unknown table"):
        db.first_rows(session(), HOME, 'elite" WHERE 1=1 --', 1)


def test_measured_range(spark):
    fake = session(spark.sql("SELECT 3 AS lower_bound, 90 AS upper_bound"))
    split = db.measured_range_split(fake, HOME, "review", "spark_partition", 8)
    assert split == db.range_split("spark_partition", 3, 90, 8)
    assert fake.read.calls[0]["query"].startswith('SELECT min("spark_partition")')
    empty = session(spark.sql("SELECT CAST(NULL AS int) AS lower_bound, 1 AS upper_bound"))
    assert db.measured_range_split(empty, HOME, "review", "spark_partition", 8) == db.Split()


LEAVES = "kind string, leaf long, pages long, page_bytes long"


def measured(spark, leaves, parts=None):
    fake = session(spark.createDataFrame(leaves, LEAVES))
    return db.measured_page_split(fake, HOME, "review", parts), fake.read.calls


def test_measured_pages(spark):
    fake = session(spark.createDataFrame([("r", 1, 10, 8192)], LEAVES))
    splits = db.measured_page_splits(fake, HOME, 4)
    assert set(splits) == {"user", "review", "elite", "friend"}
    assert splits["user"] == db.page_split(10, 4)
    query = fake.read.calls[0]["query"]
    assert "pg_partition_tree" in query and "CAST('\"social\".\"user\"' AS regclass)" in query


@pytest.mark.parametrize("pages, parts", [(0, 1), (1, 1), (16384, 1), (16385, 2), (10**6, 62)])
def test_number_of_parts_follows_the_size(spark, pages, parts):
    assert measured(spark, [("r", 1, pages, 8192)])[0] == db.page_split(pages, parts)


def test_a_hundred_terabytes(spark):
    split, _ = measured(spark, [("p", leaf, 2**27, 8192) for leaf in range(100)])
    assert len(split.predicates) == 100 * 8192


def test_leaves_are_split_by_their_own_pages(spark):
    split, _ = measured(spark, [("p", 7, 40_000, 8192), ("p", 9, 0, 8192)])
    assert [p for p in split.predicates if p.startswith("tableoid = 9 ")] == [
        "tableoid = 9 AND ctid >= '(0,0)'::tid"
    ]
    assert sum(p.startswith("tableoid = 7 AND ") for p in split.predicates) == 3
    split, _ = measured(spark, [("p", 7, 30, 8192), ("p", 9, 10, 8192)], parts=4)
    assert [p.split()[2] for p in split.predicates] == ["7", "7", "7", "9"]


def test_views_cannot_be_split_by_pages(spark):
    with pytest.raises(ValueError, match="hash_split"):
        measured(spark, [("v", 1, 0, 8192)])


def test_whole_tables_measure_their_splits(spark):
    fake = session(spark.createDataFrame([("r", 1, 40_000, 8192)], LEAVES))
    opened = db.read_database_tables(fake, HOME)
    assert fake.read.calls == []
    assert opened.user is fake.read.frame
    assert len(fake.read.calls[1]["predicates"]) == 3
    in_one = db.read_database_tables(fake, HOME, {"elite": db.Split()})
    assert in_one.elite is fake.read.frame and fake.read.calls[-1]["dbtable"] == '"social"."elite"'


def test_list_columns_matches_the_exact_name(spark):
    stored = spark.createDataFrame(
        [
            ("social", "user", 1, "average_stars", "double precision", 53, "YES"),
            ("other", "user", 1, "id", "text", None, "NO"),
            ("social", "user_", 1, "x", "text", None, "YES"),
        ],
        "table_schema string, table_name string, position int, column_name string,"
        " data_type string, column_size int, is_nullable string",
    )
    found = db.list_columns(session(stored), HOME, "user").collect()
    assert [r["column_name"] for r in found] == ["average_stars"]
    anywhere = db.Database({"url": "u"})
    assert db.list_columns(session(stored), anywhere, "user").count() == 2
    assert db.list_columns(session(stored), anywhere, "us%").count() == 0


def test_list_tables_asks_for_base_tables():
    spark = session("frame")
    assert db.list_tables(spark, HOME) == "frame"
    query = spark.read.calls[0]["query"]
    assert "table_type = 'BASE TABLE'" in query
    assert "NOT IN ('pg_catalog', 'information_schema')" in query
    assert "varchar(" not in query


@pytest.mark.parametrize("columns", [["user_id"], ["user_id", "friend_id"]])
@pytest.mark.parametrize("parts", [1, 3, 16])
def test_hash_split_gives_every_row_one_task(columns, parts):
    connection = duckdb.connect()
    connection.execute(
        "CREATE TABLE friend AS SELECT"
        " CASE WHEN i % 10 = 0 THEN NULL ELSE 'u' || CAST(i AS VARCHAR) END AS user_id,"
        " CASE WHEN i % 7 = 0 THEN NULL ELSE 'f' || CAST(i % 50 AS VARCHAR) END AS friend_id"
        " FROM range(2000) t(i)"
    )
    split = db.hash_split(columns, parts, "CAST(hash({key}) % 2147483648 AS BIGINT)")
    assert len(split.predicates) == parts
    counted = [
        connection.execute(f"SELECT count(*) FROM friend WHERE {p}").fetchone()[0]
        for p in split.predicates
    ]
    assert sum(counted) == 2000
    assert all(counted)


@pytest.mark.parametrize("pages, parts", [(0, 4), (1, 4), (10, 4), (1000, 64), (7, 7), (64, 1)])
def test_page_split_covers_every_page_once(pages, parts):
    predicates = db.page_split(pages, parts).predicates
    assert 1 <= len(predicates) <= parts
    bounds = [[int(n) for n in re.findall(r"\((\d+),0\)", p)] for p in predicates]
    assert bounds[0][0] == 0
    # Each part ends where the next begins; the last has no end.
    assert [b[1] for b in bounds[:-1]] == [b[0] for b in bounds[1:]]
    assert len(bounds[-1]) == 1
    sizes = [b[1] - b[0] for b in bounds[:-1]] + [pages - bounds[-1][0]]
    assert max(sizes) - min(sizes) <= 1
