"""The four social-review tables as Spark derives them from the test tables.

Column names and types are those of ``acquaint.schemas``; the values are made
from whole test tables (see FIXTURES.md). Numbers hold NULLs, dates carry a
time part, links repeat and point at unknown users.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acquaint import SocialTables

# Columns used of each test table. Declaring them saves a look into the files.
INPUTS = {
    "customer": "c_custkey bigint, c_name string",
    "supplier": "s_suppkey bigint, s_name string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_partkey bigint",
    "documents": "doc_id bigint, text string",
}

# One column per kind of compliment: NULL for multiples of a number, else the
# remainder. The numbers are 2, 3, 4, ... in this order.
COMPLIMENTS = [
    "cool",
    "cute",
    "funny",
    "hot",
    "list",
    "more",
    "note",
    "photos",
    "plain",
    "profile",
    "writer",
]


def social_tables(spark: SparkSession, sf_dir: str) -> SocialTables:
    def read(table: str) -> DataFrame:
        return spark.read.schema(INPUTS[table]).parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")

    def load(table: str) -> DataFrame:
        if table == "user":
            return users(read("customer"), read("supplier"), load("review"))
        if table == "review":
            return reviews(read("orders"), read("documents"))
        if table == "elite":
            return elites(read("orders"))
        return friends(read("lineitem"), read("orders"))

    return SocialTables(load)


def reviews(orders: DataFrame, documents: DataFrame) -> DataFrame:
    """One review per order, with the text of one of the documents."""
    # Grouping tells Spark that a document id occurs once, so it drops the join
    # from queries that do not read the text.
    texts = documents.groupBy("doc_id").agg(F.min("text").alias("document"))
    document_count = documents.agg(F.count(F.lit(1))).scalar()
    return (
        orders.withColumn("document_key", F.col("o_orderkey") % document_count)
        .join(texts, F.col("document_key") == F.col("doc_id"), "left")
        .selectExpr(
            "concat('b', o_orderkey % 97) AS business_id",
            "CASE WHEN o_orderkey % 11 <> 0 THEN o_orderkey % 3 END AS cool",
            "o_orderdate AS date",
            "o_orderkey % 5 AS funny",
            "concat('r', o_orderkey) AS review_id",
            "CAST(1 + o_orderkey % 5 AS double) AS stars",
            "CASE WHEN o_orderkey % 13 <> 0 THEN document END AS text",
            "o_orderkey % 7 AS useful",
            "concat('u', o_custkey) AS user_id",
            "CAST(o_orderkey % 8 AS int) AS spark_partition",
        )
    )


def elites(orders: DataFrame) -> DataFrame:
    """A user is elite in each year with two orders or more."""
    return (
        orders.selectExpr("o_custkey", "year(o_orderdate) AS year")
        .groupBy("o_custkey", "year")
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n >= 2")
        .selectExpr("concat('u', o_custkey) AS user_id", "year")
    )


def friends(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """The buyer of each line item links to the user numbered like the part."""
    return (
        lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .where("o_custkey <> l_partkey")
        .selectExpr("concat('u', o_custkey) AS user_id", "concat('u', l_partkey) AS friend_id")
    )


def hot_links(friend: DataFrame) -> DataFrame:
    """All links; those to every third friend lead to one user instead."""
    return friend.selectExpr(
        "user_id",
        "CASE WHEN CAST(substring(friend_id, 2) AS bigint) % 3 = 0 THEN 'u7'"
        " ELSE friend_id END AS friend_id",
    )


def users(customer: DataFrame, supplier: DataFrame, review: DataFrame) -> DataFrame:
    """Customers, who write reviews, and suppliers, who do not and have no links."""
    people = customer.selectExpr(
        "c_custkey AS n", "concat('u', c_custkey) AS user_id", "c_name AS name"
    ).unionByName(
        supplier.selectExpr("s_suppkey AS n", "concat('s', s_suppkey) AS user_id", "s_name AS name")
    )
    activity = review.groupBy("user_id").agg(
        F.avg("stars").alias("stars"),
        F.sum("cool").alias("cool"),
        F.sum("funny").alias("funny"),
        F.sum("useful").alias("useful"),
        F.count(F.lit(1)).alias("review_count"),
        F.min("date").alias("first_date"),
    )
    return people.join(activity, "user_id", "left").selectExpr(
        "CASE WHEN n % 19 <> 0 THEN stars END AS average_stars",
        *[
            f"CASE WHEN n % {k} <> 0 THEN n % {k} END AS compliment_{kind}"
            for k, kind in enumerate(COMPLIMENTS, start=2)
        ],
        "cool",
        "n % 23 AS fans",
        "funny",
        "name",
        "review_count",
        "useful",
        "user_id",
        "CASE WHEN n % 17 <> 0 THEN first_date END AS yelping_since",
    )
