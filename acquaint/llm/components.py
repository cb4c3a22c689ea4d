"""Connected components of a graph of ids, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acquaint.llm.shared import written


def connected(edges: DataFrame) -> DataFrame:
    """node and label, the smallest node of its component, of all nodes with edges.

    Edges have the columns a and b; their direction and repeats do not matter.
    Each step ties the larger neighbours of a node to the smallest node around
    it, then the node itself and its smaller neighbours, until nothing changes.
    Only minima are gathered by node, so a node may have any number of edges. The
    edges of each step are written to the shared folder.
    """
    now = written(_downward(edges), "edges")
    before = _mark(now)
    while True:
        now = written(_small_star(_large_star(now)), "edges")
        after = _mark(now)
        if after == before:
            break
        before = after
    ends = now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(ends)


def joined_labels(labels: DataFrame, links: DataFrame) -> DataFrame:
    """node and label after the components of linked nodes a and b are joined."""
    of_a = labels.select(F.col("node").alias("a"), F.col("label").alias("la"))
    of_b = labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
    edges = links.join(of_a, "a").join(of_b, "b")
    renamed = connected(edges.select(F.col("la").alias("a"), F.col("lb").alias("b")))
    renamed = renamed.select(F.col("node").alias("label"), F.col("label").alias("joined"))
    found = labels.join(renamed, "label", "left")
    return written(found.select("node", F.coalesce("joined", "label").alias("label")), "labels")


def _downward(edges: DataFrame) -> DataFrame:
    return (
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def _mark(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("a", "b")
    return tuple(
        edges.agg(F.count(F.lit(1)), F.bit_xor(mixed), F.sum(mixed.cast("decimal(20,0)"))).first()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least"))
    least = least.select("a", F.least("a", "least").alias("least"))
    larger = both.where(F.col("b") > F.col("a"))
    return larger.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    others = edges.join(least, "a").where(F.col("b") != F.col("least"))
    return (
        others.select(F.col("b").alias("a"), F.col("least").alias("b"))
        .unionByName(least.select("a", F.col("least").alias("b")))
        .distinct()
    )
