"""What workers keep, and which rows a bitmap clears."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from acquaint.llm import shared


def test_models_are_kept_until_tasks_of_other_modules_run(monkeypatch):
    monkeypatch.setattr(shared, "_KEPT", [])
    made = []

    @shared.kept_for("one")
    def model(name):
        made.append(name)
        return name

    def task(module):
        def run(batches):
            yield from batches

        run.__module__ = module
        return list(shared.giving_back(run)([1, 2]))

    model("a")
    assert task("one") == [1, 2]
    model("a")
    assert made == ["a"]
    task("two")
    model("a")
    assert made == ["a", "a"]


@pytest.mark.parametrize("most", [1 << 15, 1 << 26])
def test_rows_without_keys(spark, monkeypatch, most):
    """Also where the bitmap is so full that it clears nothing."""
    monkeypatch.setattr(shared, "MOST_BITS", most)
    keys = spark.range(0, 60_000, 2).select(F.col("id").alias("k"))
    rows = spark.sql("SELECT CAST(id AS int) AS k, 'x' AS bits FROM range(5000) UNION ALL SELECT NULL, 'y'")
    rows = rows.withColumnRenamed("bits", "other")
    left = shared.without_keys(rows, keys, "k")
    assert left.columns == rows.columns
    found = sorted((r.k is None, r.k or 0) for r in left.collect())
    assert found == [(False, n) for n in range(1, 5000, 2)] + [(True, 0)]


def test_bits_of_keys(spark):
    keys = spark.range(0, 3000, 3)
    slots = shared.bitmap_slots(1000)
    bitmap = shared.bitmap_rows(keys, F.col("id"), slots)
    marked = shared.with_bit(spark.range(3000), bitmap, F.col("id"), slots, "there")
    there = {r.id for r in marked.where("there").collect()}
    assert set(range(0, 3000, 3)) <= there and len(there) < 1400
    whole = shared.bitmap_bytes(bitmap, slots)
    assert 0 < sum(bin(x).count("1") for x in whole.tolist()) <= 1000


def test_a_cluster_without_a_shared_folder_is_an_error():
    class Conf:
        get = staticmethod(lambda *_: None)

    class Context:
        master = "spark://somewhere:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext, conf = Context, Conf

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared.shared_folder(Session)
