"""Adaptive execution splits hot keys of plain joins in the recommended session."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

SKEW_SCRIPT = """
from acquaint.session import recommended_builder
from tests.plans import plan_of
spark = (
    recommended_builder().master("local[4]").config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "2001")
    .config("spark.sql.autoBroadcastJoinThreshold", "-1")
    .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "0")
    .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20k")
    .config("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "20k")
    .getOrCreate()
)
spark.sparkContext.setLogLevel("ERROR")
left = spark.range(0, 120000, 1, 16).selectExpr(
    "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('k', id % 40000) END AS key",
    "md5(CAST(id AS string)) AS value",
)
right = spark.range(0, 40000, 2).selectExpr("concat('k', id) AS key").union(
    spark.sql("SELECT 'hot'")
)
for how in ("inner", "left_semi", "left_anti"):
    joined = left.join(right if how != "left_anti" else right.where("key <> 'hot'"), "key", how)
    print(how, joined.count() if how == "nothing" else len(joined.collect()))
    print("split" if "skew=true" in plan_of(joined) else "whole")
spark.stop()
"""


def test_plain_joins_are_split_at_2001_partitions():
    """A session of its own, as the setting is read when one starts."""
    root = Path(__file__).resolve().parent.parent
    done = subprocess.run(
        [sys.executable, "-c", SKEW_SCRIPT],
        cwd=root,
        env=os.environ | {"PYTHONPATH": str(root)},
        capture_output=True,
        text=True,
        timeout=600,
    )
    counts = {"inner": 80000, "left_semi": 80000, "left_anti": 80000}
    found = done.stdout.split()
    assert found == [x for how in counts for x in (how, str(counts[how]), "split")], done.stderr[-2000:]
