"""Session settings the operators gain from; none is needed for right results.

``recommended_builder`` also sets what can only be set before a session starts.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

RECOMMENDED = {
    # Plan again from measured sizes: small sides are broadcast, small
    # partitions merged, large ones cut.
    "spark.sql.adaptive.enabled": "true",
    # Join by hash instead of sorting both sides wherever every partition of one
    # side is measured to be small. The large side is then not sorted.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    # Cut hot keys up also where a grouping on the same key follows the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Stored times without a zone give the same date everywhere.
    "spark.sql.session.timeZone": "UTC",
}

# With over 2,000 shuffle partitions Spark keeps only average sizes of small map
# outputs. So many times the median, an output is kept by its own size, and
# adaptive execution sees a hot key.
AT_START = {"spark.shuffle.accurateBlockSkewedFactor": "5"}


def recommended_builder(builder: SparkSession.Builder | None = None) -> SparkSession.Builder:
    """A session builder with all recommended settings."""
    builder = builder or SparkSession.builder
    for name, value in {**RECOMMENDED, **AT_START}.items():
        builder = builder.config(name, value)
    return builder


def apply_recommended(spark: SparkSession) -> SparkSession:
    """Set the recommended settings on a session, for callers who want them."""
    for name, value in RECOMMENDED.items():
        spark.conf.set(name, value)
    return spark
