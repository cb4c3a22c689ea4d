"""Mixing sources to target weights by temperature.

A source with the share p of all tokens gets a weight in proportion to p to the
power of an exponent: 1 keeps the shares, 0 makes all sources equal. The exponent
is bisected to meet a target: an entropy of the weights, or a limit on how often
the most repeated source is repeated. What a step of that needs are sums over the
sources, so a pass of Spark adds them up for many exponents at once, and no source's
row comes to the driver. Weights times a budget of tokens give each
source its own budget, which is spent in blocks. A block is one permutation of
all documents of the source; the last block of a source ends where its budget does.

Nothing is ordered across a whole source in one task. A document's key in a
block's permutation is a hash; a source's keys are cut into ranges of a few
thousand documents, the ranges' counts and tokens are added up, and only within
a range are documents put in order.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acquaint.llm.shared import written

WORD = r"[^\x20\x09-\x0D]+"

#: Documents of a source in a range of keys, about.
RANGE_DOCUMENTS = 4096

#: Sources up to which their budgets, a row each, are broadcast.
MOST_BROADCAST = 100_000


#: Passes that bisect the exponent, each to one of so many parts.
PASSES, GRID = 9, 64


@dataclass(frozen=True)
class Target:
    """What the exponent is bisected for, and the budget.

    One of ``repetitions`` (of the most repeated source) and ``entropy`` (of the
    weights, in bits) is given. ``tokens`` is the budget; without it, it is the
    smallest that has every document at least once.
    """

    repetitions: float | None = 2.0
    entropy: float | None = None
    tokens: int | None = None
    seed: int = 17


def token_count(text: Column) -> Column:
    """Words, and one more for the end of the document."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long") + 1


#: Sums over the shares p of all sources, for each exponent e: of p ** e, and of
#: p ** e * log2(p).
Sums = Callable[[Sequence[float]], Sequence[tuple[float, float]]]


def exponent_for(sums: Sums, least: float, most: float, total: int, target: Target) -> float:
    """The exponent that meets the target, between 0 and 1.

    ``least`` and ``most`` are the smallest and the largest share of ``total`` tokens.
    A target beyond what 0 or 1 gives is met by that end: with a limit of
    repetitions, by 0 if even equal weights keep it.
    """
    if least == most:
        return 1.0

    def too_flat(exponent: float, whole: float, logs: float) -> bool:
        if target.entropy is not None:
            return math.log2(whole) - exponent * logs / whole > target.entropy
        return repetitions(exponent, whole, least, most, total, target) > target.repetitions

    if not too_flat(0.0, *sums([0.0])[0]):
        return 0.0
    low, high = 0.0, 1.0
    for _ in range(PASSES):
        grid = [low + (high - low) * k / GRID for k in range(1, GRID)]
        flat = [too_flat(e, *s) for e, s in zip(grid, sums(grid))]
        # It only grows less flat with the exponent.
        first = flat.index(False) if False in flat else len(flat)
        low, high = [low, *grid][first], [*grid, high][first]
    return high


def budget(exponent: float, whole: float, most: float, total: int, target: Target) -> float:
    """Tokens of the mixture; without a target, each source is used at least once."""
    return float(target.tokens) if target.tokens is not None else total * whole * most ** (1 - exponent)


def repetitions(
    exponent: float, whole: float, least: float, most: float, total: int, target: Target
) -> float:
    """How often the most repeated source is used, the smallest one."""
    return budget(exponent, whole, most, total, target) / total * least ** (exponent - 1) / whole


def _identified(documents: DataFrame, *others: Column) -> DataFrame:
    """doc_id, source, tokens, text_hash and copy, which tell all rows apart.

    ``copy`` is 0, but for rows that are equal in the others; these are numbered, in a
    written table, so that they keep their numbers.
    """
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        token_count(F.col("text")).alias("tokens"),
        F.xxhash64("text").alias("text_hash"),
        *others,
    )
    same = F.xxhash64("doc_id", "source", "text_hash")
    repeated = rows.groupBy(same.alias("same")).count().where("count > 1").select("same")
    if repeated.isEmpty():
        return rows.withColumn("copy", F.lit(0).cast("long"))
    repeated = written(repeated, "repeated").withColumn("again", F.lit(True))
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "numbered")
    rows = rows.withColumn("same", same).join(repeated, "same", "left")
    copy = F.when(F.col("again"), F.col("row")).otherwise(0)
    return rows.withColumn("copy", copy).drop("same", "again", "row")


def _key(block: Column, seed: int) -> Column:
    """Place of a document in a block's permutation, from 0 up to but below 1.

    It depends on the row alone; rows that share an id, or are equal, have their own.
    """
    mixed = F.xxhash64(F.lit(seed), block.cast("long"), "doc_id", "source", "text_hash", "copy")
    return F.shiftrightunsigned(mixed, 11).cast("double") / F.lit(float(2**53))


def budgets(sized: DataFrame, target: Target) -> DataFrame:
    """budget_of (the source), weight, blocks (whole ones), rest and ranges of each source."""
    sources = written(
        sized.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("n")),
        "sources",
    )
    there, total, least, most = sources.agg(
        F.count(F.lit(1)), F.sum("tokens"), F.min("tokens"), F.max("tokens")
    ).first()
    total = total or 1
    share = F.col("tokens") / F.lit(total)

    def sums(exponents: Sequence[float]) -> list[tuple[float, float]]:
        raw = [F.pow(share, F.lit(e)) for e in exponents]
        found = sources.agg(*map(F.sum, raw), *[F.sum(r * F.log2(share)) for r in raw]).first()
        return list(zip(found[: len(raw)], found[len(raw) :]))

    exponent, whole = 1.0, 1.0
    if there:
        least, most = least / total, most / total
        exponent = exponent_for(sums, least, most, total, target)
        whole = sums([exponent])[0][0]
    tokens = budget(exponent, whole, most or 1.0, total, target)
    rows = sources.withColumn("weight", F.pow(share, F.lit(exponent)) / F.lit(whole))
    rows = rows.withColumn("own", F.col("weight") * F.lit(tokens))
    # A budget within a rounding error of whole blocks has no rest.
    rows = rows.withColumn("blocks", F.floor(F.col("own") / F.col("tokens") + 1e-9))
    rest = F.col("own") - F.col("blocks") * F.col("tokens")
    rows = rows.select(
        F.col("source").alias("budget_of"),
        "weight",
        "blocks",
        F.when(rest >= 1, rest).otherwise(0.0).alias("rest"),
        F.ceil(F.col("n") / RANGE_DOCUMENTS).alias("ranges"),
    )
    return F.broadcast(rows) if there <= MOST_BROADCAST else rows


def _same_source(table: DataFrame) -> Column:
    return F.col("source").eqNullSafe(table["budget_of"])


def _ends(sized: DataFrame, shares: DataFrame, target: Target) -> DataFrame:
    """ends_of and end: the largest key that a source's last block still takes.

    The last block takes documents, in the order of their keys, until their tokens
    reach the rest of the budget.
    """
    keyed = (
        sized.join(shares, _same_source(shares))
        .where(F.col("rest") > 0)
        .withColumn("key", _key(F.col("blocks"), target.seed))
        .withColumn("range", F.floor(F.col("key") * F.col("ranges")))
    )
    before = Window.partitionBy("source").orderBy("range").rowsBetween(
        Window.unboundedPreceding, -1
    )
    # A range holds about RANGE_DOCUMENTS documents, so ranges are few for a source.
    reached = (
        keyed.groupBy("source", "range", "rest")
        .agg(F.sum("tokens").alias("held"))
        .withColumn("before", F.coalesce(F.sum("held").over(before), F.lit(0)))
        .where((F.col("before") < F.col("rest")) & (F.col("before") + F.col("held") >= F.col("rest")))
        .select(F.col("source").alias("last_of"), F.col("range").alias("last"), "before")
    )
    within = Window.partitionBy("source").orderBy("key", "doc_id").rowsBetween(
        Window.unboundedPreceding, -1
    )
    last = keyed.join(
        reached, F.col("source").eqNullSafe(F.col("last_of")) & (F.col("range") == F.col("last"))
    )
    return (
        last.withColumn("used", F.col("before") + F.coalesce(F.sum("tokens").over(within), F.lit(0)))
        .where(F.col("used") < F.col("rest"))
        .groupBy("source")
        .agg(F.max("key").alias("end"))
        .select(F.col("source").alias("ends_of"), "end")
    )


def _with_blocks(rows: DataFrame, shares: DataFrame, ends: DataFrame, seed: int) -> DataFrame:
    """Rows once for each block they are in, with the columns block and key."""
    taken = _key(F.col("blocks"), seed) <= F.coalesce("end", F.lit(-1.0))
    many = F.col("blocks") + taken.cast("long")
    return (
        rows.join(shares, _same_source(shares))
        .join(ends, F.col("source").eqNullSafe(F.col("ends_of")), "left")
        .where(many > 0)
        .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), many - 1)))
        .withColumn("key", _key(F.col("block"), seed))
    )


def _bounded_ends(sized: DataFrame, shares: DataFrame, target: Target) -> DataFrame:
    ends = written(_ends(sized, shares, target), "ends")
    return F.broadcast(ends) if ends.count() <= MOST_BROADCAST else ends


def mixture(documents: DataFrame, target: Target = Target()) -> DataFrame:
    """doc_id, source, tokens, weight, block and place of the mixed documents.

    ``place`` numbers the documents of a source's block from 0, in the order of
    its permutation. A null source is a source of its own; a null text has the
    one token of its end. Rows that share an id, or are equal, are drawn each for
    itself. An empty table gives no rows; other columns are ignored.
    """
    sized = written(_identified(documents), "sized")
    shares = budgets(sized, target)
    ends = _bounded_ends(sized, shares, target)
    blocks = _with_blocks(sized, shares, ends, target.seed).withColumn(
        "range", F.floor(F.col("key") * F.col("ranges"))
    )
    of_range = ["source", "block", "range"]
    before = Window.partitionBy("source", "block").orderBy("range").rowsBetween(
        Window.unboundedPreceding, -1
    )
    counted = blocks.groupBy(*of_range).agg(F.count(F.lit(1)).alias("n"))
    offsets = counted.select(
        F.struct(*of_range).alias("of"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")
    )
    within = Window.partitionBy(*of_range).orderBy("key", "doc_id", "tokens")
    placed = blocks.withColumn("n", F.row_number().over(within) - 1)
    return placed.join(offsets, F.struct(*of_range).eqNullSafe(F.col("of"))).select(
        "doc_id",
        "source",
        "tokens",
        "weight",
        "block",
        (F.col("offset") + F.col("n")).alias("place"),
    )


def mixed_documents(documents: DataFrame, target: Target = Target()) -> DataFrame:
    """The rows of the mixture with all their columns, once for each block.

    They are in the order of the blocks, over partitions too, and within a block
    in that of the sources' permutations, whose keys run side by side. Each row
    knows from its key how many blocks it is in.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in documents.columns])
    rows = _identified(documents, whole.alias("whole"))
    sized = written(rows.drop("whole"), "sized")
    shares = budgets(sized, target)
    ends = _bounded_ends(sized, shares, target)
    return (
        _with_blocks(rows, shares, ends, target.seed)
        .repartitionByRange("block", "key")
        .sortWithinPartitions("block", "key")
        .select("whole.*")
    )
