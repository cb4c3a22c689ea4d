"""Sharding by Karmarkar-Karp differencing: near-equal bytes, groups kept whole.

Rows with equal texts form a group that no shard splits. Every group starts as a
partial partition: its bytes in one of the shards, nothing in the others. The
two partial partitions with the largest spread (most minus least) are combined,
again and again: the fullest part of one joins the emptiest of the other.

This runs in three levels. Groups are hashed into cells; in a cell, chunks of
groups are combined into one partial partition each, and these into one for the
cell. It has more parts than there are shards, small enough to level out what
very large groups leave uneven; the driver combines the parts of all cells. Their
number, at most ``MOST_CELLS`` times the parts of a cell, is set by the
configuration and not by the data.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from acquaint.llm.shared import giving_back, group_starts, parts, written

#: Bytes that a row takes besides its text.
ROW_BYTES = 8

#: Groups that are combined at once in a task.
CHUNK_GROUPS = 10_000

MOST_CELLS = 4096

#: Parts of all cells for each shard, at least.
PARTS_PER_SHARD = 256

_GROUP = ["text_hash", "text_hash_2", "text_bytes"]


def shard_documents(documents: DataFrame, shards: int = 24, cells: int | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row.

    ``size`` is the text's UTF-8 bytes plus 8; the law is ``bytes``, so
    ``grown_shard`` is null. Slots number the rows of a shard from 0 without
    gaps. A null text has no bytes and the checksum 0 of none; null texts and
    empty texts are one group. Repeated rows count and get slots of their own;
    null ids stay null. An empty table gives no rows; other columns are ignored.
    A group larger than a shard's share cannot be split and makes its shard
    larger.
    """
    spark = documents.sparkSession
    cells = cells or min(MOST_CELLS, parts(spark))
    cell_parts = -(-PARTS_PER_SHARD // cells) * shards
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = written(
        documents.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("text_hash"),
            # A second hash of other form, so that texts are not mistaken for equal.
            F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10)
            .cast("long")
            .alias("text_hash_2"),
            F.octet_length(text).cast("long").alias("text_bytes"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "sized",
    )
    groups = rows.groupBy(*_GROUP).agg(F.sum("size").alias("bytes"))
    placed = written(_cell_parts(groups, cell_parts, cells), "placed")
    sums = (
        placed.groupBy("cell", "part").agg(F.sum("bytes").alias("bytes")).collect()
    )  # at most cells * cell_parts rows
    shard_of = _combined_parts(sorted(tuple(r) for r in sums), shards)
    numbers = spark.createDataFrame(shard_of, "cell int, part int, shard int")
    # At most cells * cell_parts rows, set by the configuration.
    sharded = rows.join(
        placed.join(F.broadcast(numbers), ["cell", "part"]).select(*_GROUP, "shard"), _GROUP
    ).withColumn("block", F.pmod(F.xxhash64("doc_id", "text_hash_2", "row"), F.lit(cells)).cast("int"))
    return _numbered(sharded, cells)


def _cell_parts(groups: DataFrame, cell_parts: int, cells: int) -> DataFrame:
    """The part, from 0, of each group within its cell."""
    rows = groups.withColumn("cell", F.pmod(F.xxhash64("text_hash"), F.lit(cells)).cast("int"))
    names = [*_GROUP, "bytes", "cell"]

    @giving_back
    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each cell's groups come in one run; its chunks wait for the cell's end."""
        held: list[tuple[pa.Table, Partial]] = []
        cell = None

        def finished() -> Iterator[pa.RecordBatch]:
            labels = combine([partial for _, partial in held])
            for (table, partial), label in zip(held, labels):
                part = label[partial.parts]
                found = table.append_column("part", pa.array(part.astype(np.int32)))
                yield from found.to_batches()

        for batch in batches:
            table = pa.Table.from_batches([batch])
            if not table.num_rows:
                continue
            starts = [*group_starts(table, ["cell"]).tolist(), table.num_rows]
            for first, last in zip(starts, starts[1:]):
                here = table.column("cell")[first].as_py()
                if cell is not None and here != cell:
                    yield from finished()
                    held = []
                cell = here
                for at in range(first, last, CHUNK_GROUPS):
                    chunk = table.slice(at, min(CHUNK_GROUPS, last - at))
                    held.append((chunk, difference(chunk.column("bytes").to_numpy(), cell_parts)))
        if held:
            yield from finished()

    return (
        rows.select(*names)
        .repartition("cell")
        .sortWithinPartitions("cell", *_GROUP)
        .mapInArrow(
            placed,
            "text_hash long, text_hash_2 long, text_bytes long, bytes long, cell int, part int",
        )
    )


class Partial:
    """A partial partition: bytes of each part in descending order, part of each item."""

    def __init__(self, sums: np.ndarray, parts: np.ndarray) -> None:
        self.sums, self.parts = sums, parts


def difference(sizes: np.ndarray, shards: int) -> Partial:
    """Combine single items into one partial partition."""
    items = np.zeros((len(sizes), shards), np.int64)
    items[:, 0] = sizes
    sums, labels = _combined(list(items), shards)
    return Partial(sums, labels[:, 0])


def combine(partials: list[Partial]) -> list[np.ndarray]:
    """The joint part of each part of these partial partitions."""
    shards = len(partials[0].sums)
    return list(_combined([p.sums for p in partials], shards)[1])


def _combined(items: list[np.ndarray], shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the one partition left, in descending order, and the part in it of
    each item's parts (a row for each item).

    Each step notes which part of the result the two sides' parts went to; read
    back from the last step to the first, that gives every item's parts.
    """
    sums = list(items)
    heap = [(int(s[-1] - s[0]), i) for i, s in enumerate(sums)]
    heapq.heapify(heap)
    steps: list[tuple[int, int, np.ndarray, np.ndarray]] = []
    reverse = np.arange(shards - 1, -1, -1)
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        joined = sums[a] + sums[b][::-1]
        order = np.argsort(-joined, kind="stable")
        to = np.empty(shards, np.int16)
        to[order] = np.arange(shards)
        new = len(sums)
        sums.append(joined[order])
        sums[a] = sums[b] = None
        steps.append((a, b, to, to[reverse]))
        heapq.heappush(heap, (int(sums[new][-1] - sums[new][0]), new))
    labels = np.empty((len(sums), shards), np.int16)
    labels[-1] = np.arange(shards)
    for new, (a, b, to_a, to_b) in reversed(list(enumerate(steps, len(items)))):
        labels[a] = labels[new][to_a]
        labels[b] = labels[new][to_b]
    return sums[-1], labels[: len(items)]


def _combined_parts(
    sums: list[tuple[int, int, int]], shards: int
) -> list[tuple[int, int, int]]:
    """cell, part and shard of each part of a cell, given cell, part and bytes."""
    if not sums:
        return []
    shard = difference(np.array([size for _, _, size in sums]), shards).parts
    return [(cell, part, int(at)) for (cell, part, _), at in zip(sums, shard)]


def _numbered(sharded: DataFrame, cells: int) -> DataFrame:
    """Slots from 0 in each shard: counts of (shard, block), then numbers within.

    Blocks are a hash of the row and its number in the written table, so that they
    stay small whatever group a shard holds, also one of rows equal in all columns.
    """
    counted = sharded.groupBy("shard", "block").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    # At most shards * cells rows, set by the configuration.
    offsets = counted.select(
        "shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")
    )
    within = Window.partitionBy("shard", "block").orderBy("doc_id", "text_hash", "row")
    return sharded.join(F.broadcast(offsets), ["shard", "block"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("offset") + F.row_number().over(within) - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
