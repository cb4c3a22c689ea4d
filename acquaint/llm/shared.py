"""Shared folders for written intermediate tables, and streams of Arrow rows."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: UTF-8 bytes of text that one step of a vectorised operator holds at once.
CHUNK_BYTES = 1_000_000


#: Bits of a bitmap of keys that goes to all tasks: 8 MB, however many keys there are.
MOST_BITS = 1 << 26

#: Bits of one row of such a bitmap, as Spark builds them.
_ROW_BITS = 15

Batches = Iterator[pa.RecordBatch]


#: Models that a worker keeps from task to task, and the modules whose tasks use them.
_KEPT: list[tuple[tuple[str, ...], Callable]] = []


def kept_for(*modules: str) -> Callable[[Callable], Callable]:
    """A function whose last results a worker keeps until tasks of other modules run."""

    def kept(function: Callable) -> Callable:
        cached = functools.lru_cache(maxsize=2)(function)
        _KEPT.append((modules, cached))
        return cached

    return kept


def giving_back(function: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """A function over batches that hands freed memory back when its task ends.

    Workers live on between tasks, and what they and their allocators keep counts
    against the executor's memory while other stages run. What tasks of other modules
    have kept goes before this one begins.
    """

    @functools.wraps(function)
    def run(batches: Batches) -> Batches:
        for modules, cached in _KEPT:
            if function.__module__ not in modules:
                cached.cache_clear()
        yield from function(batches)
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # only glibc has it
            ctypes.CDLL(None).malloc_trim(0)

    return run


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``.

    Where that is unset, a session whose executors are threads of the driver gets a
    temporary one; on a cluster, where others could not see that, this is an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="acquaint-checkpoint-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(rows: DataFrame, name: str) -> DataFrame:
    """The rows, written to the shared folder once and read from there."""
    spark = rows.sparkSession
    folder = new_folder(spark, name)
    rows.write.parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)


def bitmap_slots(keys: int) -> int:
    """Bits for so many keys: sixteen each, but ``MOST_BITS`` at most."""
    return 1 << min(MOST_BITS.bit_length() - 1, max(_ROW_BITS, (16 * keys).bit_length()))


def bitmap_rows(keys: DataFrame, key: Column, slots: int) -> DataFrame:
    """bitmap_row and bits, of the hashes of all keys: at most ``slots`` bits together."""
    slot = F.pmod(F.xxhash64(key), F.lit(slots))
    within = slot.bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return keys.groupBy(F.shiftright(slot, _ROW_BITS).alias("bitmap_row")).agg(
        F.bitmap_construct_agg(within).alias("bits")
    )


def bitmap_bytes(rows: DataFrame, slots: int) -> np.ndarray:
    """The whole bitmap in one array."""
    whole = np.zeros(slots // 8, np.uint8)
    size = 1 << (_ROW_BITS - 3)
    for row, bits in rows.collect():
        whole[row * size : (row + 1) * size] = np.frombuffer(bytes(bits), np.uint8)
    return whole


def with_bit(rows: DataFrame, bitmap: DataFrame, key: Column, slots: int, name: str) -> DataFrame:
    """The rows with a column that is true for every key of the bitmap, and for few others."""
    slot = F.pmod(F.xxhash64(key), F.lit(slots))
    within = slot.bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).cast("int")
    byte = F.conv(F.hex(F.substring("bits", F.shiftright(within, 3) + 1, F.lit(1))), 16, 10)
    bit = F.getbit(byte.cast("int"), within.bitwiseAND(F.lit(7))) == 1
    joined = rows.withColumn("bitmap_row", F.shiftright(slot, _ROW_BITS))
    joined = joined.join(F.broadcast(bitmap), "bitmap_row", "left")
    return joined.withColumn(name, F.coalesce(bit, F.lit(False))).drop("bitmap_row", "bits")


def without_keys(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows whose key, as a long, is not among the keys; null keys stay.

    Only rows that a bitmap of the keys does not clear are joined.
    """
    slots = bitmap_slots(keys.count())
    bitmap = bitmap_rows(keys, F.col(key).cast("long"), slots)
    marked = with_bit(rows, bitmap, F.col(key).cast("long"), slots, "__there")
    found = marked.where("__there").join(keys, rows[key].cast("long") == keys[key], "left_anti")
    return marked.where("NOT __there").drop("__there").unionByName(found.drop("__there"))


def held_out(doc_id: Column) -> Column:
    """Rows kept from learning: crc32 of the id's decimal digits leaves 0 by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def encoded(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column in one array, and the bounds of its rows.

    A null row is empty. Nothing is copied unless the column has nulls.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    bounds = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1]
    bounds = bounds.astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), bounds - bounds[0]
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def slices(bounds: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose bytes together stay below ``most``, one row at least."""
    start, rows = 0, len(bounds) - 1
    while start < rows:
        end = int(np.searchsorted(bounds, bounds[start] + most, side="right")) - 1
        end = min(max(end, start + 1), rows)
        yield start, end
        start = end


def segments(
    bounds: np.ndarray, overlap: int, most: int = CHUNK_BYTES
) -> Iterator[tuple[int, int, int, int]]:
    """The ranges of ``slices`` with the bytes they span, from and to.

    A row that is longer alone comes in segments, each but the last followed by
    ``overlap`` bytes of the next.
    """
    for first, last in slices(bounds, most):
        begin, end = int(bounds[first]), int(bounds[last])
        for at in range(begin, max(end - overlap, begin + 1), most if last == first + 1 else end - begin + 1):
            yield first, last, at, min(at + most + overlap, end) if last == first + 1 else end


def word_end(flat: np.ndarray, bounds: np.ndarray, at: int, apart: np.ndarray) -> int:
    """The first place from ``at`` on where no word goes on, in rows of these bounds.

    ``apart`` tells of each byte whether it is outside of words.
    """
    if at >= len(flat):
        return len(flat)
    row_end = int(bounds[np.searchsorted(bounds, at)])
    while at < row_end:
        ahead = np.flatnonzero(apart[flat[at : min(at + 65_536, row_end)]])
        if len(ahead):
            return at + int(ahead[0])
        at = min(at + 65_536, row_end)
    return row_end


def pieces_of(batches: Iterable[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, where each becomes Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def whole_groups(
    batches: Iterable[pa.RecordBatch], key: Sequence[str]
) -> Iterator[pa.Table]:
    """Tables that end where a key ends, from batches sorted by the key.

    Groups are never split over two tables. A table holds one batch and what it
    takes to complete its last group.
    """
    kept: list[pa.Table] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        table = pa.Table.from_batches([batch])
        starts = group_starts(table, key)
        last = int(starts[-1])
        if last == 0 and kept and _same(kept[-1], table, key):
            kept.append(table)
            continue
        if kept and not _same(kept[-1], table, key):
            yield pa.concat_tables(kept)
            kept = []
        if last:
            yield pa.concat_tables([*kept, table.slice(0, last)])
        kept = [table.slice(last)]
    if kept:
        yield pa.concat_tables(kept)


def group_starts(table: pa.Table, key: Sequence[str]) -> np.ndarray:
    """Row numbers where a new key begins; the table is sorted by the key."""
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for name in key:
        values = table.column(name).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def _same(before: pa.Table, after: pa.Table, key: Sequence[str]) -> bool:
    last = before.num_rows - 1
    return all(before.column(k)[last].as_py() == after.column(k)[0].as_py() for k in key)

