"""Exact top-k inner products by distributed histogram selection.

Vectors become whole numbers. Queries and candidates are packed into blocks of
bounded size, and one matrix product gives all scores of a query block and a
candidate block. The pairs of blocks are dealt out in tiles: a task holds the few
query blocks of a tile's row and meets the candidate blocks of its column one by
one, so a block travels once for each tile and not once for each pair. Each pass
narrows, for every query, the range that holds its k-th highest score:

1. coarse histograms of the scores, added up over all candidate blocks, give the
   coarse bin of the k-th score and the number of scores above that bin;
2. finer histograms within that bin do the same, until a bin is one score wide;
3. the last pass keeps the scores above the k-th value and, of those equal to
   it, the smallest ids that are still wanted.

A tile reports only bins that may still hold the k-th score: those from its own
k-th highest score upwards (the global one cannot be lower), cut to k a bin. So a
pass returns at most k rows for each query and tile, whatever the data.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acquaint.llm.shared import giving_back, group_starts, parts, whole_groups, written

RESULT = "query_id long, rank int, vec_id long, score long"

QUERY_BLOCK, CANDIDATE_BLOCK = 2048, 8192

#: Query blocks that a task holds, with a histogram of each, about.
ROWS_OF_TILE = 4

#: Bins of a histogram pass for each query.
BINS = 1024


def quantised(vectors: DataFrame, scale: int = 64) -> DataFrame:
    """vec_id and floor(scale * x) of each component, of vectors that take part.

    Vectors that are null or hold a null or non-finite component, and rows with
    a null id, are left out.
    """
    component = F.col("embedding")
    bad = F.exists(component, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == math.inf))
    return (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
        .where(F.col("vec_id").isNotNull() & component.isNotNull() & ~bad)
        .select(
            "vec_id",
            F.transform(component, lambda x: F.floor(x.cast("double") * scale)).alias("v"),
        )
    )


def top_k(
    vectors: DataFrame, is_query: Callable[[Column], Column], k: int = 20, scale: int = 64
) -> DataFrame:
    """The k highest scores of each query among all rows with another vec_id.

    Ties go to the smaller vec_id. Fewer than k candidates give fewer rows, none
    gives none. Only vectors of the same length have an inner product; others
    are no candidates of each other. Of rows that share a query's vec_id the
    smallest vector is the query; as candidates all rows count. Other columns
    are ignored.
    """
    whole = written(quantised(vectors, scale), "vectors")
    most = whole.agg(
        F.max(F.size("v")), F.max(F.aggregate("v", F.lit(0).cast("long"), _larger))
    ).first()
    # No score is further from 0 than this; it bounds the histograms' range.
    reach = int((most[0] or 0) * (most[1] or 0) ** 2) + 1
    kind = next(t for t in ("i1", "i2", "i4", "i8") if (most[1] or 0) < 2 ** (8 * int(t[1]) - 1))
    queries = whole.where(is_query(F.col("vec_id"))).groupBy("vec_id").agg(F.min("v").alias("v"))
    tiles = _Tiles(
        _blocks(queries, QUERY_BLOCK, kind, "q"), _blocks(whole, CANDIDATE_BLOCK, kind, "c")
    )
    scores = _Scores(kind, reach)
    width = 1
    while width * BINS < 2 * reach:
        width *= BINS
    ranges = None
    while width:
        found = tiles.dealt(ranges).mapInArrow(
            _histograms(scores, k, width),
            "block string, query_id long, low long, wanted long, bin long, n long",
        )
        ranges = written(_narrowed(found, width), "ranges")
        width //= BINS
    kept = tiles.dealt(ranges).mapInArrow(
        _selection(scores), "query_id long, vec_id long, score long"
    )
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        kept.withColumn("rank", F.row_number().over(rank))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _larger(most: Column, x: Column) -> Column:
    return F.greatest(most, F.abs(x))


def _blocks(vectors: DataFrame, rows: int, kind: str, name: str) -> DataFrame:
    """Vectors of equal length packed into matrices of at most ``rows`` rows."""
    # Equal rows are dealt out by their tasks.
    cells = F.lit(math.ceil(1.25 * vectors.count() / rows) or 1)
    dealt = F.pmod(F.xxhash64("vec_id", "v", F.spark_partition_id()), cells).cast("int")
    vectors = vectors.select("vec_id", "v", F.size("v").alias("dim"), dealt.alias("cell"))

    @giving_back
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for groups in whole_groups(batches, ("dim", "cell")):
            starts = [*group_starts(groups, ("dim", "cell")).tolist(), groups.num_rows]
            for first, last in zip(starts, starts[1:]):
                for at in range(first, last, rows):
                    part = groups.slice(at, min(rows, last - at)).combine_chunks()
                    dim, cell = part.column("dim")[0].as_py(), part.column("cell")[0].as_py()
                    v = part.column("v").combine_chunks().flatten().to_numpy()
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([f"{dim}/{cell}/{at - first}"]),
                            pa.array([dim], pa.int32()),
                            pa.array([cell], pa.int32()),
                            pa.array([part.column("vec_id").to_numpy().astype("<i8").tobytes()]),
                            pa.array([v.astype("<" + kind).tobytes()]),
                        ],
                        ["block", "dim", "cell", "ids", "matrix"],
                    )

    blocks = (
        vectors.repartition("dim", "cell")
        .sortWithinPartitions("dim", "cell", "vec_id")
        .mapInArrow(packed, "block string, dim int, cell int, ids binary, matrix binary")
    )
    return written(blocks, f"blocks-{name}")


_TILE = ["dim", "tile_row", "tile_column"]


class _Tiles:
    """Query and candidate blocks, dealt out to the tiles of a grid.

    Blocks are in a tile's row or column by their cell, of which each holds about
    one block. There are as many columns as give every core a tile.
    """

    def __init__(self, queries: DataFrame, candidates: DataFrame) -> None:
        self._queries, self._candidates = queries, candidates
        spark = queries.sparkSession
        many = max(parts(spark), spark.sparkContext.defaultParallelism)
        self._rows = -(-self._cells(queries) // ROWS_OF_TILE)
        self._columns = min(-(-many // self._rows), self._cells(candidates))

    @staticmethod
    def _cells(blocks: DataFrame) -> int:
        return (blocks.agg(F.max("cell")).first()[0] or 0) + 1

    def dealt(self, ranges: DataFrame | None) -> DataFrame:
        """Tiles in partitions: query blocks with the ranges of their queries, at most
        one block of them, and then candidate blocks."""
        if ranges is None:
            queries = self._queries.withColumn("ranges", F.lit(None).cast(_RANGES))
        else:
            one = F.struct("query_id", "low", "wanted")
            packed = ranges.groupBy("block").agg(F.sort_array(F.collect_list(one)).alias("ranges"))
            queries = self._queries.join(packed, "block")

        def over(n: int) -> Column:
            return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

        cell = F.col("cell")
        queries = queries.select(
            "*", F.lit(True).alias("asks"),
            F.pmod(cell, F.lit(self._rows)).alias("tile_row"), over(self._columns).alias("tile_column"),
        )
        candidates = self._candidates.select(
            "*", F.lit(None).cast(_RANGES).alias("ranges"), F.lit(False).alias("asks"),
            over(self._rows).alias("tile_row"), F.pmod(cell, F.lit(self._columns)).alias("tile_column"),
        )
        return (
            queries.unionByName(candidates)
            .repartitionByRange(self._rows * self._columns, *_TILE)
            .sortWithinPartitions(*_TILE, F.desc("asks"), "block")
        )


_RANGES = "array<struct<query_id:bigint,low:bigint,wanted:bigint>>"


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[dict], Iterator[dict]]]:
    """The query blocks of each tile, and its candidate blocks, one after the other."""
    rows = (batch.slice(at, 1).to_pylist()[0] for batch in batches for at in range(batch.num_rows))
    for _, tile in itertools.groupby(rows, lambda row: tuple(row[c] for c in _TILE)):
        asking = []
        for row in tile:
            if row["asks"]:
                asking.append(row)
                continue
            if asking:
                yield asking, itertools.chain([row], tile)
            break


class _Scores:
    """All scores of a pair of blocks, some rows of queries at a time."""

    def __init__(self, kind: str, reach: int) -> None:
        self.kind, self.reach = kind, reach
        # Whole numbers are exact in a float that holds the largest: a score less a
        # lower bound, or twice the reach.
        self.exact = np.float32 if reach < 2**23 else np.float64 if reach < 2**52 else np.int64

    def asked(self, row: dict, k: int) -> tuple[np.ndarray, ...]:
        """Ids, lower bounds, wanted numbers and vectors of a block's queries."""
        ids = np.frombuffer(row["ids"], "<i8")
        low = np.full(len(ids), -self.reach)
        wanted = np.full(len(ids), k)
        if row["ranges"] is not None:
            found = np.array([tuple(x.values()) for x in row["ranges"]], np.int64).reshape(-1, 3)
            at = np.searchsorted(ids, found[:, 0])
            wanted[:] = 0
            low[at], wanted[at] = found[:, 1], found[:, 2]
        return ids, low, wanted, self.vectors(row)

    def vectors(self, row: dict) -> np.ndarray:
        found = np.frombuffer(row["matrix"], "<" + self.kind)
        return found.reshape(len(row["ids"]) // 8, row["dim"]).astype(self.exact)

    def __call__(
        self, ids: np.ndarray, vectors: np.ndarray, other: dict
    ) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """The first query, candidate ids and scores, of some queries at a time.

        A query's own rows score below all bounds.
        """
        other_ids, others = np.frombuffer(other["ids"], "<i8"), self.vectors(other)
        first = np.searchsorted(other_ids, ids, side="left")
        last = np.searchsorted(other_ids, ids, side="right")
        for a in range(0, len(ids), 128):
            score = vectors[a : a + 128] @ others.T
            for i in range(len(score)):
                score[i, first[a + i] : last[a + i]] = -2 * self.reach
            yield a, other_ids, score


def _histograms(scores: _Scores, k: int, width: int) -> Callable:
    @giving_back
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for asking, candidates in _tiles(batches):
            asked = [scores.asked(row, k) for row in asking]
            held = [np.zeros((len(ids), BINS), np.int32) for ids, *_ in asked]
            for other in candidates:
                for n, (ids, low, _, vectors) in zip(held, asked):
                    for a, _, score in scores(ids, vectors, other):
                        bins = score - low[a : a + len(score), None].astype(score.dtype)
                        # The width is a power of 2, by which floats are divided exactly.
                        bins = bins // width if bins.dtype == np.int64 else np.floor(bins / width)
                        rows, columns = np.nonzero((bins >= 0) & (bins < BINS))
                        cell = rows * BINS + bins[rows, columns].astype(np.int64)
                        found = np.bincount(cell, minlength=len(score) * BINS)
                        n[a : a + len(score)] += found.reshape(-1, BINS).astype(np.int32)
            for row, n, (ids, low, wanted, _) in zip(asking, held, asked):
                above = np.cumsum(n[:, ::-1], axis=1)[:, ::-1] - n
                at, bin_ = np.nonzero((n > 0) & (above < wanted[:, None]))
                columns = [ids[at], low[at], wanted[at], bin_, np.minimum(n[at, bin_], k)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["block"]] * len(at), pa.string())]
                    + [pa.array(x.astype(np.int64)) for x in columns],
                    ["block", "query_id", "low", "wanted", "bin", "n"],
                )

    return counted


def _narrowed(found: DataFrame, width: int) -> DataFrame:
    """The bin of each query's k-th score, and how many are wanted from it.

    Queries with fewer candidates than wanted want all of them.
    """
    query = Window.partitionBy("block", "query_id")
    down = query.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    wanted = F.least("wanted", "total")
    return (
        found.groupBy("block", "query_id", "low", "wanted", "bin")
        .agg(F.sum("n").alias("n"))
        .withColumn("reached", F.sum("n").over(down))
        .withColumn("total", F.sum("n").over(query))
        .where((F.col("reached") >= wanted) & (F.col("reached") - F.col("n") < wanted))
        .select(
            "block",
            "query_id",
            (F.col("low") + F.col("bin") * width).alias("low"),
            (wanted - (F.col("reached") - F.col("n"))).alias("wanted"),
        )
    )


def _selection(scores: _Scores) -> Callable:
    @giving_back
    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for asking, candidates in _tiles(batches):
            asked = [scores.asked(row, 0) for row in asking]
            for other in candidates:
                for ids, low, wanted, vectors in asked:
                    low = np.where(wanted > 0, low, 2 * scores.reach)
                    for a, other_ids, score in scores(ids, vectors, other):
                        yield _selected(
                            ids[a : a + len(score)], low[a : a + len(score)], wanted[a : a + len(score)],
                            other_ids, score,
                        )

    return kept


def _selected(ids, low, wanted, other_ids, score) -> pa.RecordBatch:
    """Scores above each query's bound, and of those equal to it as many as are wanted."""
    low = low.astype(score.dtype)
    rows, columns = np.nonzero(score > low[:, None])
    tied, tied_columns = np.nonzero(score == low[:, None])
    # Ids ascend along the columns, so the first ties are the smallest.
    starts = np.searchsorted(tied, np.arange(len(ids)))
    take = np.arange(len(tied)) - starts[tied] < wanted[tied]
    rows = np.concatenate((rows, tied[take]))
    columns = np.concatenate((columns, tied_columns[take]))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids[rows]),
            pa.array(other_ids[columns]),
            pa.array(score[rows, columns].astype(np.int64)),
        ],
        ["query_id", "vec_id", "score"],
    )
