"""Removal of repeated passages by longest previous factors.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts earlier: where
the longest previous factor of a start is ``LENGTH`` or more. To find earlier matches
over all documents without one suffix array of everything:

1. Every window of ``LENGTH`` bytes names an anchor: the gram in it with the
   smallest hash. Equal windows name equal grams at equal places, so windows can
   only be equal where grams are. Windows that follow each other mostly share an
   anchor; they and their bytes are one stretch, a hundred and some bytes.
2. Stretches are dealt out by gram, into cells that stay small however many there
   are. Of wholly equal ones all but the first are covered: that settles whole
   copies, of any number, at once. A task compares its own stretches first; those
   that repeat one of them need no cell of their gram.
3. What is left are unequal stretches with a common gram: the edges of repeated
   passages. Their bytes are fetched, and the windows of one gram are brought into
   suffix order. The previous and the next window in that order that start earlier
   hold the longest previous match; how much they share, the smallest of the common
   prefixes between, is the longest previous factor. Windows with a factor of
   ``LENGTH`` go. Grams with very many stretches are dealt out again by window.

Stretches and windows are compared by 64-bit polynomial hashes over random byte
values; windows in suffix order by their bytes. Long texts pass in segments.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acquaint.llm.minhash import mixed
from acquaint.llm.shared import (
    bitmap_rows,
    bitmap_slots,
    encoded,
    giving_back,
    group_starts,
    parts,
    pieces_of,
    segments,
    slices,
    whole_groups,
    with_bit,
    written,
)

LENGTH = 100

#: Bytes of a gram.
GRAM = 32

#: Stretches of a gram that are brought into suffix order in one task.
MOST_STRETCHES = 4096

#: Stretches of several small grams that are brought into suffix order together.
TOGETHER = 1024

#: Bytes of text whose stretches are compared in a task before they are sent on.
PORTION_BYTES = 8_000_000

#: Bytes of text whose stretches meet in one cell; a task holds one cell at a time.
CELL_BYTES = 32_000_000

#: Stretches whose bytes are handed on together.
ROWS_TOGETHER = 20_000

#: Stands for a null doc_id, before all others.
NULL_ID = -(2**63)

_STEP = np.uint64(0xC6BC279692B5C323)
_BACK = np.uint64(pow(int(_STEP), -1, 2**64))
_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))

_OPEN = "id long, version long, gram long, lo int, hi int, place int"


def removal(documents: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept of every row.

    ``kept`` are the bytes that stay, as binary. Documents are ordered by doc_id,
    a null id first; rows that share an id are documents of their own, ordered by
    a hash of their text, so the later of two equal rows goes. A null text is
    empty. An empty table gives no rows; other columns are ignored. A task holds
    texts one batch at a time, and of a long one the columns of its stretches.
    """
    rows = keyed(documents)
    spans, marked = _marked(rows, repeated_spans(rows))
    text = F.coalesce("text", F.lit(""))
    # Texts without spans are neither joined nor sent.
    whole = marked.where(~F.col("spanned")).select(
        F.when(F.col("id") != NULL_ID, F.col("id")).alias("doc_id"),
        "version",
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"),
        F.sha2(text.cast("binary"), 256).alias("kept_sha256"),
        text.cast("binary").alias("kept"),
    )
    return whole.unionByName(_cut(marked.where("spanned").select("id", "version", "text"), spans))


def shortened_documents(documents: DataFrame) -> DataFrame:
    """The documents, with all their columns, without repeated passages.

    ``text`` and ``n_chars`` are those of what is left, without characters of
    which only some bytes are left. Documents of which nothing is left go; those
    that were empty stay, a null text as null. Rows that share an id are documents
    of their own; a null id is the first.
    """
    others = F.struct(*[F.col(f"`{c}`") for c in documents.columns if c != "text"])
    rows = keyed(documents, others.alias("others"))
    spans, marked = _marked(rows, repeated_spans(rows.select("id", "version", "text")))
    # Only documents with spans are joined and pass through Python.
    joined = marked.where("spanned").drop("spanned").join(spans, ["id", "version"], "left")
    schema = joined.schema

    @giving_back
    def shortened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches):
            texts = batch.column("text").to_pylist()
            for at, spans in enumerate(batch.column("spans").to_pylist()):
                if spans:
                    kept, _ = _without(texts[at].encode(), spans)
                    texts[at] = kept.decode("utf-8", "ignore") or None
            columns = dict(zip(batch.schema.names, batch.columns))
            columns["text"] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    cut = joined.mapInArrow(shortened, schema).where(F.col("spans").isNull() | F.col("text").isNotNull())
    whole = marked.where(~F.col("spanned")).drop("spanned")
    whole = whole.withColumn("spans", F.lit(None).cast(schema["spans"].dataType)).unionByName(cut)
    length = F.when(F.col("spans").isNull(), F.col("others.n_chars")).otherwise(F.length("text"))
    values = {"text": F.col("text"), "n_chars": length.cast(documents.schema["n_chars"].dataType)}
    return whole.select(
        *[values.get(c, F.col(f"others.`{c}`")).alias(c) for c in documents.columns]
    )


def keyed(documents: DataFrame, *others: Column) -> DataFrame:
    """id, version and text: ids without nulls, versions of rows that share one.

    Rows that share ids are brought into the order of ids and hashes of texts by
    ranges, and written, so that they keep their versions. No id is gathered in one
    task, unless its rows are also equal in text.
    """
    given = documents.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("id"), "text", *others
    )
    several = given.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    if several.isEmpty():
        return given.withColumn("version", F.lit(0).cast("long"))
    order = ["id", "text_hash", "text_hash_2", "row"]
    shared = (
        given.withColumn("row", F.monotonically_increasing_id())
        .join(several.select("id"), "id", "left_semi")
        .withColumn("text_hash", F.xxhash64("text"))
        .withColumn("text_hash_2", F.xxhash64("text", F.lit(1)))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("version", F.monotonically_increasing_id())
        .drop("text_hash", "text_hash_2", "row")
    )
    alone = given.join(several.select("id"), "id", "left_anti")
    return alone.withColumn("version", F.lit(0).cast("long")).unionByName(written(shared, "versions"))


def _marked(rows: DataFrame, spans: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The spans of each document, and the rows with ``spanned``: false if they have none."""
    spans = written(_gathered(spans), "spans")
    return spans, _with_one_of(rows, spans, "spanned")


def _with_one_of(rows: DataFrame, keys: DataFrame, name: str) -> DataFrame:
    """The rows with a column that is false only where id and version are not in keys."""
    slots = bitmap_slots(keys.count())
    key = F.struct("id", "version")
    return with_bit(rows, bitmap_rows(keys, key, slots), key, slots, name)


def repeated_spans(rows: DataFrame) -> DataFrame:
    """id, version, start and end of bytes that are repeats; spans may overlap."""
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    least = 2 * parts(rows.sparkSession)
    cells = max(least, -(-size // CELL_BYTES))
    dealt = rows.mapInArrow(_anchors(cells), "cell int, stretches binary")
    dealt = dealt.repartition("cell") if cells == least else dealt.repartition(cells // 2, "cell")
    settled = written(dealt.sortWithinPartitions("cell").mapInArrow(_settle, _OPEN), "settled")
    covered = settled.where(F.col("gram").isNull()).select(
        "id", "version", F.col("lo").alias("start"), (F.col("hi") + LENGTH).alias("end")
    )
    open_ = settled.where(F.col("gram").isNotNull())
    fetched = written(_fetched(rows, open_), "stretches")
    counted = fetched.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    many = counted.where(F.col("n") > MOST_STRETCHES)
    few = fetched
    by_window = None
    if not many.isEmpty():
        few = fetched.join(many, "gram", "left_anti")
        by_window = _by_window(fetched.join(many, "gram", "left_semi"))
    in_order = (
        few.repartition("gram")
        .sortWithinPartitions("gram")
        .mapInArrow(_suffix_order, "id long, version long, start int, end int")
    )
    found = covered.unionByName(in_order)
    return found if by_window is None else found.unionByName(by_window)


class Running:
    """Polynomial hashes of any substrings of a byte array, from running sums."""

    def __init__(self, flat: np.ndarray) -> None:
        powers = np.cumprod(np.full(len(flat), _STEP))
        self._sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[flat] * powers)))
        self._back = np.cumprod(np.full(len(flat) + 1, _BACK))

    def hashes(self, start: np.ndarray | slice, end: np.ndarray | slice) -> np.ndarray:
        return mixed((self._sums[end] - self._sums[start]) * self._back[start])


def stretches(flat: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """Row, first window, last window, anchor, gram hash and content hash of all
    stretches, in the order of rows and windows; places count from the row's start."""
    windows = np.diff(bounds) - LENGTH + 1
    if not (windows > 0).any():
        none = np.zeros(0, np.int64)
        return none, none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    running = Running(flat)
    many = len(flat) - GRAM + 1
    gram = running.hashes(slice(0, many), slice(GRAM, many + GRAM))
    # The smaller hash wins; of equal ones the first.
    least = (gram & np.uint64(0xFFFFFFFF00000000)) | np.arange(many, dtype=np.uint64)
    width, held = LENGTH - GRAM + 1, 1
    while held * 2 <= width:
        least = np.minimum(least[:-held], least[held:])
        held *= 2
    if held < width:
        least = np.minimum(least[: len(least) - (width - held)], least[width - held :])
    anchor = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    owner = np.repeat(np.arange(len(windows)), np.diff(bounds))
    at = np.arange(len(anchor))
    inside = at + LENGTH <= bounds[owner[: len(anchor)] + 1]
    at = at[inside]
    new = np.ones(len(at), bool)
    new[1:] = (anchor[at][1:] != anchor[at][:-1]) | (owner[at][1:] != owner[at][:-1])
    first = np.flatnonzero(new)
    last = np.concatenate((first[1:], [len(at)])) - 1
    lo, hi = at[first], at[last]
    place = anchor[lo]
    content = running.hashes(lo, hi + LENGTH) + ((place - lo) * 256 + (hi - lo)).astype(np.uint64)
    row = owner[lo]
    begin = bounds[row]
    return row, lo - begin, hi - begin, place - begin, gram[place], mixed(content)


def _anchors(cells: int):
    @giving_back
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            ids = batch.column("id").to_numpy()
            versions = batch.column("version").to_numpy()
            rank = np.empty(len(ids), np.int64)
            order = np.lexsort((versions, ids))
            rank[order] = np.arange(len(ids))
            found = []
            flat, bounds = encoded(batch.column("text"))
            for first, last, begin, end in segments(bounds, LENGTH - 1):
                inner = np.clip(bounds[first : last + 1], begin, end) - begin
                row, *places, gram, content = stretches(flat[begin:end], inner)
                # Places count from the row's start, also in a later segment of it.
                ahead = begin - bounds[first] if last == first + 1 else 0
                found.append((rank[row + first], *(x + ahead for x in places), gram, content))
            row, lo, hi, place, gram, content = (np.concatenate(x) for x in zip(*found))
            sort = np.lexsort((lo, row, content))
            again = np.zeros(len(sort), bool)
            again[1:] = content[sort][1:] == content[sort][:-1]
            repeat = np.zeros(len(sort), bool)
            repeat[sort] = again
            # Repeats within the task are settled wherever they go: to no one gram's cell.
            apart = int(mixed(ids[:1].astype(np.uint64))[0] % np.uint64(cells)) if len(ids) else 0
            cell = np.where(repeat, (apart + row) % cells, (gram % np.uint64(cells)).astype(np.int64))
            sort = np.lexsort((lo, row, cell))
            cuts = np.searchsorted(cell[sort], np.arange(cells + 1))
            names, packed = [], []
            for number, (a, b) in enumerate(zip(cuts, cuts[1:])):
                if a < b:
                    at = sort[a:b]
                    names.append(number)
                    packed.append(
                        _pack(ids[order], versions[order], row[at], lo[at], hi[at], place[at],
                              gram[at], content[at], repeat[at])
                    )
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int32()), pa.array(packed, pa.binary())],
                ["cell", "stretches"],
            )

    def portions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last in slices(encoded(batch.column("text"))[1], PORTION_BYTES):
                yield batch.slice(first, last - first)

    return found


def _pack(ids, versions, row, lo, hi, place, gram, content, repeat) -> bytes:
    """Stretches of one cell, in the order of documents, as compressed columns.

    A stretch that repeats one of its own task needs no hashes: it is covered.
    """
    documents, counts = np.unique(row, return_counts=True)
    new = ~repeat
    columns = [
        ids[documents].astype("<i8"),
        versions[documents].astype("<i8"),
        counts.astype("<u4"),
        np.diff(lo, prepend=0).astype("<i4"),
        (hi - lo).astype("u1"),
        (place - lo).astype("u1"),
        repeat.astype("u1"),
        # 40 bits of the gram: a chance agreement only has bytes compared in vain.
        (gram[new] >> np.uint64(24)).astype("<u8").view("u1").reshape(-1, 8)[:, :5].T,
        content[new].astype("<u8"),
    ]
    sizes = np.array([len(documents), len(row), int(new.sum())], "<i8").tobytes()
    plain = sizes + b"".join(np.ascontiguousarray(c).tobytes() for c in columns)
    return len(plain).to_bytes(8, "little") + pa.compress(plain, "zstd", asbytes=True)


def _unpack(packed: bytes) -> tuple[np.ndarray, ...]:
    plain = pa.decompress(packed[8:], int.from_bytes(packed[:8], "little"), "zstd", asbytes=True)
    documents, rows, new = np.frombuffer(plain[:24], "<i8").tolist()
    at = 24

    def take(kind: str, n: int) -> np.ndarray:
        nonlocal at
        found = np.frombuffer(plain, kind, n, at)
        at += found.nbytes
        return found

    ids, versions, counts = take("<i8", documents), take("<i8", documents), take("<u4", documents)
    lo = np.cumsum(take("<i4", rows), dtype=np.int64)
    hi, place, repeat = lo + take("u1", rows), lo + take("u1", rows), take("u1", rows) > 0
    gram = np.zeros((new, 8), np.uint8)
    gram[:, :5] = take("u1", 5 * new).reshape(5, new).T
    whole = np.zeros((2, rows), np.int64)
    whole[0, ~repeat] = gram.view("<i8")[:, 0]
    whole[1, ~repeat] = take("<i8", new)
    return np.repeat(ids, counts), np.repeat(versions, counts), lo, hi, place, repeat, *whole


@giving_back
def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Covered stretches (gram null) and those left open, of each cell."""
    for table in whole_groups(batches, ("cell",)):
        starts = [*group_starts(table, ("cell",)).tolist(), table.num_rows]
        for first, last in zip(starts, starts[1:]):
            packed = table.column("stretches").slice(first, last - first).to_pylist()
            columns = [np.concatenate(x) for x in zip(*map(_unpack, packed))]
            ids, versions, lo, hi, place, repeat, gram, content = columns
            new = np.flatnonzero(~repeat)
            ids_, versions_, lo_, gram_, content_ = (
                x[new] for x in (ids, versions, lo, gram, content)
            )
            # Most grams occur once: sort only the others.
            by_gram = np.argsort(gram_, kind="stable")
            same = np.zeros(len(by_gram) + 1, bool)
            same[1:-1] = gram_[by_gram][1:] == gram_[by_gram][:-1]
            shared = by_gram[same[1:] | same[:-1]]
            order = shared[
                np.lexsort(
                    [x[shared] for x in (lo_, versions_, ids_, content_, gram_)]
                )
            ]
            g, c = gram_[order], content_[order]
            fresh = np.ones(len(order), bool)
            fresh[1:] = (g[1:] != g[:-1]) | (c[1:] != c[:-1])
            covered = np.concatenate((np.flatnonzero(repeat), new[order[~fresh]]))
            firsts = order[fresh]
            g = gram_[firsts]
            again = np.zeros(len(g) + 1, bool)
            again[1:-1] = g[1:] == g[:-1]
            open_ = new[firsts[again[1:] | again[:-1]]]
            for at, grams in (
                (covered, pa.nulls(len(covered), pa.int64())),
                (open_, pa.array(gram[open_])),
            ):
                if len(at):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[at]), pa.array(versions[at]), grams]
                        + [pa.array(x[at].astype(np.int32)) for x in (lo, hi, place)],
                        ["id", "version", "gram", "lo", "hi", "place"],
                    )


def _compressed(rows: DataFrame) -> DataFrame:
    """Rows with their UTF-8 text compressed, to be shuffled by id."""

    @giving_back
    def squeezed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches):
            texts = [(t or "").encode() for t in batch.column("text").to_pylist()]
            packed = [pa.compress(t, "zstd", asbytes=True) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("version"),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array(packed, pa.binary()),
                ],
                ["id", "version", "n_bytes", "packed"],
            )

    return rows.mapInArrow(squeezed, "id long, version long, n_bytes long, packed binary")


def _fetched(rows: DataFrame, open_: DataFrame) -> DataFrame:
    """Open stretches with their bytes; a document's are gathered, at most its length."""
    gathered = open_.groupBy("id", "version").agg(
        F.collect_list(F.struct("gram", "lo", "hi", "place")).alias("open")
    )
    gathered = written(gathered, "open")
    there = _with_one_of(rows, gathered, "there").where("there").select("id", "version", "text")
    joined = _compressed(there).join(gathered, ["id", "version"])

    @giving_back
    def taken(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, 64):
            yield from _stretch_rows(batch)

    return joined.mapInArrow(
        taken, "gram long, id long, version long, lo int, place int, stretch binary"
    )


def _stretch_rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    open_ = batch.column("open")
    counts = np.diff(open_.offsets.to_numpy())
    owner = np.repeat(np.arange(batch.num_rows), counts)
    gram, lo, hi, place = (open_.flatten().field(n) for n in range(4))
    ids, versions = batch.column("id"), batch.column("version")
    held: list[bytes] = []
    first = 0
    ends = iter(zip(lo.to_pylist(), hi.to_pylist()))

    def taken() -> pa.RecordBatch:
        some = slice(first, first + len(held))
        of = pa.array(owner[some])
        return pa.RecordBatch.from_arrays(
            [gram[some], ids.take(of), versions.take(of), lo[some], place[some], pa.array(held, pa.binary())],
            ["gram", "id", "version", "lo", "place", "stretch"],
        )

    for at, many in enumerate(counts.tolist()):
        size, packed = batch.column("n_bytes")[at].as_py(), batch.column("packed")[at].as_buffer()
        text = pa.decompress(packed, size, "zstd", asbytes=True)
        for _ in range(many):
            a, b = next(ends)
            held.append(text[a : b + LENGTH])
            if len(held) == ROWS_TOGETHER:
                yield taken()
                first += len(held)
                held = []
    yield taken()


@giving_back
def _suffix_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows with an earlier equal window, of stretches that share a gram."""
    for table in whole_groups(batches, ("gram",)):
        starts = [*group_starts(table, ("gram",)).tolist(), table.num_rows]
        first = 0
        for next_, end in zip(starts[1:], [*starts[2:], None]):
            # Several small groups at once; equal windows have equal grams.
            if end is None or end - first > TOGETHER:
                yield _repeats(table.slice(first, next_ - first))
                first = next_


def _repeats(table: pa.Table) -> pa.RecordBatch:
    """Runs of windows whose longest previous factor is a whole window."""
    flat, bounds = encoded(table.column("stretch"))
    sizes = np.diff(bounds)
    row = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(flat)) - bounds[row]
    window = np.flatnonzero(place + LENGTH <= sizes[row])
    ids, versions, lo = (table.column(c).to_numpy() for c in ("id", "version", "lo"))
    row, start = row[window], lo[row[window]].astype(np.int64) + place[window]
    position = np.lexsort((start, versions[row], ids[row]))
    factor = np.zeros(len(window), np.int64)
    factor[position] = previous_factors(flat, window[position], LENGTH)
    found = np.flatnonzero(factor >= LENGTH)
    found = found[np.lexsort((start[found], row[found]))]
    row, start = row[found], start[found]
    new = np.ones(len(found), bool)
    new[1:] = (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1)
    begins = np.flatnonzero(new)
    ends = np.concatenate((begins[1:], [len(found)])) - 1 if len(begins) else begins
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids[row[begins]]),
            pa.array(versions[row[begins]]),
            pa.array(start[begins].astype(np.int32)),
            pa.array((start[ends] + LENGTH).astype(np.int32)),
        ],
        ["id", "version", "start", "end"],
    )


def previous_factors(flat: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """The longest previous factor of each start, up to ``depth``, which all have ahead.

    Starts are given in the order of their positions; a factor is the longest
    string that begins at the start and also at an earlier one.
    """
    if not len(starts):
        return np.zeros(0, np.int64)
    ranks = suffix_ranks(flat, depth)
    # Suffix order; suffixes that agree to the full depth in the order of positions.
    order = np.argsort(ranks[-1][1][starts], kind="stable")
    a, b = starts[order[:-1]], starts[order[1:]]
    shared = np.zeros(len(order), np.int64)
    for length, rank in reversed(ranks):
        at = shared[1:]
        open_ = np.flatnonzero(at + length <= depth)
        same = rank[a[open_] + at[open_]] == rank[b[open_] + at[open_]]
        at[open_[same]] += length
    previous = _least_to_smaller(order, shared)
    following = _least_to_smaller(order[::-1], np.concatenate(([0], shared[:0:-1])))[::-1]
    factor = np.empty(len(order), np.int64)
    factor[order] = np.maximum(previous, following)
    return factor


def _least_to_smaller(order: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """For each place in suffix order, what its suffix shares with that of the nearest
    place before that holds a smaller position; 0 if there is none.

    ``shared`` is what each place shares with the one before it. Places jump over
    those that hold larger positions to the places these have reached.
    """
    to = np.arange(len(order)) - 1
    least = shared.copy()
    least[:1] = 0
    larger = np.arange(len(order))
    while True:
        larger = larger[to[larger] >= 0]
        larger = larger[order[to[larger]] > order[larger]]
        if not len(larger):
            break
        over = to[larger]
        least[larger] = np.minimum(least[larger], least[over])
        to[larger] = to[over]
    least[to < 0] = 0
    return least


def suffix_ranks(flat: np.ndarray, depth: int) -> list[tuple[int, np.ndarray]]:
    """Lengths, up to ``depth``, with a code for each place: equal where so many bytes
    from there on are equal. The last are ranks, in the order of ``depth`` bytes.

    Seven bytes are their own code. Ranks by one length give those by twice the
    length, or by any length up to that with overlapping halves. A suffix that ends
    early counts as followed by nothing, before all bytes.
    """
    packed = np.zeros(len(flat) + 7, np.int64)
    for at in range(7):
        packed[: len(flat)] <<= 9
        packed[: len(flat) - at] += flat[at:].astype(np.int64) + 1
    packed = packed[: len(flat)]
    known = min(7, depth)
    found = [(n, packed >> (9 * (7 - n))) for n in (1, 2, 4, 7) if n < known or n == 7 < depth]
    _, rank = np.unique(packed >> (9 * (7 - known)), return_inverse=True)
    while known < depth:
        step = min(known, depth - known)
        after = np.full(len(rank), -1)
        after[: max(0, len(rank) - step)] = rank[step:]
        _, rank = np.unique(rank * (len(flat) + 1) + after + 1, return_inverse=True)
        known += step
        found.append((known, rank))
    return found if found and found[-1][0] == depth else [*found, (depth, rank)]


def _by_window(stretches_: DataFrame) -> DataFrame:
    """The same for grams with very many stretches: equal windows meet by hash.

    Only the earliest position of each window is gathered, in part before the
    shuffle, so a passage in any number of documents stays spread out.
    """

    @giving_back
    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, bounds = encoded(batch.column("stretch"))
            sizes = np.diff(bounds)
            row = np.repeat(np.arange(len(sizes)), sizes)
            place = np.arange(len(flat)) - bounds[row]
            at = np.flatnonzero(place + LENGTH <= sizes[row])
            row, place = row[at], place[at]
            names = Running(flat).hashes(at, at + LENGTH) if len(flat) else np.zeros(0, np.uint64)
            lo = batch.column("lo").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(names.astype(np.int64)),
                    batch.column("id").take(pa.array(row)),
                    batch.column("version").take(pa.array(row)),
                    pa.array((lo[row] + place).astype(np.int32)),
                ],
                ["window", "id", "version", "start"],
            )

    found = stretches_.select("id", "version", "lo", "stretch").mapInArrow(
        windows, "window long, id long, version long, start int"
    )
    here = F.struct("id", "version", "start")
    earliest = found.groupBy("window").agg(F.min(here).alias("earliest"), F.count(F.lit(1)).alias("n"))
    earliest = earliest.where(F.col("n") > 1).drop("n")
    return found.join(earliest, "window").where(here > F.col("earliest")).select(
        "id", "version", "start", (F.col("start") + LENGTH).alias("end")
    )


def _gathered(spans: DataFrame) -> DataFrame:
    """Spans of each document, in order: at most its length."""
    return spans.groupBy("id", "version").agg(
        F.sort_array(F.collect_set(F.struct("start", "end"))).alias("spans")
    )


def _without(text: bytes, spans: list[dict]) -> tuple[bytes, int]:
    """The text without its spans, and the number of maximal runs removed."""
    merged: list[list[int]] = []
    for span in spans:
        if merged and span["start"] <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], span["end"])
        else:
            merged.append([span["start"], span["end"]])
    edges = [0, *(x for pair in merged for x in pair), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])), len(merged)


def _cut(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """What stays of each document, given the gathered spans."""
    joined = _compressed(rows).join(spans, ["id", "version"], "left")

    @giving_back
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, 256):
            yield _kept_rows(batch)

    return joined.mapInArrow(
        cut,
        "doc_id long, version long, n_bytes long, n_removed long, n_spans long,"
        " kept_sha256 string, kept binary",
    )


def _kept_rows(batch: pa.RecordBatch) -> pa.RecordBatch:
    out: list[tuple] = []
    ids = batch.column("id").to_pylist()
    for id_, packed, size, spans in zip(
        ids, *(batch.column(c).to_pylist() for c in ("packed", "n_bytes", "spans"))
    ):
        text = pa.decompress(packed, size, "zstd", asbytes=True)
        kept, removed = _without(text, spans or [])
        digest = hashlib.sha256(kept).hexdigest()
        id_ = None if id_ == NULL_ID else id_
        out.append((id_, size, size - len(kept), removed, digest, kept))
    columns = list(zip(*out)) or [()] * 6
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    found = [pa.array(c, k) for c, k in zip(columns, kinds)]
    found.insert(1, batch.column("version"))
    return pa.RecordBatch.from_arrays(
        found, ["doc_id", "version", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    )
