"""Packing token sequences, balanced by the cost of attention.

A sequence costs ``linear`` per token and ``quadratic`` per squared length of
each piece in it, as attention stays within a document. A piece as long as a
sequence makes the dearest sequence there is. Where others are much cheaper, long
documents are therefore cut into halves of sequences, or halves of those, as few as
bring a sequence with such a piece near the mean cost. All pieces are
assigned in descending length to the cheapest open sequence that still has
room for them. What fits nowhere whole is cut over the gaps that are left, so a
group of documents pads less than one sequence.

Groups follow the input's partitions: each task packs its own documents, holds
at most ``group_tokens`` of them (and one document more) and needs no shuffle.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from acquaint.llm.shared import encoded, giving_back, slices
from acquaint.llm.tokens import piece_tokenizer

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long,"
    " sequence_id long, offset long, padded_length long"
)

_ARROW = pa.schema([(column.split()[0], pa.int64()) for column in SCHEMA.split(",")])

#: Sequence numbers of a task follow its partition number times this.
_TASK_STEP = 1 << 36


@dataclass(frozen=True)
class Packing:
    length: int = 2048
    end_id: int = 1
    linear: float = 1.0
    quadratic: float = 1.0 / 1024
    group_tokens: int = 4_000_000
    #: A sequence with a longest piece may cost so many times the mean.
    slack: float = 1.25
    #: Long documents are not cut into pieces shorter than this.
    least_cut: int = 256

    def cost(self, length):
        return self.linear * length + self.quadratic * length * length


def pack_documents(
    documents: DataFrame,
    tokenizer_path: str,
    packing: Packing = Packing(),
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per piece: its document, place there, sequence and place there.

    ``padded_length`` is the sequence's length, filled to ``packing.length``
    unless it is a power of two. A null text is empty: its one token is the end
    id. Repeated rows are packed as often as they occur; null ids stay null. An
    empty table gives no rows. Other columns are ignored.
    """
    rows = documents.select(
        documents[id_column].cast("long").alias("doc_id"),
        documents[text_column].alias("text"),
    )

    @giving_back
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = piece_tokenizer(tokenizer_path)
        end = np.array([packing.end_id], np.uint32)
        next_sequence = TaskContext.get().partitionId() * _TASK_STEP
        ids: list[int | None] = []
        tokens: list[np.ndarray] = []
        held = 0
        for batch in batches:
            doc_ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            for first, last in slices(encoded(texts)[1]):
                whole = [t or "" for t in texts.slice(first, last - first).to_pylist()]
                for doc_id, found in zip(doc_ids[first:last], tokenizer.encode_long(whole)):
                    ids.append(doc_id)
                    tokens.append(np.concatenate((found, end)))
                    held += len(found) + 1
                if held >= packing.group_tokens:
                    made, used = _rows(ids, tokens, packing, next_sequence)
                    yield made
                    next_sequence += used
                    ids, tokens, held = [], [], 0
        if ids:
            yield _rows(ids, tokens, packing, next_sequence)[0]

    return rows.mapInArrow(packed, SCHEMA)


def _rows(
    ids: list[int | None], tokens: list[np.ndarray], packing: Packing, first_sequence: int
) -> tuple[pa.RecordBatch, int]:
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
    document, start, length, sequence, offset, sequences = place(lengths, packing)
    sums = [
        zlib.crc32(tokens[d][s : s + n].astype("<u4", copy=False))
        for d, s, n in zip(document.tolist(), start.tolist(), length.tolist())
    ]
    filled = np.bincount(sequence, weights=length, minlength=sequences).astype(np.int64)
    power = (filled & (filled - 1)) == 0
    padded = np.where(power, filled, packing.length)
    columns = [
        pa.array([ids[d] for d in document.tolist()], pa.int64()),
        pa.array(start),
        pa.array(length),
        pa.array(sums, pa.int64()),
        pa.array(lengths[document]),
        pa.array(sequence + first_sequence),
        pa.array(offset),
        pa.array(padded[sequence]),
    ]
    return pa.RecordBatch.from_arrays(columns, schema=_ARROW), sequences


def longest_piece(lengths: np.ndarray, packing: Packing) -> int:
    """The longest piece for documents of these lengths: a sequence, or so many times
    half of it until a sequence with such a piece costs at most ``slack`` times the
    mean of all sequences."""
    size, total = packing.length, int(lengths.sum())
    sequences = max(1, -(-total // size))
    cut = size
    while cut % 2 == 0 and cut // 2 >= packing.least_cut:
        whole = (lengths // cut).sum() * packing.cost(cut) + packing.cost(lengths % cut).sum()
        # The rest of its sequence holds tokens, of pieces that may be small.
        if packing.cost(cut) + packing.linear * (size - cut) <= packing.slack * whole / sequences:
            break
        cut //= 2
    return cut


def place(lengths: np.ndarray, packing: Packing) -> tuple[np.ndarray, ...]:
    """Pieces of documents of these lengths: document, start, length, sequence,
    offset; and the number of sequences, the least that hold all tokens."""
    size, cut = packing.length, longest_piece(lengths, packing)
    many = -(-lengths // cut)
    document = np.repeat(np.arange(len(lengths)), many)
    start = (np.arange(len(document)) - np.repeat(np.cumsum(many) - many, many)) * cut
    length = np.minimum(lengths[document] - start, cut)
    order = np.argsort(-length, kind="stable")
    opened = -(-int(lengths.sum()) // size)
    room = np.full(opened, size)
    cost = np.zeros(opened)
    put: list[tuple[int, int, int, int, int]] = []
    left: list[tuple[int, int, int]] = []

    def add(document: int, start: int, length: int, at: int) -> None:
        put.append((document, start, length, at, size - int(room[at])))
        room[at] -= length
        cost[at] += packing.cost(length)

    for d, s, n in zip(*(x[order].tolist() for x in (document, start, length))):
        at = int(np.where(room >= n, cost, np.inf).argmin())
        if room[at] >= n:
            add(d, s, n, at)
        else:
            left.append((d, s, n))
    gaps = np.argsort(-room, kind="stable").tolist()
    for d, s, n in left:
        while n:
            at = gaps[0]
            take = min(n, int(room[at]))
            if take:
                add(d, s, take, at)
                s, n = s + take, n - take
            if not room[at]:
                gaps.pop(0)
    return (*np.array(put, np.int64).reshape(-1, 5).T, opened)
