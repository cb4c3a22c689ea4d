"""Document fingerprints: Merkle trees over paragraphs and sections.

A text is cut into paragraphs at line ends and these into pieces of a few bytes at
places that a hash of the bytes before them picks, in any script and without any
marks: wherever the text is the same the cuts are the same. Pieces are the leaves. A paragraph's node is the hash of its leaves, a section's that of its
paragraphs; a section ends with an empty line or a paragraph whose hash says so.
The root over the sections is the fingerprint. Equal roots mean equal texts;
where roots differ, the branches that differ locate the edits.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acquaint.llm.shared import giving_back, parts, pieces_of

#: A piece ends where the hash of the 4 bytes SPAN places back is the smallest since.
#: A text that repeats itself has such a place in each period. SPAN is a power of 2.
SPAN = 8

#: Bytes of a piece: fewer only at line ends and the text's end, never more.
SMALLEST, LARGEST = 4, 32

#: Stands for a null doc_id, after all others in descending order.
NULL_ID = -(2**63)

#: Ranges of doc_ids and texts for each shuffle partition, and sampled places for each.
RANGES_PER_PARTITION, PLACES_PER_RANGE = 4, 50

FINGERPRINTS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string,"
    " edited_fingerprint string, near_edited double, near_next double,"
    " sections long, paragraphs long, edit_starts long"
)


@dataclass(frozen=True)
class Tree:
    """Hashes of leaves, their sizes in bytes, nodes with their first leaf, root."""

    leaves: list[bytes]
    sizes: list[int]
    paragraphs: list[tuple[bytes, int]]
    sections: list[tuple[bytes, int]]
    root: str


def pieces(text: bytes) -> list[bytes]:
    """The leaves' bytes; joined they are the text."""
    ends = _ends(text)
    return [text[start:end] for start, end in zip([0, *ends], ends)]


def _ends(text: bytes) -> list[int]:
    """Where the leaves end; characters of UTF-8 are not cut.

    An end depends on the bytes before it only, so an edit moves none before it.
    """
    size = len(text)
    data = np.frombuffer(text, np.uint8)
    mixed = np.ndarray(size, "<u4", b"\0\0\0" + text, strides=(1,)) * np.uint32(0x9E3779B1)
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(0x85EBCA6B)
    least, span = mixed, 1
    while span < SPAN:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    allowed = np.zeros(size + 1, bool)
    allowed[SPAN:] = mixed[: len(least)] == least
    within = np.zeros(size + 1, bool)
    within[:size] = data & 0xC0 == 0x80
    for _ in range(3):  # on to the end of the character
        allowed[1:] |= allowed[:-1] & within[:-1]
    allowed &= ~within
    lines = np.zeros(size + 1, bool)
    lines[1:] = data == 10
    found: list[int] = []
    start = 0
    at = np.flatnonzero(allowed | lines)
    for end, line in zip([*at.tolist(), size], [*lines[at].tolist(), True]):
        while end - start > LARGEST:
            start += LARGEST
            start -= next((n for n in range(4) if not within[start - n]), 0)
            found.append(start)
        if end - start >= SMALLEST or (line and end > start):
            found.append(end)
            start = end
    return found


def _node(kind: bytes, children: Iterable[bytes]) -> bytes:
    return xxhash.xxh3_128_digest(kind + b"".join(children))


def tree(text: bytes) -> Tree:
    found = pieces(text)
    leaves = list(map(xxhash.xxh3_128_digest, found))
    paragraphs: list[tuple[bytes, int]] = []
    sections: list[tuple[bytes, int]] = []
    first, section = 0, 0
    for at, piece in enumerate(found, 1):
        if piece[-1] == 10 or at == len(found):
            node = _node(b"p", leaves[first:at])
            paragraphs.append((node, first))
            if piece == b"\n" or node[0] < 32 or at == len(found):
                inside = [n for n, _ in paragraphs[section:]]
                sections.append((_node(b"s", inside), section))
                section = len(paragraphs)
            first = at
    root = hashlib.blake2b(b"r" + b"".join(n for n, _ in sections), digest_size=16)
    return Tree(leaves, list(map(len, found)), paragraphs, sections, root.hexdigest())


def likeness(a: Tree, b: Tree) -> float:
    """Bytes in branches that both have, in share of all their bytes; 1 if equal.

    Goes down both trees: sections that both have are shared whole, then paragraphs
    of the other sections, then leaves of the other paragraphs.
    """
    if a.root == b.root:
        return 1.0
    ours, theirs, same = _apart(_branches(a.sections, a), _branches(b.sections, b))
    ours, theirs, more = _apart(_inside(a, ours), _inside(b, theirs))
    shared = sum(sum(b.sizes[first:last]) for _, first, last in same + more)
    held = Counter(leaf for _, first, last in ours for leaf in a.leaves[first:last])
    for _, first, last in theirs:
        for leaf, size in zip(b.leaves[first:last], b.sizes[first:last]):
            if held.get(leaf, 0):
                held[leaf] -= 1
                shared += size
    return 2 * shared / (sum(a.sizes) + sum(b.sizes))


#: A hash, and the leaves below it, from and to.
Branch = tuple[bytes, int, int]


def _branches(sections: list[tuple[bytes, int]], of: Tree) -> list[Branch]:
    begins = [of.paragraphs[first][1] for _, first in sections]
    return [
        (node, begin, end) for (node, _), begin, end in zip(sections, begins, [*begins[1:], len(of.leaves)])
    ]


def _inside(of: Tree, sections: list[Branch]) -> list[Branch]:
    """The paragraphs of sections."""
    begins = [first for _, first in of.paragraphs]
    found = []
    for _, first, last in sections:
        at = bisect_left(begins, first)
        while at < len(begins) and begins[at] < last:
            end = begins[at + 1] if at + 1 < len(begins) else len(of.leaves)
            found.append((of.paragraphs[at][0], begins[at], end))
            at += 1
    return found


def _apart(ours: list[Branch], theirs: list[Branch]) -> tuple[list[Branch], list[Branch], list[Branch]]:
    """Branches that only one side has, and those of theirs that both have, each as
    often as both have it."""
    there = Counter(node for node, _, _ in theirs)
    here = Counter(node for node, _, _ in ours)
    left = []
    for branch in ours:
        if there[branch[0]] > 0:
            there[branch[0]] -= 1
        else:
            left.append(branch)
    others, same = [], []
    for branch in theirs:
        if here[branch[0]] > 0:
            here[branch[0]] -= 1
            same.append(branch)
        else:
            others.append(branch)
    return left, others, same


def first_difference(a: Tree, b: Tree) -> int | None:
    """Byte at which the first leaf begins that differs; None if the roots agree.

    Goes down the first section and the first paragraph that differ.
    """
    if a.root == b.root:
        return None

    def split(x: list, y: list) -> int:
        n = min(len(x), len(y))
        return next((i for i in range(n) if x[i][0] != y[i][0]), n)

    section = split(a.sections, b.sections)
    paragraph = a.sections[section][1] if section < len(a.sections) else len(a.paragraphs)
    paragraph += split(a.paragraphs[paragraph:], b.paragraphs[paragraph:])
    leaf = a.paragraphs[paragraph][1] if paragraph < len(a.paragraphs) else len(a.leaves)
    while leaf < min(len(a.leaves), len(b.leaves)) and a.leaves[leaf] == b.leaves[leaf]:
        leaf += 1
    return sum(a.sizes[:leaf])


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by as much of the following one."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def fingerprints(documents: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how like they are.

    The document that follows is the next one by descending doc_id, nulls last,
    after the last the first. Rows that share an id follow in the order of a hash
    of their text. A null text is empty; two empty texts are wholly alike. A
    document alone follows itself. ``edit_starts`` is the byte at which the trees
    locate the first difference to the edited text, null if there is none. An
    empty table gives no rows; other columns are ignored.
    """
    given = documents.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("id"),
        F.xxhash64("text").alias("mixed"),
        "text",
    )
    firsts = _range_firsts(given.select("id", "mixed"))
    if not firsts:
        return given.sparkSession.createDataFrame([], FINGERPRINTS)
    return (
        given.mapInArrow(
            _dealt(firsts), "range int, ahead boolean, id long, mixed long, size long, packed binary"
        )
        .repartition("range")
        .sortWithinPartitions("range", "ahead", F.desc("id"), "mixed")
        .mapInArrow(_followed, FINGERPRINTS)
    )


def _range_firsts(rows: DataFrame) -> list[tuple[int, int]]:
    """The first place of each range: ids in descending order, hashes of text within.

    All but the last occur in the table; they are negated ids, so that places ascend.
    Their number follows the shuffle partitions; they are picked from a sample of
    as many different places times PLACES_PER_RANGE, so an id that many rows share
    is cut by their texts.
    """
    ranges = RANGES_PER_PARTITION * parts(rows.sparkSession)
    there = rows.agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct((-F.col("id").cast("decimal(20,0)")).alias("a"), "mixed"))
    ).first()
    if not there["n"]:
        return []
    share = min(1.0, ranges * PLACES_PER_RANGE / there["n"])
    drawn = F.pmod(F.xxhash64("id", "mixed"), F.lit(1_000_000_007)) <= F.lit(int(share * 1_000_000_007))
    # Equal rows count once, so the sample is bounded whatever is drawn.
    sample = sorted((-r["id"], r["mixed"]) for r in rows.where(drawn).distinct().collect())
    step = max(1, len(sample) // ranges)
    least = (int(there[1]["a"]), there[1]["mixed"])
    return sorted({least, *sample[::step]})


def _dealt(firsts: list[tuple[int, int]]):
    """Rows with the number of their range; the first of a range also goes to the
    range before, to be the document that follows there."""
    ranges = len(firsts)

    @giving_back
    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches):
            places = [
                (-id_, mixed)
                for id_, mixed in zip(*(batch.column(c).to_pylist() for c in ("id", "mixed")))
            ]
            at = np.array([bisect_right(firsts, place) - 1 for place in places], np.int64)
            first = np.array([n for n, place in enumerate(places) if firsts[at[n]] == place], np.int64)
            texts = [(t or "").encode() for t in batch.column("text").to_pylist()]
            columns = [
                pa.array(at, pa.int32()),
                pa.array(np.zeros(len(at), bool)),
                batch.column("id"),
                batch.column("mixed"),
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array([pa.compress(t, "zstd", asbytes=True) for t in texts], pa.binary()),
            ]
            names = ["range", "ahead", "id", "mixed", "size", "packed"]
            rows = pa.RecordBatch.from_arrays(columns, names)
            yield rows
            again = rows.take(pa.array(first))
            before = (at[first] - 1) % ranges
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(before, pa.int32()),
                    pa.array(np.ones(len(first), bool)),
                    *again.columns[2:],
                ],
                names,
            )

    return dealt


@giving_back
def _followed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row with the one after it; one document is held at a time."""
    held: tuple[int, int, str, Tree] | None = None
    for batch in pieces_of(batches, 128):
        out = []
        columns = (batch.column(c).to_pylist() for c in ("range", "ahead", "id", "size", "packed"))
        for number, ahead, id_, size, packed in zip(*columns):
            if ahead and (held is None or held[0] != number):
                continue  # another row of the id that follows
            text = pa.decompress(packed, size, "zstd", asbytes=True)
            now = (number, id_, text.decode(), tree(text))
            if held is not None:
                out.append(_compared(held, now))
            held = None if ahead else now
        if out:
            yield pa.RecordBatch.from_pylist(out, _ARROW)


_ARROW = pa.schema(
    [
        (name, {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}[kind])
        for name, kind in (column.split() for column in FINGERPRINTS.split(","))
    ]
)


def _compared(one: tuple[int, int, str, Tree], following: tuple[int, int, str, Tree]) -> dict:
    _, id_, text, own = one
    changed = edited(text, following[2]).encode()
    other = tree(changed)
    return {
        "doc_id": None if id_ == NULL_ID else id_,
        "n_chars": len(text),
        "edited_sha256": hashlib.sha256(changed).hexdigest(),
        "fingerprint": own.root,
        "edited_fingerprint": other.root,
        "near_edited": likeness(own, other),
        "near_next": likeness(own, following[3]),
        "sections": len(own.sections),
        "paragraphs": len(own.paragraphs),
        "edit_starts": first_difference(own, other),
    }
