"""Prefix trie of conversations, from adaptive radix trees.

Every distinct turn (role, text) has an id of ``WIDTH`` bytes, the leading bytes of
a SHA-256, so a conversation is a byte string and a string's prefixes of whole ids
are the trie's nodes.

1. Equal conversations are brought together: one path with the ids of its members.
   Those of a path come in chunks of neighbouring ids, each bounded.
2. Paths are sorted over all partitions and cut into portions of bounded size, so
   the subtree of a common first turn is spread over many tasks. A portion knows
   how many turns its first path shares with the path before, its last with the one
   after: these say which of its nodes neighbours hold too.
3. A task builds a radix tree of each portion and walks it once, upwards. Byte depths
   that end a turn id emit a node; branches inside an id and compressed prefixes
   emit none or several. What is counted in a subtree is charged to the first portion
   that holds it, so counts of a node that several portions hold can be added up.
4. Only those few open nodes, prefixes of paths where portions meet, are shuffled:
   they are added up by a digest of their prefix, and nodes below them ask
   for their smallest member.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from acquaint.llm.radix import Inner, RadixTree, common
from acquaint.llm.shared import giving_back, written

#: Bytes of a turn's id.
WIDTH = 16

#: Bytes of paths in one radix tree, and one path more.
PORTION_BYTES = 1_000_000

#: Members of a path travel in chunks of ids that agree but for so many low bits.
CHUNK_BITS = 12

#: Conversations are rebuilt on the first one of so many.
FAMILY = 20
MOST_HEAD = 3

_NONE = hashlib.sha256(b"").hexdigest()


def sequences(conversations: DataFrame) -> DataFrame:
    """conv_id and turns: the id and words of each turn, in order.

    Turns are ordered by turn, null first; equal turns by role and then by the hash
    of their text, and repeated rows stay as often as they are there. A null role
    or text is empty. Rows without a conv_id belong to no conversation and are left
    out; other columns are ignored. A conversation is held as a whole, in some 60
    bytes a turn.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    named = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turn = F.col("turn").cast("long")
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            turn.isNotNull().alias("numbered"),
            F.coalesce(turn, F.lit(0)).alias("turn"),
            role.alias("role"),
            F.substring(F.sha2(named.cast("binary"), 256), 1, 2 * WIDTH).alias("id"),
            F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).alias("words"),
        ).alias("turn"),
    )
    ordered = F.sort_array(F.collect_list("turn"))
    return rows.groupBy("conv_id").agg(
        F.transform(ordered, lambda t: F.struct(t["id"].alias("id"), t["words"].alias("words"))).alias(
            "turns"
        )
    )


def rebuilt(whole: DataFrame) -> DataFrame:
    """Conversations whose first turns are those of the first of their family.

    Conversation c takes as many as h = crc32 of its decimal id, modulo 4, from
    c - c % 20, fewer if that has fewer and none if it is absent, and then its own
    turns after its first h.
    """
    family = F.col("conv_id") - F.col("conv_id") % FAMILY
    heads = whole.where(F.col("conv_id") % FAMILY == 0).select(
        F.col("conv_id").alias("family"), F.slice("turns", 1, MOST_HEAD).alias("head")
    )
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MOST_HEAD + 1)).cast("int")
    own = F.slice("turns", h + 1, F.greatest(F.size("turns"), F.lit(1)))
    head = F.coalesce(F.slice("head", F.lit(1), h), F.slice("turns", 1, 0))
    joined = whole.withColumn("family", family).join(heads, "family", "left")
    return joined.select("conv_id", F.concat(head, own).alias("turns"))


def prefix_nodes(whole: DataFrame) -> DataFrame:
    """One row for each distinct sequence of first turns, from conv_id and turns.

    conv_id is the smallest member, depth the number of turns, parent_conv_id that of
    the sequence without its last turn (null for the root). Members start with the
    sequence; n_convs counts them, n_children the nodes one turn longer, n_leaves
    the nodes without children in the subtree, this one included. saved_tokens adds
    up, over the subtree, the words of a node's last turn for every member but
    one. ends_sha256 is the SHA-256 of the ids of members that end here, in
    ascending order and joined by commas. Without conversations there are no nodes.
    """
    portions = written(_portions(_paths(whole)), "portions")
    nodes = written(
        portions.join(_edges(portions), ["part", "number"], "left").mapInArrow(_nodes, _NODE),
        "nodes",
    )
    shared = nodes.where(F.col("key").isNotNull())
    open_ = shared.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"),
        F.max("depth").alias("depth"),
        F.max("parent_key").alias("parent_key"),
        *[F.sum(c).alias(c) for c in _COUNTS],
        F.max("ends_sha256").alias("ends_sha256"),
    )
    open_ = written(open_, "open-nodes")
    parents = open_.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("open_parent"))
    rest = nodes.where(F.col("key").isNull())
    asking = rest.where(F.col("parent_key").isNotNull()).drop("key").unionByName(
        open_.withColumn("parent_conv_id", F.lit(None).cast("long")).drop("key")
    )
    asking = asking.join(parents, "parent_key", "left").withColumn("parent_conv_id", F.col("open_parent"))
    found = rest.where(F.col("parent_key").isNull()).drop("key", "parent_key").unionByName(
        asking.drop("parent_key", "open_parent")
    )
    return found.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_NONE))).select(
        "conv_id", "depth", "parent_conv_id", *_COUNTS, "ends_sha256"
    )


def _paths(whole: DataFrame) -> DataFrame:
    """path, words of its turns, chunk and members: ids in ascending order."""
    ids = F.transform("turns", lambda t: t["id"])
    rows = whole.select(
        F.unhex(F.array_join(ids, "")).alias("path"),
        F.transform("turns", lambda t: t["words"]).alias("words"),
        F.shiftright("conv_id", CHUNK_BITS).alias("chunk"),
        "conv_id",
    )
    return rows.groupBy("path", "chunk").agg(
        F.first("words").alias("words"), F.sort_array(F.collect_list("conv_id")).alias("members")
    )


_PORTION = (
    "part int, number int, before int, after int, first binary, last binary, paths binary,"
    " lengths binary, counts binary, least binary, ends binary, words binary"
)


@dataclass
class _Portion:
    """Distinct paths in order, with number, smallest and digest of their members."""

    number: int = 0
    before: int | None = None
    first: bytes | None = None
    size: int = 0
    paths: list[bytes] = field(default_factory=list)
    counts: list[int] = field(default_factory=list)
    least: list[int] = field(default_factory=list)
    ends: list[bytes] = field(default_factory=list)
    words: list[np.ndarray] = field(default_factory=list)

    def row(self, part: int, after: int | None) -> pa.RecordBatch:
        lengths = [len(p) for p in self.paths]
        columns = [
            pa.array([part], pa.int32()),
            pa.array([self.number], pa.int32()),
            pa.array([self.before], pa.int32()),
            pa.array([after], pa.int32()),
            pa.array([self.first], pa.binary()),
            pa.array([self.paths[-1] if after is None else None], pa.binary()),
            pa.array([b"".join(self.paths)], pa.binary()),
            *[
                pa.array([np.array(x, kind).tobytes()], pa.binary())
                for x, kind in ((lengths, "<i8"), (self.counts, "<i8"), (self.least, "<i8"))
            ],
            pa.array([b"".join(self.ends)], pa.binary()),
            pa.array([np.concatenate([np.zeros(0, "<i4"), *self.words]).tobytes()], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _PORTION.split(", ")])


def _portions(paths: DataFrame) -> DataFrame:
    """Sorted paths, cut into portions. ``before`` and ``after`` are the turns shared
    with the neighbouring paths; where those are in other tasks, the path is given."""

    @giving_back
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held, digest = _Portion(), None
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for row in batch.slice(at, 256).to_pylist():
                    path, members = row["path"], row["members"]
                    text = ",".join(map(str, members)).encode()
                    if held.paths and path == held.paths[-1]:
                        # A further chunk of the same path, of larger ids.
                        digest.update(b"," + text)
                        held.counts[-1] += len(members)
                        continue
                    if held.paths:
                        held.ends.append(digest.digest())
                        if held.size >= PORTION_BYTES:
                            shared = common(held.paths[-1], path) // WIDTH
                            yield held.row(part, shared)
                            held = _Portion(held.number + 1, shared)
                    if held.before is None and not held.paths:
                        held.first = path
                    digest = hashlib.sha256(text)
                    held.paths.append(path)
                    held.size += len(path) + WIDTH
                    held.counts.append(len(members))
                    held.least.append(members[0])
                    held.words.append(np.array(row["words"], "<i4"))
        if held.paths:
            held.ends.append(digest.digest())
            yield held.row(part, None)

    return (
        paths.repartitionByRange("path").sortWithinPartitions("path", "chunk").mapInArrow(cut, _PORTION)
    )


def _edges(portions: DataFrame) -> DataFrame:
    """part, number, shared_before and shared_after of portions that begin or end a
    partition: turns shared with the neighbouring partitions' paths, -1 if none."""
    # One row for each partition of the sorted paths.
    ends = portions.groupBy("part").agg(
        F.max("first").alias("first"), F.max("last").alias("last"), F.max("number").alias("final")
    )
    order = Window.orderBy("part")
    beside = ends.select(
        "part", "final", "first", "last",
        F.lag("last").over(order).alias("previous"),
        F.lead("first").over(order).alias("next"),
    )

    @giving_back
    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                before, after = _shared(row["previous"], row["first"]), _shared(row["last"], row["next"])
                only = row["final"] == 0
                found.append((row["part"], 0, before, after if only else None))
                if not only:
                    found.append((row["part"], row["final"], None, after))
            if found:
                names = ["part", "number", "shared_before", "shared_after"]
                columns = [pa.array(c, pa.int32()) for c in zip(*found)]
                yield pa.RecordBatch.from_arrays(columns, names)

    return beside.mapInArrow(edges, "part int, number int, shared_before int, shared_after int")


def _shared(a: bytes | None, b: bytes | None) -> int:
    """Whole turns that two paths share at their beginning; -1 if one is missing."""
    return -1 if a is None or b is None else common(a, b) // WIDTH


_COUNTS = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
_NODE = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long,"
    " n_leaves long, saved_tokens long, ends_sha256 string, key binary, parent_key binary"
)


@giving_back
def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of each portion; ``key`` of those that other portions hold too, and
    ``parent_key`` in place of parent_conv_id where that is so of the parent."""
    for batch in batches:
        for at in range(batch.num_rows):
            (row,) = batch.slice(at, 1).to_pylist()
            yield _portion_nodes(row)


def _portion_nodes(row: dict) -> pa.RecordBatch:
    lengths, counts, least = (np.frombuffer(row[c], "<i8").tolist() for c in ("lengths", "counts", "least"))
    words = np.frombuffer(row["words"], "<i4").tolist()
    tree, starts, turn_starts, at = RadixTree(), [], [], 0
    for number, length in enumerate(lengths):
        starts.append(at)
        turn_starts.append(at // WIDTH)
        tree.put(row["paths"][at : at + length], number)
        at += length
    before = row["shared_before"] if row["before"] is None else row["before"]
    after = row["shared_after"] if row["after"] is None else row["after"]
    final = len(lengths) - 1
    out: list[list] = [[] for _ in _NODE.split(", ")]
    parents, parent_keys = out[2], out[9]

    def key_of(number: int, depth: int) -> bytes:
        path = row["paths"][starts[number] : starts[number] + depth * WIDTH]
        return hashlib.blake2b(path, digest_size=16).digest()

    for walked in _upwards(tree.root):
        node, above, end, below = walked.node, walked.above, walked.end, walked.below
        own = node.value
        if own is not None:
            below.join(own, own, counts[own], least[own])
        for depth in range(end // WIDTH, above // WIDTH if above >= 0 else -1, -1):
            earlier = below.first == 0 and depth <= before
            later = below.last == final and depth <= after
            childless = not below.tops
            cost = words[turn_starts[below.first] + depth - 1] if depth else 0
            below.saved += (below.n - (not earlier)) * cost
            below.leaves += childless and not later
            ends_here = own is not None and depth * WIDTH == end
            key = key_of(below.first, depth) if earlier or later else None
            for child in below.tops:
                if key is None:
                    parents[child] = below.least
                else:
                    parent_keys[child] = key
            digest = row["ends"][32 * own : 32 * own + 32].hex() if ends_here else None
            values = (
                below.least, depth, None, below.n, below.children, below.leaves, below.saved,
                digest, key, None,
            )
            below.tops, below.children = [len(parents)], int(not earlier)
            for column, value in zip(out, values):
                column.append(value)
        walked.hand_up()
    kinds = [pa.int64()] * 7 + [pa.string(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(out, kinds)], [c.split()[0] for c in _NODE.split(", ")]
    )


class _Below:
    """What is known of a subtree: its first and last path, members, and the rows of
    its topmost nodes, which wait for their parent."""

    __slots__ = ("first", "last", "n", "least", "leaves", "saved", "children", "tops")

    def __init__(self) -> None:
        self.first = self.last = self.least = None
        self.n = self.leaves = self.saved = self.children = 0
        self.tops: list[int] = []

    def join(self, first: int, last: int, n: int, least: int) -> None:
        self.first = first if self.first is None else min(self.first, first)
        self.last = last if self.last is None else max(self.last, last)
        self.least = least if self.least is None else min(self.least, least)
        self.n += n


class _Step:
    __slots__ = ("node", "above", "end", "below", "parent")

    def __init__(self, node, above: int, begin: int, parent: _Step | None) -> None:
        self.node, self.above, self.parent = node, above, parent
        self.end, self.below = begin + len(node.prefix), _Below()

    def hand_up(self) -> None:
        if self.parent is None:
            return
        to, own = self.parent.below, self.below
        to.join(own.first, own.last, own.n, own.least)
        to.leaves += own.leaves
        to.saved += own.saved
        to.children += own.children
        if len(to.tops) < len(own.tops):
            to.tops, own.tops = own.tops, to.tops
        to.tops.extend(own.tops)


def _upwards(root: Inner) -> Iterator[_Step]:
    """All tree nodes, children before their parents, in the order of the keys.

    ``above`` is the byte depth at which the node's parent ends, -1 for the root;
    depths after it, up to ``end``, are the node's.
    """
    step = _Step(root, -1, 0, None)
    stack = [(step, root.in_order())]
    while stack:
        step, children = stack[-1]
        child = next(children, None)
        if child is None:
            stack.pop()
            yield step
        else:
            down = _Step(child, step.end, step.end + 1, step)
            stack.append((down, child.in_order()))
