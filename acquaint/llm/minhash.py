"""Near-duplicates by b-bit MinHash.

1. Every whole text becomes the set of its word shingles, as 64-bit hashes, and
   that set 112 minima. Of each minimum 4 low bits are packed into a signature;
   bands of 4 minima are hashed into bucket names.
2. Documents with equal sets are one class from here on; only its smallest
   doc_id goes on. Buckets with the same members count once.
3. Agreeing signature fields, counted by bit operations and corrected for chance
   agreement, estimate similarities. Where an estimate may reach the similarity
   asked for, and the sets are not too unlike in size, the full sets decide.
4. First each bucket's members are held against its smallest, which joins most of
   what belongs together, by at most one pair for a bucket and member. Then, in
   buckets whose members are still in several components, those outside the
   commonest are held against all.

Pairs do not leave the tasks but for those of the stars, and pairs of documents that
are joined already are not judged, so a group of n copies gives about n links, not
n * n. A bucket's members are cut into blocks, and a task holds one block of those
that ask against one block of those asked about.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acquaint.llm.components import connected, joined_labels
from acquaint.llm.shared import (
    CHUNK_BYTES,
    bitmap_bytes,
    bitmap_rows,
    bitmap_slots,
    encoded,
    giving_back,
    group_starts,
    slices,
    whole_groups,
    word_end,
    written,
)

BANDS, ROWS, BITS = 28, 4, 4
MINIMA = BANDS * ROWS

#: Similarity below which an estimate rules a pair out: five standard errors of
#: the estimate below the similarity asked for.
MARGIN = 0.2

#: Members of a bucket in a block, about; a task holds one block against another.
BLOCK = 512

#: Shingles of all members in a block, about, where they are long.
BLOCK_SHINGLES = 2_000_000

#: With fewer bits a node the bitmap lets too much pass.
SLOTS_PER_NODE = 4

_M = np.uint64(0xD6E8FEB86659FD93)
_P = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Similarity:
    """What counts as near: shingles of so many words, percent of the union shared."""

    words: int = 5
    percent: int = 80


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, applied to each number."""
    x = (x ^ (x >> np.uint64(32))) * _M
    x = (x ^ (x >> np.uint64(29))) * _P
    return x ^ (x >> np.uint64(32))


def _random(n: int, seed: int) -> np.ndarray:
    return mixed(np.arange(1, n + 1, dtype=np.uint64) * _P + np.uint64(seed)) | np.uint64(1)


_BYTE = _random(256, 1)
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_PLACE = _random(64, 2)
_MINIMUM = _random(MINIMA, 3)
_INVERSE = np.uint64(pow(int(_P), -1, 2**64))


def shingle_sets(texts: pa.Array, words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text.

    A text with fewer words than a shingle has its whole sequence as the only
    shingle; one without words, or null, has none.
    """
    flat, bounds = encoded(texts)
    if not len(flat):
        return [np.zeros(0, np.uint64)] * len(texts)
    hashes, of = word_hashes(flat, bounds)
    many = np.bincount(of, minlength=len(texts))
    last = np.cumsum(many)
    place = _PLACE[:words]
    full = np.zeros(max(0, len(hashes) - words + 1), np.uint64)
    for i in range(words if len(full) else 0):
        full += mixed(hashes[i : i + len(full)] * place[i])
    full = mixed(full)
    sets = []
    for n, end in zip(many.tolist(), last.tolist()):
        if n >= words:
            sets.append(np.unique(full[end - n : end - words + 1]))
        elif n:
            one = (mixed(hashes[end - n : end] * place[:n])).sum(dtype=np.uint64)
            sets.append(mixed(np.array([one + np.uint64(n)], np.uint64)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def word_hashes(flat: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word, in the order of the rows, and the word's row.

    The bytes pass in stretches that end between words, whatever a row's length.
    """
    hashes, owners = [], []
    begin = 0
    while begin < len(flat):
        end = word_end(flat, bounds, begin + CHUNK_BYTES, _SPACE)
        data = flat[begin:end]
        inside = ~_SPACE[data]
        edge = np.ones(len(data) + 1, bool)
        edge[1:-1] = inside[1:] != inside[:-1]
        edge[bounds[(bounds > begin) & (bounds < end)] - begin] = True
        edges = np.flatnonzero(edge)
        starts, ends = edges[:-1], edges[1:]
        word = inside[starts]
        starts, ends = starts[word], ends[word]
        # A word's hash is a polynomial in its bytes, from differences of running sums.
        power = np.cumprod(np.full(len(data), _P))
        back = np.cumprod(np.full(len(data), _INVERSE))
        running = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * power)))
        hashes.append(
            mixed((running[ends] - running[starts]) * back[starts] + (ends - starts).astype(np.uint64))
        )
        owners.append(np.searchsorted(bounds, begin + starts, side="right") - 1)
        begin = end
    return np.concatenate(hashes), np.concatenate(owners)


def minima(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of each of the hash functions over a set that is not empty."""
    least = np.full(MINIMA, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 4096):
        part = shingles[at : at + 4096]
        np.minimum(least, np.multiply.outer(_MINIMUM, part).min(axis=1), out=least)
    return least


def signature(least: np.ndarray) -> bytes:
    """The low bits of the mixed minima, two to a byte."""
    low = (mixed(least) & np.uint64(2**BITS - 1)).astype(np.uint8)
    return ((low[0::2] << BITS) | low[1::2]).tobytes()


def bucket_names(least: np.ndarray) -> np.ndarray:
    """A name for each band's minima."""
    rows = least.reshape(BANDS, ROWS) * _PLACE[:ROWS]
    names = mixed(mixed(rows).sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64) * _P)
    return names.astype(np.int64)


def estimate(agreeing: np.ndarray) -> np.ndarray:
    """Similarity from the number of agreeing fields, corrected for chance."""
    by_chance = 2.0**-BITS
    return (agreeing / MINIMA - by_chance) / (1 - by_chance)


def described(documents: DataFrame, near: Similarity) -> DataFrame:
    """doc_id, n_shingles, set hashes, signature, bucket names and the set itself."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    @giving_back
    def described_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ids = batch.column("text"), batch.column("doc_id")
            for first, last in slices(encoded(texts)[1]):
                sets = shingle_sets(texts.slice(first, last - first), near.words)
                least = [minima(s) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(first, last - first),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([int(s.sum(dtype=np.uint64).astype(np.int64)) for s in sets]),
                        pa.array([int(mixed(s).sum(dtype=np.uint64).astype(np.int64)) for s in sets]),
                        pa.array([None if m is None else signature(m) for m in least], pa.binary()),
                        pa.array(
                            [None if m is None else bucket_names(m) for m in least],
                            pa.list_(pa.int64()),
                        ),
                    ],
                    ["doc_id", "n_shingles", "set_1", "set_2", "signature", "buckets"],
                )

    return rows.mapInArrow(
        described_rows,
        "doc_id long, n_shingles long, set_1 long, set_2 long, signature binary,"
        " buckets array<long>",
    )


def near_duplicates(documents: DataFrame, near: Similarity = Similarity()) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row.

    Documents are linked if they share at least ``percent`` of the union of their
    shingles. ``component_id`` is the smallest doc_id that can be reached over
    links. Documents without words are linked with nothing. Rows that share a
    doc_id are one document with several texts: what one of them is linked with
    joins the component of all, and each row is kept if its id is the smallest.
    A null doc_id is in no component: component_id is null and kept true. An
    empty table gives no rows; other columns are ignored.
    """
    rows = written(described(documents, near), "described")
    known = rows.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    classes = written(
        known.groupBy("n_shingles", "set_1", "set_2").agg(
            F.min("doc_id").alias("node"),
            F.first("signature").alias("signature"),
            F.first("buckets").alias("buckets"),
        ),
        "classes",
    )
    members = written(_members(classes), "members")
    nodes = members.select("node").distinct()
    sets = written(_sets(documents, nodes, near), "sets")
    labels = _linked(members, sets, near)
    same = known.join(
        classes.select("n_shingles", "set_1", "set_2", "node"), ["n_shingles", "set_1", "set_2"]
    ).select("doc_id", "node")
    # A document whose id comes with several texts joins their classes.
    several = (
        same.groupBy("doc_id")
        .agg(F.min("node").alias("a"), F.max("node").alias("b"))
        .where(F.col("a") != F.col("b"))
    )
    if not several.isEmpty():
        edges = same.join(several, "doc_id").select(F.col("node").alias("a"), F.col("doc_id").alias("b"))
        labels = connected(
            edges.unionByName(labels.select(F.col("node").alias("a"), F.col("label").alias("b")))
        )
    with_node = rows.select("doc_id", "n_shingles", "set_1", "set_2").join(
        classes.select("n_shingles", "set_1", "set_2", "node"),
        ["n_shingles", "set_1", "set_2"],
        "left",
    )
    with_node = with_node.withColumn(
        "node", F.when(F.col("doc_id").isNotNull(), F.coalesce("node", "doc_id"))
    )
    component = F.least(F.coalesce("label", "node"), "doc_id")
    return with_node.join(labels, "node", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), component).alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def _members(classes: DataFrame) -> DataFrame:
    """bucket, node, signature and size in buckets with several members.

    Of buckets with the same members one is left.
    """
    named = classes.select("node", F.explode("buckets").alias("bucket"))
    buckets = (
        named.groupBy("bucket")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("node").alias("least"),
            F.sum(F.xxhash64("node").cast("decimal(20,0)")).alias("sum"),
            F.bit_xor(F.xxhash64("node", F.lit(1))).alias("xor"),
        )
        .where(F.col("n") > 1)
        .groupBy("n", "least", "sum", "xor")
        .agg(F.min("bucket").alias("bucket"))
        .select("bucket", "n", "least")
    )
    of_node = (
        named.join(buckets, "bucket")
        .groupBy("node")
        .agg(F.collect_list(F.struct("bucket", "n", "least")).alias("held"))
        .join(classes.select("node", "signature", "n_shingles"), "node")
    )
    return of_node.select(
        "node", "signature", "n_shingles", F.col("held.bucket").alias("buckets"), F.inline("held")
    )


def _sets(documents: DataFrame, nodes: DataFrame, near: Similarity) -> DataFrame:
    """The full sets of documents that share a bucket with another, and of few others.

    A bitmap of their hashes leaves most other documents out; sets that it lets
    pass by chance meet nothing later. Where it is too full for that, a join
    leaves them out.
    """
    nodes_there = nodes.count()
    slots = bitmap_slots(nodes_there)
    bitmap = bitmap_rows(nodes, F.col("node"), slots)
    sent = documents.sparkSession.sparkContext.broadcast(bitmap_bytes(bitmap, slots))
    node = F.col("doc_id").cast("long")
    rows = documents.select(
        node.alias("node"), F.pmod(F.xxhash64(node), F.lit(slots)).alias("slot"), "text"
    )

    @giving_back
    def whole_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = batch.column("slot").to_numpy()
            kept = (sent.value[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1
            batch = batch.filter(pa.array(kept.astype(bool)))
            texts, ids = batch.column("text"), batch.column("node")
            for first, last in slices(encoded(texts)[1]):
                sets = shingle_sets(texts.slice(first, last - first), near.words)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(first, last - first),
                        pa.array([s.astype(np.int64) for s in sets], pa.list_(pa.int64())),
                    ],
                    ["node", "shingles"],
                )

    sets = rows.mapInArrow(whole_sets, "node long, shingles array<long>")
    return sets if SLOTS_PER_NODE * nodes_there <= slots else sets.join(nodes, "node", "left_semi")


def _linked(members: DataFrame, sets: DataFrame, near: Similarity) -> DataFrame:
    """node and label (smallest node of its component) of all nodes in buckets."""
    labels = written(members.select("node").distinct().withColumn("label", F.col("node")), "labels")
    stars = written(_stars(members, near), "stars")
    labels = joined_labels(labels, written(_star_links(stars, sets, near), "star-links"))
    places = written(_places(members, labels), "places")
    likely = written(places.mapInArrow(_likely(near), "bucket long, tile long, node long"), "likely")
    rows = places.join(likely, ["bucket", "tile", "node"], "left_semi").join(sets, "node")
    links = (
        rows.select(*_PLACE_COLUMNS, "shingles")
        .repartition("bucket", "tile")
        .sortWithinPartitions("bucket", "tile", "asks", "node")
        .mapInArrow(_links(near), "a long, b long")
    )
    return joined_labels(labels, written(links, "links"))


def _most_unlike(near: Similarity) -> int:
    """Signature fields in which a pair may differ and still be judged."""
    wanted = near.percent / 100 - MARGIN
    return int(MINIMA * (1 - wanted) * (1 - 2.0**-BITS))


def _words(signatures: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Signatures as rows of 64-bit words."""
    rows = signatures.to_pylist()
    return np.frombuffer(b"".join(rows), np.uint64).reshape(len(rows), -1)


def _stars(members: DataFrame, near: Similarity) -> DataFrame:
    """Pairs (a, b) of a bucket's smallest node and another one that may be near."""
    pairs = members.where(F.col("node") != F.col("least")).select(
        F.col("least").alias("a"), F.col("node").alias("b"), "signature", "n_shingles"
    )
    centres = members.where(F.col("node") == F.col("least")).select(
        F.col("node").alias("a"), F.col("signature").alias("centre"), F.col("n_shingles").alias("of_centre")
    )
    pairs = pairs.dropDuplicates(["a", "b"]).join(centres.dropDuplicates(["a"]), "a")
    size, of_centre = F.col("n_shingles"), F.col("of_centre")
    pairs = pairs.where(100 * F.least(size, of_centre) >= near.percent * F.greatest(size, of_centre))
    most = _most_unlike(near)

    @giving_back
    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                one, other = (_words(batch.column(c)) for c in ("signature", "centre"))
                kept = pa.array(unlike_fields(one ^ other).sum(axis=1) <= most)
                yield batch.select(["a", "b"]).filter(kept)

    return pairs.mapInArrow(alike, "a long, b long")


def _star_links(stars: DataFrame, sets: DataFrame, near: Similarity) -> DataFrame:
    """The pairs that the full sets confirm.

    The set of a star's centre is followed by those of its nodes, in blocks; one set
    of each is held at a time.
    """
    blocks = stars.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    nodes = (
        stars.join(blocks, "a")
        .select("a", F.pmod(F.xxhash64("b"), F.col("blocks")).cast("int").alias("block"), F.col("b").alias("node"))
        .withColumn("centre", F.lit(False))
    )
    centres = blocks.select(
        "a",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.col("a").alias("node"),
        F.lit(True).alias("centre"),
    )

    @giving_back
    def confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, of = None, None
        for batch in batches:
            starred, nodes_, centre = (batch.column(c).to_pylist() for c in ("a", "node", "centre"))
            shingles = batch.column("shingles")
            a, b = [], []
            for at, (star, node, is_centre) in enumerate(zip(starred, nodes_, centre)):
                own = shingles[at].values.to_numpy()
                if is_centre:
                    held, of = own.copy(), star
                elif of == star and _near(held, own, near):
                    a.append(star)
                    b.append(node)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return (
        nodes.unionByName(centres)
        .join(sets, "node")
        .repartition("a", "block")
        .sortWithinPartitions("a", "block", F.desc("centre"), "node")
        .mapInArrow(confirmed, "a long, b long")
    )


_PLACE_COLUMNS = [
    "bucket", "tile", "node", "label", "signature", "n_shingles", "buckets", "asks", "outside",
]


def _places(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of buckets with several components, in tiles, sorted by them.

    All nodes are in one block of their bucket to be asked about. Those outside
    the bucket's commonest component also ask, in a block of their own. A tile is a
    block that asks and one that is asked about.
    """
    now = members.join(labels, "node")
    size = F.sum("n_shingles")
    common = (
        now.groupBy("bucket", "label")
        .agg(F.count(F.lit(1)).alias("k"), size.alias("n_shingles"))
        .groupBy("bucket")
        .agg(
            F.max(F.struct("k", (-F.col("label")).alias("minus"), "n_shingles")).alias("most"),
            F.count(F.lit(1)).alias("components"),
            F.sum("k").alias("all"),
            size.alias("all_shingles"),
        )
        .where(F.col("components") > 1)
        .select(
            "bucket",
            (-F.col("most.minus")).alias("commonest"),
            _block_count(F.col("all"), F.col("all_shingles")).alias("blocks"),
            _block_count(
                F.col("all") - F.col("most.k"), F.col("all_shingles") - F.col("most.n_shingles")
            ).alias("asking"),
        )
    )
    now = now.join(common, "bucket").withColumn("outside", F.col("label") != F.col("commonest"))
    block = F.pmod(F.xxhash64("node"), F.col("blocks"))
    asking = F.pmod(F.xxhash64("node", F.lit(1)), F.col("asking"))

    def over(n: str):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))

    asked = now.withColumn("other", over("asking")).withColumn(
        "tile", F.col("other") * F.col("blocks") + block
    )
    asks = now.where("outside").withColumn("other", over("blocks")).withColumn(
        "tile", asking * F.col("blocks") + F.col("other")
    )
    return (
        asked.withColumn("asks", F.lit(False))
        .unionByName(asks.withColumn("asks", F.lit(True)))
        .select(*_PLACE_COLUMNS)
        .repartition("bucket", "tile")
        .sortWithinPartitions("bucket", "tile", "asks", "node")
    )


def _block_count(members: Column, shingles: Column) -> Column:
    return F.ceil(F.greatest(members / BLOCK, shingles / BLOCK_SHINGLES)).cast("long")


def _likely_pairs(table: pa.Table, near: Similarity) -> Iterator[list[tuple[int, int]]]:
    """Rows that ask and rows asked about, of groups of (bucket, tile), if their
    estimate may be right and they are in different components.

    Of two nodes that both ask the larger one asks about the smaller. Documents
    that share several buckets are a pair in the first of them.
    """
    most_unlike = _most_unlike(near)
    starts = [*group_starts(table, ("bucket", "tile")).tolist(), table.num_rows]
    node, label, asks, outside, size = (
        table.column(c).to_numpy() for c in ("node", "label", "asks", "outside", "n_shingles")
    )
    words = _words(table.column("signature"))
    held = [frozenset(x) for x in table.column("buckets").to_pylist()]
    for first, last in zip(starts, starts[1:]):
        here = table.column("bucket")[first].as_py()
        split = first + int(np.count_nonzero(~asks[first:last]))
        base = slice(first, split)
        for at in range(split, last if split > first else split, 256):
            ask = slice(at, min(at + 256, last))
            likely = differing(words[ask], words[base]) <= most_unlike
            likely &= label[ask, None] != label[None, base]
            likely &= ~outside[None, base] | (node[None, base] < node[ask, None])
            likely &= 100 * np.minimum(size[ask, None], size[None, base]) >= near.percent * np.maximum(
                size[ask, None], size[None, base]
            )
            i, j = (x.tolist() for x in np.nonzero(likely))
            pairs = [(at + x, first + y) for x, y in zip(i, j)]
            pairs = [(x, y) for x, y in pairs if min(held[x] & held[y]) == here]
            if pairs:
                yield pairs


def _likely(near: Similarity):
    @giving_back
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ("bucket", "tile")):
            involved = np.zeros(table.num_rows, bool)
            for pairs in _likely_pairs(table, near):
                involved[np.unique(np.array(pairs))] = True
            rows = table.select(["bucket", "tile", "node"]).filter(pa.array(involved))
            yield from rows.to_batches()

    return found


def _links(near: Similarity):
    """Links that the full sets confirm, no more than join what is linked here."""

    @giving_back
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ("bucket", "tile")):
            node = table.column("node").to_numpy()
            key = list(zip(*(table.column(c).to_pylist() for c in ("bucket", "tile", "label"))))
            shingles = table.column("shingles").combine_chunks()
            ends = shingles.offsets.to_numpy()
            values = shingles.values.to_numpy()
            joined: dict[tuple[int, int, int], tuple[int, int, int]] = {}

            def root(of: tuple[int, int, int]) -> tuple[int, int, int]:
                while (up := joined.get(of, of)) != of:
                    joined[of] = joined.get(up, up)
                    of = up
                return of

            links = []
            for pairs in _likely_pairs(table, near):
                for x, y in pairs:
                    one, other = root(key[x]), root(key[y])
                    if one == other:
                        continue
                    if _near(values[ends[x] : ends[x + 1]], values[ends[y] : ends[y + 1]], near):
                        joined[one] = other
                        links.append((int(node[x]), int(node[y])))
            if links:
                a, b = zip(*links)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return found


def _near(a: np.ndarray, b: np.ndarray, near: Similarity) -> bool:
    """Whether two sorted sets share enough of their union."""
    if 100 * min(len(a), len(b)) < near.percent * max(len(a), len(b)):
        return False
    both = np.concatenate((a, b))
    both.sort(kind="stable")
    shared = int(np.count_nonzero(both[1:] == both[:-1]))
    return 100 * shared >= near.percent * (len(a) + len(b) - shared)


def unlike_fields(x: np.ndarray) -> np.ndarray:
    """Number of fields in each word that are not all zero."""
    x = x | (x >> np.uint64(1))
    x |= x >> np.uint64(2)
    return np.bitwise_count(x & np.uint64(0x1111111111111111))


def differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of fields in which each signature of a differs from each of b."""
    total = np.zeros((len(a), len(b)), np.int32)
    for word in range(a.shape[1]):
        total += unlike_fields(a[:, word, None] ^ b[None, :, word])
    return total
