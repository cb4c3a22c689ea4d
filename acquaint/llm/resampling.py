"""Importance resampling of documents towards a target distribution.

Features are runs of one to three consecutive words; a feature's bucket is the
CRC-32 of its bytes. No feature's bytes are put together for that:

1. A stretch of text, in one case and with one delimiter, gives its distinct words.
   Each becomes an entry ``" word "`` of an Aho-Corasick automaton, with the word's
   number, which leads to its payload: CRC and length.
2. One scan of the stretch emits the payloads of all words, in order.
3. CRCs of neighbouring payloads are composed: that of ``A + B`` is the CRC of A,
   moved on by the length of B, xor that of B. Moving on is linear over bits, so it
   is four table lookups for all words at once.

A stretch ends where a word ends and hands its last two payloads to the next, so a
text of any length passes in stretches of bounded size. Buckets are counted in
each task and added up; the gains, one number a bucket, go back to the tasks, where
a second scan scores the documents.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acquaint.llm.shared import encoded, giving_back, word_end, written

#: Bytes of text in one stretch, and what it takes to end its last word. Automata of so
#: few words stay in the caches.
STRETCH_BYTES = 100_000

#: Documents with fewer words are not drawn.
LEAST_WORDS = 20

_SPACE = 32

#: A-Z in lower case; bytes that are in no word become the delimiter.
_PLAIN = np.full(256, _SPACE, np.uint8)
for _byte in (*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)):
    _PLAIN[_byte] = _byte
_PLAIN[0x41:0x5B] = np.arange(0x61, 0x7B)
_APART = _PLAIN == _SPACE


@dataclass(frozen=True)
class Resampling:
    """Buckets, the draw's seed, and how many of a hundred documents are drawn."""

    buckets: int = 10_000
    seed: int = 42
    percent: int = 5


def _moved_tables(most: int) -> tuple[np.ndarray, np.ndarray]:
    """Tables that move a CRC on by 0 to most - 1 bytes, and by 2 ** k bytes.

    A table has 256 entries for each of a CRC's four bytes.
    """
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(0xEDB88320), step >> 1).astype(np.uint32)
    own = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32)[:, None])
    few = [own]
    for _ in range(most - 1):
        few.append((few[-1] >> 8) ^ step[few[-1] & 255])
    doubled = [few[1]]
    for _ in range(31):
        doubled.append(_through(doubled[-1], doubled[-1]))
    return np.array(few), np.array(doubled)


def _through(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    out = table[0][crc & 255]
    for byte in range(1, 4):
        out = out ^ table[byte][(crc >> np.uint32(8 * byte)) & 255]
    return out


_FEW, _DOUBLED = _moved_tables(64)


def moved_on(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRCs after so many further bytes, before those bytes' own CRC is added."""
    few = np.minimum(length, len(_FEW) - 1)
    out = _FEW[few, 0, crc & 255]
    for byte in range(1, 4):
        out = out ^ _FEW[few, byte, (crc >> np.uint32(8 * byte)) & 255]
    long = np.flatnonzero(length >= len(_FEW))
    if len(long):
        value, left = crc[long], length[long]
        for k in range(int(left.max()).bit_length()):
            at = np.flatnonzero((left >> k) & 1)
            value[at] = _through(_DOUBLED[k], value[at])
        out[long] = value
    return out


def payloads(plain: str) -> tuple[np.ndarray, np.ndarray]:
    """CRC and length of every word of a text in one case with spaces around words."""
    words = set(plain.split(" "))
    words.discard("")
    if not words:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    dictionary = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    crcs, lengths = [], []
    for number, word in enumerate(words):
        dictionary.add_word(f" {word} ", number)
        data = word.encode()
        crcs.append(zlib.crc32(data))
        lengths.append(len(data))
    dictionary.make_automaton()
    found = np.array([number for _, number in dictionary.iter(plain)], np.int64)
    return np.array(crcs, np.uint32)[found], np.array(lengths, np.int64)[found]


def features(texts: pa.Array, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Row and bucket of all features, and the row of every word, a stretch at a time."""
    flat, bounds = encoded(texts)
    space = zlib.crc32(b" ")
    # Row, CRC and length of the two words before.
    rows, crcs, lengths = np.zeros(0, np.int64), np.zeros(0, np.uint32), np.zeros(0, np.int64)
    begin = 0
    while begin < len(flat):
        end = word_end(flat, bounds, begin + STRETCH_BYTES, _APART)
        plain = _PLAIN[flat[begin:end]]
        inside = plain != _SPACE
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        ends = bounds[(bounds > begin) & (bounds < end)] - begin
        first[ends] = inside[ends]
        new = np.searchsorted(bounds, begin + np.flatnonzero(first), side="right") - 1
        apart = np.insert(plain, ends, _SPACE).tobytes().decode()
        crc, length = payloads(f" {apart} ")
        held = len(rows)
        rows, crcs, lengths = (
            np.concatenate(x) for x in ((rows, new), (crcs, crc), (lengths, length))
        )
        found, owners = [crcs[held:]], [new]
        # " word", so that a composed feature has its delimiter.
        spaced = moved_on(np.full(len(crcs), space, np.uint32), lengths) ^ crcs
        composed = crcs
        for more in (1, 2):
            composed = moved_on(composed[: len(crcs) - more], lengths[more:] + 1) ^ spaced[more:]
            last = np.arange(more, len(rows))
            whole = (last >= held) & (rows[last] == rows[last - more])
            found.append(composed[whole])
            owners.append(rows[last[whole]])
        bucket = np.concatenate(found) % np.uint32(buckets)
        yield np.concatenate(owners), bucket.astype(np.int64), new
        rows, crcs, lengths = rows[-2:], crcs[-2:], lengths[-2:]
        begin = end


def bucket_counts(rows: DataFrame, buckets: int) -> DataFrame:
    """bucket and n, of all features of all texts; buckets without any are left out."""

    @giving_back
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, bucket, _ in features(batch.column("text"), buckets):
                total += np.bincount(bucket, minlength=buckets)
        (there,) = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], ["bucket", "n"])

    sums = rows.select("text").mapInArrow(counted, "bucket long, n long")
    return sums.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(documents: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """How much more a bucket is used by the target, as a whole number for each bucket."""
    counts = []
    for rows in (documents, target):
        n = np.zeros(buckets, np.int64)
        # At most one row for each bucket.
        for bucket, many in bucket_counts(rows, buckets).collect():
            n[bucket] = many
        counts.append(n.astype(float))
    s, t = counts
    ratio = (t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weighed(documents: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features and weight, the sum of the gains, of every row."""
    sent = documents.sparkSession.sparkContext.broadcast(gain)

    @giving_back
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            words, many, weight = (np.zeros(n, np.int64) for _ in range(3))
            for row, bucket, of_word in features(batch.column("text"), len(sent.value)):
                words += np.bincount(of_word, minlength=n)
                many += np.bincount(row, minlength=n)
                # Sums of whole numbers, exact in doubles.
                weight += np.bincount(row, sent.value[bucket], n).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *map(pa.array, (words, many, weight))],
                ["doc_id", "n_words", "n_features", "weight"],
            )

    found = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return found.mapInArrow(rows, "doc_id long, n_words long, n_features long, weight long")


def resample(documents: DataFrame, target: DataFrame, how: Resampling = Resampling()) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank of every document.

    ``score`` is the weight plus Gumbel noise that depends on the doc_id alone, and
    the drawn documents are ranked from 1 by it; others have no rank. Of equal scores
    the smaller doc_id comes first, null ids last; equal rows come one after
    the other. A null text has no words, a null doc_id has the noise of an empty
    one. Empty tables give no rows, an empty target only shifts the weights.
    Other columns are ignored.
    """
    weighed_ = weighed(documents, gains(documents, target, how.buckets))
    scored = written(
        weighed_.withColumn("score", F.col("weight") + _noise(how.seed)).withColumn(
            "row", F.monotonically_increasing_id()
        ),
        "scored",
    )
    eligible = scored.where(F.col("n_words") >= LEAST_WORDS)
    drawn = eligible.count() * how.percent // 100
    rank = F.when(F.col("place") <= drawn, F.col("place"))
    ranked = numbered(eligible, F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row"))
    others = scored.where(F.col("n_words") < LEAST_WORDS).withColumn("rank", F.lit(None).cast("long"))
    return (
        ranked.withColumn("rank", rank)
        .drop("place")
        .unionByName(others)
        .select("doc_id", "n_words", "n_features", "weight", "score", "rank")
    )


def _noise(seed: int) -> Column:
    id_ = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), id_).cast("binary"), 256), 1, 8)
    share = (F.conv(digits, 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-1000 * F.log(-F.log(share))).cast("long")


def numbered(rows: DataFrame, *order: Column) -> DataFrame:
    """The rows with ``place``, their number from 1 in a global order.

    Rows are sorted by ranges. Each is numbered within its partition; what is before a
    partition comes from the counts, one row a partition.
    """
    sorted_ = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    sorted_ = written(sorted_.withColumn("at", F.monotonically_increasing_id()), "sorted")
    part, within = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = sorted_.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    offsets = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    placed = sorted_.withColumn("part", part).join(offsets, "part")
    return placed.withColumn("place", F.col("offset") + within + 1).drop("part", "offset", "at")
