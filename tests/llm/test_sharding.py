from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pytest

from acquaint.llm.sharding import combine, difference, shard_documents
from tests.llm.data import documents, hard_rows, prose


def check(spark, rows, shards, cells=None):
    found = shard_documents(documents(spark, rows), shards, cells).collect()
    wanted = sorted((str(d), len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t, *_ in rows)
    assert sorted((str(r.doc_id), r["size"], r.text_crc32) for r in found) == wanted
    slots, copies, sizes = defaultdict(list), defaultdict(set), np.zeros(shards)
    for r in found:
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
        copies[r.text_crc32, r["size"]].add(r.shard)
        sizes[r.shard] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in copies.values())
    return sizes


def test_hard_rows(spark):
    check(spark, hard_rows(), 4)
    assert shard_documents(documents(spark, []), 4).collect() == []


@pytest.mark.parametrize("cells", [1, 3, None])
def test_bytes_are_near_equal(spark, cells):
    rows = [(i, prose(i, 5 + i % 60)) for i in range(600)]
    rows += [(1000 + i, rows[0][1]) for i in range(30)] + [(2000, prose(1, 1500))]
    sizes = check(spark, rows, 5, cells)
    assert sizes.max() - sizes.min() < 0.01 * sizes.mean()


def test_differencing_beats_filling_the_emptiest():
    draw = np.random.default_rng(2)
    sizes = draw.integers(1, 10**6, 300)
    found = difference(sizes, 7)
    sums = np.bincount(found.parts, weights=sizes, minlength=7)
    assert sums.tolist() == found.sums.tolist()
    greedy = np.zeros(7)
    for size in sorted(sizes, reverse=True):
        greedy[greedy.argmin()] += size
    assert np.ptp(sums) < np.ptp(greedy)


def test_partial_partitions_combine():
    draw = np.random.default_rng(3)
    chunks = [draw.integers(1, 1000, n) for n in (1, 5, 40)]
    partials = [difference(c, 4) for c in chunks]
    labels = combine(partials)
    sums = np.zeros(4)
    for chunk, partial, label in zip(chunks, partials, labels):
        assert sorted(label) == [0, 1, 2, 3]
        sums += np.bincount(label[partial.parts], weights=chunk, minlength=4)
    assert sums.sum() == sum(c.sum() for c in chunks) and np.ptp(sums) < 1000


def test_rows_equal_in_all_columns_are_dealt_over_blocks(spark):
    rows = [(None, "the same text")] * 4000 + [(n, prose(n, 20)) for n in range(200)]
    check(spark, rows, 3)
