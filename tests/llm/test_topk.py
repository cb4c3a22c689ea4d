from __future__ import annotations

import math
import random

import pytest

from acquaint.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int, block string, dim string, low string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", "x", "x") for i, v in rows], SCHEMA)


def brute(spark, rows, k, every):
    """From the float values that Spark holds."""
    held = [(r.vec_id, r.embedding) for r in frame(spark, rows).collect()]
    usable = [
        (i, [math.floor(64 * x) for x in v])
        for i, v in held
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    queries = {}
    for i, v in usable:
        if i % every == 0:
            queries[i] = min(v, queries.get(i, v))
    found = []
    for q, v in queries.items():
        scored = sorted(
            (-sum(a * b for a, b in zip(v, w)), i) for i, w in usable if i != q and len(v) == len(w)
        )
        found += [(q, n, i, -s) for n, (s, i) in enumerate(scored[:k], 1)]
    return sorted(found)


def check(spark, rows, k=5, every=3):
    found = topk.top_k(frame(spark, rows), lambda i: i % every == 0, k).collect()
    assert sorted(map(tuple, found)) == brute(spark, rows, k, every)


def vectors(seed, n, dim, values=None):
    draw = random.Random(seed)
    pick = (lambda: draw.choice(values)) if values else (lambda: draw.uniform(-1, 1))
    return [(i, [pick() for _ in range(dim)]) for i in range(n)]


@pytest.mark.parametrize("seed", range(2))
def test_random_vectors(spark, seed):
    check(spark, vectors(seed, 120, 6), k=7)


def test_many_ties(spark):
    rows = vectors(1, 90, 3, values=[0.0, 1.0])
    check(spark, rows + [(i + 200, rows[0][1]) for i in range(50)])


def test_several_blocks_and_large_values(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 7)
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 11)
    check(spark, vectors(2, 80, 4))
    check(spark, [(i, [x * 40_000 for x in v]) for i, v in vectors(3, 40, 4)])


def test_hard_rows(spark):
    rows = vectors(4, 20, 4) + vectors(5, 9, 2)
    rows += [(30, None), (33, [1.0, None, 0.0, 0.0]), (36, [math.nan] * 4), (39, [math.inf, 0.0, 0.0, 0.0])]
    rows += [(None, [0.0] * 4), (42, []), (45, []), (6, [0.5] * 4), (6, [0.5] * 4), (48, [1.0] * 3)]
    check(spark, rows)
    check(spark, rows, k=100)


def test_empty_table(spark):
    assert topk.top_k(frame(spark, []), lambda i: i % 3 == 0).collect() == []
    assert topk.top_k(frame(spark, [(1, [1.0])]), lambda i: i % 3 == 0).collect() == []


def test_scores_one_below_the_edge_of_a_bin(spark):
    """Reach 12,500,001; the best score less the lowest is 2**24 + 2**20 - 1."""
    rows = [(0, [2500, 1]), (1, [2130, 790]), (2, [1, 1]), (4, [2, 1])]
    check(spark, [(i, [x / 64 for x in v]) for i, v in rows], k=1)
    assert topk._Scores("i4", 2**23).exact is topk.np.float64
    assert topk._Scores("i8", 2**52).exact is topk.np.int64
