from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from acquaint.llm import minhash
from acquaint.llm.components import connected
from acquaint.llm.minhash import Similarity, near_duplicates
from acquaint.llm.shared import written
from tests.llm.data import documents, hard_rows, prose


def shingles(text: str | None, n: int) -> set:
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x20\x09-\x0d]+", text)
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def components(rows: list[tuple], near: Similarity) -> dict:
    """Smallest id that each id reaches, by comparing all pairs that share a shingle."""
    sets = [(d, shingles(t, near.words)) for d, t, *_ in rows if d is not None]
    of = {d: d for d, _ in sets}

    def find(x):
        while of[x] != x:
            x = of[x]
        return x

    holders = defaultdict(list)
    for i, (d, s) in enumerate(sets):
        shared = defaultdict(int)
        for g in s:
            for j in holders[g]:
                shared[j] += 1
            holders[g].append(i)
        for j, k in shared.items():
            if 100 * k >= near.percent * (len(s) + len(sets[j][1]) - k):
                a, b = find(d), find(sets[j][0])
                of[max(a, b)] = min(a, b)
    return {d: find(d) for d in of}


def check(spark, rows, near=Similarity(4, 80)):
    found = near_duplicates(documents(spark, rows), near).collect()
    wanted = components(rows, near)
    sizes = sorted((str(d), len(shingles(t, near.words))) for d, t, *_ in rows)
    assert sorted((str(r.doc_id), r.n_shingles) for r in found) == sizes
    for r in found:
        assert r.component_id == wanted.get(r.doc_id)
        assert r.kept == (r.doc_id is None or r.component_id == r.doc_id)


def edited(text: str, draw: random.Random, edits: int) -> str:
    words = text.split(" ")
    for _ in range(edits):
        words[draw.randrange(len(words))] = f"w{draw.randrange(10**6)}"
    return " ".join(words)


def test_hard_rows(spark):
    check(spark, hard_rows())
    check(spark, hard_rows(), Similarity())
    assert near_duplicates(documents(spark, [])).collect() == []


@pytest.mark.parametrize("slots", [4, 10**9])
def test_groups_of_near_copies(spark, monkeypatch, slots):
    monkeypatch.setattr(minhash, "SLOTS_PER_NODE", slots)
    draw = random.Random(3)
    rows = [(1000 + i, prose(i, 30 + i)) for i in range(40)]
    for group in range(12):
        base = prose(100 + group, draw.randint(20, 200))
        rows += [
            (draw.randrange(100_000, 900_000), edited(base, draw, draw.randrange(6)))
            for _ in range(draw.randint(1, 9))
        ]
    check(spark, rows)


@pytest.mark.parametrize("block", [4, 16])
def test_large_buckets_in_blocks(spark, monkeypatch, block):
    """Copies that are like the first text but not all like one another."""
    monkeypatch.setattr(minhash, "BLOCK", block)
    draw = random.Random(9)
    base = prose(50, 150)
    rows = [(draw.randrange(1, 10**6), edited(base, draw, 4)) for _ in range(60)]
    rows.append((777_777, base))
    check(spark, rows)


def test_estimates_follow_similarity():
    draw = np.random.default_rng(4)
    for share in (0.5, 0.8, 0.95):
        errors = []
        for _ in range(30):
            one = draw.integers(0, 2**63, 600, dtype=np.uint64)
            same = int(600 * 2 * share / (1 + share))
            other = np.concatenate((one[:same], draw.integers(0, 2**63, 600 - same, dtype=np.uint64)))
            signed = [minhash.signature(minhash.minima(x)) for x in (one, other)]
            words = [np.frombuffer(s, np.uint64)[None, :] for s in signed]
            unlike = minhash.differing(*words)[0, 0]
            errors.append(minhash.estimate(np.array(minhash.MINIMA - unlike)) - share)
        assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.08


def test_sets_are_the_distinct_shingles():
    texts = ["a b c d", "A B\tC\nd a b c d", "a b", "", None, "x y z w v", "café É e f g"]
    found = minhash.shingle_sets(pa.array(texts), 4)
    assert [len(s) for s in found] == [len(shingles(t, 4)) for t in texts]
    assert set(found[0]) <= set(found[1])


@pytest.mark.parametrize("seed", range(3))
def test_components_of_random_graphs(spark, seed):
    draw = random.Random(seed)
    edges = [(draw.randrange(120), draw.randrange(120)) for _ in range(90)] + [(i, i + 1) for i in range(200, 240)]
    edges += [(500, i) for i in range(501, 560)]
    of = {x: x for e in edges for x in e}

    def find(x):
        while of[x] != x:
            x = of[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        of[max(a, b)] = min(a, b)
    found = connected(spark.createDataFrame(edges, "a long, b long")).collect()
    joined = {x for a, b in edges if a != b for x in (a, b)}
    assert {r.node: r.label for r in found} == {x: find(x) for x in joined}
    assert len(found) == len(joined)


def test_words_pass_in_stretches(monkeypatch):
    texts = pa.array([prose(n, 40) for n in range(5)] + [None, "", "x" * 300, " a " * 50, prose(9, 900)])
    whole = minhash.shingle_sets(texts, 4)
    monkeypatch.setattr(minhash, "CHUNK_BYTES", 17)
    assert all((a == b).all() for a, b in zip(whole, minhash.shingle_sets(texts, 4), strict=True))


def template(n, texts, words, common):
    """Texts that share a template and so buckets, but are not near."""
    draw = random.Random(n)
    shared = prose(77, common)
    return [(n * 1000 + i, shared + " " + prose(draw.randrange(10**6), words)) for i in range(texts)]


def test_tiles_hold_one_block_against_another(spark, monkeypatch):
    """Unlike members of large buckets: no task's group grows with the bucket."""
    monkeypatch.setattr(minhash, "BLOCK", 32)
    near = Similarity(words=2, percent=80)
    for many in (150, 300):
        classes = minhash.described(documents(spark, template(1, many, 14, 60)), near).selectExpr(
            "doc_id AS node", "signature", "buckets", "n_shingles"
        )
        members = written(minhash._members(classes), "members")
        assert members.agg(F.max("n")).first()[0] > many / 4
        labels = members.select("node").distinct().withColumn("label", F.col("node"))
        groups = minhash._places(members, labels).groupBy("bucket", "tile").count()
        assert groups.agg(F.max("count")).first()[0] < 4 * 32


def test_blocks_of_long_sets_hold_fewer(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 1000)
    near = Similarity(words=2, percent=80)
    rows = template(2, 60, 14, 60)
    classes = minhash.described(documents(spark, rows), near).selectExpr(
        "doc_id AS node", "signature", "buckets", "n_shingles"
    )
    members = written(minhash._members(classes), "members")
    labels = members.select("node").distinct().withColumn("label", F.col("node"))
    groups = minhash._places(members, labels).groupBy("bucket", "tile", "asks")
    assert groups.agg(F.sum("n_shingles").alias("s")).agg(F.max("s")).first()[0] < 3000


@pytest.mark.parametrize("block", [8, 512])
def test_unlike_members_of_a_bucket_and_chains(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    draw = random.Random(11)
    rows = template(3, 50, 30, 90)
    text = prose(500, 120)
    for step in range(25):  # each near the one before, the ends far apart
        rows.append((50_000 - step, text))
        text = edited(text, draw, 2)
    draw.shuffle(rows)
    check(spark, rows)


def test_pairs_of_stars_are_at_most_one_for_a_bucket_and_member(spark):
    rows = [(n, edited(prose(8, 100), random.Random(n), 2)) for n in range(80)]
    near = Similarity(4, 80)
    classes = minhash.described(documents(spark, rows), near).selectExpr(
        "doc_id AS node", "signature", "buckets", "n_shingles"
    )
    members = written(minhash._members(classes), "members")
    assert 0 < minhash._stars(members, near).count() <= members.count()
