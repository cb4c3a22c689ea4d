from __future__ import annotations

import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from acquaint.llm import mixing, queries
from acquaint.llm.mixing import Target
from acquaint.llm.shared import written
from tests.llm.data import documents, hard_rows, prose


def weights(tokens, exponent):
    raw = [(t / sum(tokens)) ** exponent for t in tokens]
    return [x / sum(raw) for x in raw]


def exponent_for(tokens, target):
    shares = [t / sum(tokens) for t in tokens]

    def sums(exponents):
        return [
            (sum(p**e for p in shares), sum(p**e * math.log2(p) for p in shares)) for e in exponents
        ]

    return mixing.exponent_for(sums, min(shares), max(shares), sum(tokens), target)


def test_exponent_meets_a_repetition_limit():
    tokens = [1000, 100, 10]
    found = exponent_for(tokens, Target(repetitions=3.0))
    assert math.isclose(found, 1 - math.log(3) / math.log(100), abs_tol=1e-9)
    assert exponent_for(tokens, Target(repetitions=1e6)) == 0.0
    assert math.isclose(exponent_for(tokens, Target(repetitions=1.0)), 1.0, abs_tol=1e-9)
    assert exponent_for([5, 5, 5], Target(repetitions=1.0)) == 1.0


def test_exponent_meets_an_entropy():
    tokens = [1000, 100, 10]
    found = exponent_for(tokens, Target(entropy=1.2))
    entropy = -sum(w * math.log2(w) for w in weights(tokens, found))
    assert math.isclose(entropy, 1.2, abs_tol=1e-9)
    assert exponent_for(tokens, Target(entropy=9.0)) == 0.0


def test_the_target_of_the_query_binds(spark, sf_dir):
    """Neither end of the exponent's range meets it on the given tables."""
    documents_ = queries.table(spark, sf_dir, "documents")
    sized = written(mixing._identified(documents_), "sized")
    shares = mixing.budgets(sized, Target(repetitions=1.5)).collect()
    used = [r.blocks + r.rest / t for r in shares for t in [_tokens(sized, r.budget_of)]]
    assert math.isclose(max(used), 1.5, abs_tol=0.01) and math.isclose(min(used), 1.0, abs_tol=0.01)
    assert len({round(r.weight, 6) for r in shares}) > 1


def _tokens(sized, source):
    return sized.where(F.col("source").eqNullSafe(F.lit(source))).agg(F.sum("tokens")).first()[0]


@pytest.mark.parametrize("texts", [1, 2000])
def test_a_limit_holds_for_thousands_of_rows_without_ids(spark, texts):
    """Rows that share an id, and rows equal in all columns, are drawn one by one."""
    given = [(n, prose(n, 30), "en", "large") for n in range(400)]
    given += [(None, f"word {n % texts} " * 2, "en", "small") for n in range(2000)]
    target = Target(repetitions=1.2)
    frame = documents(spark, given)
    for found in (
        mixing.mixture(frame, target).where("source = 'small'").count(),
        mixing.mixed_documents(frame, target).where("source = 'small'").count(),
    ):
        assert abs(found - 1.2 * 2000) <= 1


def rows(n=300):
    source = lambda i: "a" if i % 3 == 0 else "b" if i % 7 else None
    return [(i, prose(i, i % 23), "en", source(i)) for i in range(n)]


def brute(spark, given, target):
    """Documents of each source's blocks, spent from its budget in key order."""
    held = defaultdict(list)
    for doc_id, text, _, source in given:
        held[source].append((doc_id, len((text or "").split()) + 1, text))
    names = sorted(held, key=lambda s: (s is not None, s or ""))
    tokens = [sum(t for _, t, _ in held[s]) for s in names]
    shares = weights(tokens, exponent_for(tokens, target))
    whole = target.tokens or max(t / w for t, w in zip(tokens, shares))
    frame = spark.createDataFrame(
        [(d, s, x, b) for s in names for d, _, x in held[s] for b in range(9)],
        "doc_id long, source string, text string, b int",
    )
    frame = frame.select("*", F.xxhash64("text").alias("text_hash"), F.lit(0).cast("long").alias("copy"))
    keys = {(r[0], r[1], r[2]): r[3] for r in frame.select("doc_id", "source", "b", mixing._key(F.col("b"), target.seed)).collect()}
    found = []
    for name, total, share in zip(names, tokens, shares):
        left, block = whole * share, 0
        while left >= 1:
            order = sorted(held[name], key=lambda x: (keys[x[0], name, block], x[0]))
            for place, (doc_id, n, _) in enumerate(order):
                if left < 1e-6 * total:
                    break
                found.append((doc_id, name, block, place))
                left -= n
            block += 1
    return Counter(found)


@pytest.mark.parametrize(
    "target",
    [Target(repetitions=2.5), Target(repetitions=None, entropy=1.3), Target(repetitions=2.0, tokens=700)],
)
def test_blocks_spend_the_budgets(spark, monkeypatch, target):
    monkeypatch.setattr(mixing, "RANGE_DOCUMENTS", 16)
    found = mixing.mixture(documents(spark, rows()), target).collect()
    got = Counter((r.doc_id, r.source, r.block, r.place) for r in found)
    assert got == brute(spark, rows(), target)


def test_every_document_is_used(spark):
    found = mixing.mixture(documents(spark, rows()), Target(repetitions=2.0)).collect()
    assert {r.doc_id for r in found} == {r[0] for r in rows()}
    tokens = Counter()
    for r in found:
        tokens[r.source] += r.tokens
    share = {r.source: r.weight for r in found}
    whole = sum(tokens.values())
    assert all(abs(tokens[s] / whole - share[s]) < 0.02 for s in share)


def test_hard_rows(spark):
    given = documents(spark, hard_rows())
    found = mixing.mixture(given, Target(repetitions=3.0)).collect()
    assert Counter(str(r.doc_id) for r in found if r.block == 0) == Counter(str(r[0]) for r in hard_rows())
    mixed = mixing.mixed_documents(given, Target(repetitions=3.0))
    assert mixed.schema == given.schema
    assert Counter(str(r.doc_id) for r in mixed.collect()) == Counter(str(r.doc_id) for r in found)


def test_empty_table(spark):
    assert mixing.mixture(documents(spark, [])).collect() == []
    assert mixing.mixed_documents(documents(spark, [])).collect() == []


def test_mixed_documents_are_in_the_order_of_their_permutations(spark):
    given = documents(spark, [(n, f"text {n}", "en", "a" if n % 5 else "b") for n in range(300)])
    placed = mixing.mixture(given, Target(repetitions=3.0)).orderBy("source", "block", "place").collect()
    mixed = mixing.mixed_documents(given, Target(repetitions=3.0)).collect()
    for source in "ab":
        order = [r.doc_id for r in placed if r.source == source]
        assert [r.doc_id for r in mixed if r.source == source] == order
        assert order != sorted(order)
