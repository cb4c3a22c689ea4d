"""Counts against plain Python, and the learned list against a plain learner."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from acquaint.llm import queries, rules
from acquaint.llm.shared import held_out
from tests.llm.data import documents, hard_rows, prose

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def plain(text: str | None) -> tuple[int, ...]:
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    there = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if there[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def counted(spark, texts):
    rows = rules.counts(documents(spark, list(enumerate(texts)))).orderBy("doc_id")
    return [tuple(r) for r in rows.select(*BASE).collect()]


def test_counts_of_hard_rows(spark):
    rows = hard_rows()
    got = Counter(tuple(r) for r in rules.counts(documents(spark, rows)).select("doc_id", *BASE).collect())
    assert got == Counter((r[0], *plain(r[1])) for r in rows)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("ab \n\t\x0b\r\x1c#é\U0001f600", max_size=40), min_size=1, max_size=12))
def test_counts_of_any_text(spark, texts):
    assert counted(spark, texts) == [plain(t) for t in texts]


def test_base_limits(spark):
    texts = [prose(1, 49), prose(1, 50), "a b c " * 30, " ".join(map(str, range(100))), ""]
    rows = rules.counts(documents(spark, list(enumerate(texts))))
    failed = rows.orderBy("doc_id").select(rules.base_failed().alias("x")).collect()
    assert [r["x"] for r in failed] == [True, False, True, False, True]


def test_windows_that_share_only_a_part_of_their_hash(spark):
    """Of 300,000 different windows some have equal keys; none is a repeat."""
    text = " ".join(map(str, range(300_000)))
    words = documents(spark, [(1, text)]).select(F.split("text", " ").alias("words"))
    keys = words.select(rules._window_hashes(F.col("words")).alias("hashes")).select(
        # One hash twice, as without any the keys are left out.
        rules._sorted_keys(F.concat("hashes", F.slice("hashes", 1, 1))).alias("keys")
    )
    shared = keys.select(F.size(rules._shared(F.col("keys"))).alias("n")).first()["n"]
    assert 2 < shared < 100
    assert counted(spark, [text, text + " 0 1 2", "0 1 2 " + text]) == [
        plain(t) for t in (text, text + " 0 1 2", "0 1 2 " + text)
    ]


def labelled(spark, rows):
    columns = ", ".join(f"{m} int" for m in rules.MEASURES)
    frame = spark.createDataFrame(rows, f"doc_id long, label int, {columns}, sought string")
    return frame.drop("sought")


def measured(n: int, label, **bins):
    return (n, label, *[bins.get(m, 0) for m in rules.MEASURES], "x")


def noisy(seed: int, many: int) -> list[tuple]:
    """Two kinds of bad rows, each told by two measures, and some wrong labels."""
    draw = random.Random(seed)
    rows = []
    for n in range(many):
        bins = {m: draw.randint(0, 60) for m in rules.MEASURES}
        bad = bins["symbols"] > 30 and bins["variety"] <= 20 or bins["marks"] > 50
        rows.append(measured(n, int(bad == (draw.random() < 0.03)), **bins))
    return rows


def plain_list(spark, rows, learning):
    """The same covering over Python lists."""
    ids = spark.createDataFrame([(r[0],) for r in rows], "doc_id long")
    aside = {
        r[0]: r[1]
        for r in ids.select("doc_id", F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(3)) == 0).collect()
    }
    labels = Counter(r[1] for r in rows)
    sought = 0 if labels[0] <= labels[1] else 1
    left, found = list(rows), []

    def value(row, condition):
        bin_ = row[2 + rules.MEASURES.index(condition.measure)]
        return bin_ > condition.bin if condition.above else bin_ <= condition.bin

    def meets(row, rule):
        return all(value(row, c) for c in rule)

    while len(found) < learning.rules:
        here, rule = [r for r in left if not aside[r[0]]], ()
        while len(rule) < learning.conditions:
            p = sum(r[1] == sought for r in here)
            if not p or p == len(here):
                break
            best, most = None, 0.0
            for at, measure in enumerate(rules.MEASURES):
                bins = sorted({r[2 + at] for r in here})
                for a, b in zip(bins, bins[1:]):
                    for above in (False, True):
                        side = [r for r in here if (r[2 + at] > a) == above]
                        q = sum(r[1] == sought for r in side)
                        if q < learning.support:
                            continue
                        gain = q * (math.log2(q / len(side)) - math.log2(p / len(here)))
                        if gain > most + 1e-9:
                            best, most = rules.Condition(measure, above, (a + b) // 2), gain
            if best is None:
                break
            rule += (best,)
            here = [r for r in here if value(r, best)]
        kept = [r for r in left if aside[r[0]]]
        worth = []
        for n in range(1, len(rule) + 1):
            met = [r for r in kept if meets(r, rule[:n])]
            p = sum(r[1] == sought for r in met)
            worth.append(((2 * p - len(met)) / len(met) if met else 0.0, p, len(met)))
        if not rule:
            break
        at = max(range(len(worth)), key=lambda n: (worth[n][0], -n))
        if worth[at][2] and worth[at][1] / worth[at][2] < learning.precision:
            break
        found.append(rule[: at + 1])
        left = [r for r in left if not meets(r, found[-1])]
    return rules.DecisionList(sought, tuple(found))


def test_learned_list_is_that_of_a_plain_learner(spark):
    learning = rules.Learning(rules=5)
    for seed in (1, 2):
        rows = noisy(seed, 400)
        learned = rules.learn(labelled(spark, rows), learning=learning)
        assert learned == plain_list(spark, rows, learning)
        assert learned.rules
        assert "if symbols > " in str(learned) or "if marks > " in str(learned)


def test_the_end_of_a_conjunction_that_does_not_help_is_pruned(spark):
    rows = [measured(n, int(n % 2), symbols=100 * (1 - n % 2), digits=n % 50) for n in range(400)]
    assert rules.learn(labelled(spark, rows)).rules == ((rules.Condition("symbols", True, 50),),)


def test_nothing_is_learned_without_both_labels(spark):
    for rows in ([], [measured(1, 1)], [measured(n, 0) for n in range(50)], [measured(1, None)]):
        assert rules.learn(labelled(spark, rows)) == rules.NO_RULES


def test_the_first_rule_met_decides(spark):
    listed = rules.DecisionList(
        0, ((rules.Condition("symbols", True, 5),), (rules.Condition("marks", False, 3),))
    )
    rows = labelled(spark, [measured(1, 0, symbols=9), measured(2, 0, marks=1), measured(3, 0, marks=9)])
    got = rows.orderBy("doc_id").select(listed.number().alias("n"), listed.label().alias("x")).collect()
    assert [tuple(r) for r in got] == [(1, 0), (2, 0), (None, 1)]


def test_verdicts_of_hard_rows(spark):
    rows = [*hard_rows(), *((n, prose(n, 60) + " ###" * (n % 2) * 20, "en", "a") for n in range(100, 160))]
    marks = [(n, 1 - n % 2, "x") for n in range(100, 160)] + [(1, 1, "x"), (1, 0, "x"), (None, 0, "x"), (2, None, "x")]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, label string")
    got, learned = rules.judge_documents(documents(spark, rows), labels, F.lit(True))
    assert [len(r) for r in learned.rules] == [1]
    verdicts = {r["doc_id"]: r for r in got.collect()}
    assert all(verdicts[n]["kept"] == (n % 2 == 0) for n in range(100, 160))
    assert got.count() == len(rows)
    assert not verdicts[3]["kept"] and verdicts[3]["base_failed"] and verdicts[3]["rule"] is None
    empty = rules.judge_documents(documents(spark, []), labels, F.lit(True))[0]
    assert empty.count() == 0


def test_labels_that_were_not_learned_from(spark, sf_dir):
    """Held-out rows that pass the base are judged as labelled."""
    got = queries.op11_rules(spark, sf_dir).where(held_out(F.col("doc_id")) & ~F.col("base_failed"))
    labels = queries.table(spark, sf_dir, "labels")
    agreed = got.join(labels, "doc_id").select((F.col("kept") == (F.col("quality") == 1)).alias("x"))
    found = [r["x"] for r in agreed.collect()]
    assert len(found) > 20
    assert sum(found) >= 0.95 * len(found)


def test_the_plan_has_no_python(spark, sf_dir):
    from tests.plans import plan_of

    plan = plan_of(rules.counts(queries.table(spark, sf_dir, "documents")))
    for unwanted in ("Python", "Pandas", "Arrow", "Exchange"):
        assert unwanted not in plan


def test_whole_texts_are_not_translated_nor_all_windows_sorted(spark, sf_dir):
    """Both took most of the time: a map is asked for each character, a comparison
    of rows made for each window."""
    from tests.plans import plan_of

    plan = re.sub(r"[ \n]|#\d+", "", plan_of(rules.counts(queries.table(spark, sf_dir, "documents"))))
    assert "translate(coalesce(text" not in plan
    assert "sort_array(transform(shared" in plan and "sort_array(transform(sequence" not in plan
