from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from acquaint.llm import language
from acquaint.llm.queries import op1_language
from acquaint.llm.shared import held_out
from tests.llm.data import documents, hard_rows


def phrases(learned: str, text: str) -> int:
    """Longest matches, taken from left to right, counted plainly."""
    at = count = 0
    while at < len(text):
        n = 1
        while at + n <= len(text) and text[at : at + n] in learned:
            n += 1
        at += max(1, n - 1)
        count += 1
    return count


def symbols(parser, text):
    found = language._squeezed(parser._symbol[language._code_points(text.lower())])
    return "".join(chr(65 + s) for s in found)


@pytest.mark.parametrize(
    "text", ["the cat sat", "abracadabra abracadabra", "zzz", "cab the rat", "a", "the the the q the"]
)
def test_phrases_are_longest_matches(text):
    learned = (("one", "the cat sat on the mat, a rat"), ("two", "abracadabra cab cab arc"))
    parser = language.CrossParser(learned)
    found, _, _ = parser.phrases([text, "", None, text + text])
    for row, (_, sample) in enumerate(learned):
        assert found[row, 0] == phrases(symbols(parser, sample), symbols(parser, text))
    assert found[:, 1].tolist() == found[:, 2].tolist() == [0, 0]


@pytest.mark.parametrize("together, segment", [(1, 10**6), (3, 10**6), (512, 10**6), (7, 50), (512, 333)])
def test_long_texts_are_parsed_as_a_whole(monkeypatch, together, segment):
    """Stretches and segments leave no trace, also where parses never meet."""
    monkeypatch.setattr(language, "PARSED_TOGETHER", together)
    monkeypatch.setattr(language, "SEGMENT", segment)
    draw = random.Random(together)
    learned = (
        ("one", "ab" * 50 + "ba" * 30),
        ("three", "a" * 40),
        ("two", " ".join("".join(draw.choices("abc", k=4)) for _ in range(60))),
    )
    parser = language.CrossParser(learned)
    texts = ["abba" * 200, "a" * 777, "q", "", "a  b " * 99]
    texts.append(" ".join("".join(draw.choices("abcd", k=draw.randint(1, 9))) for _ in range(250)))
    found, sizes, _ = parser.phrases(texts)
    for n, text in enumerate(texts):
        whole = symbols(parser, text)
        assert sizes[n] == len(whole)
        for row, (_, sample) in enumerate(learned):
            assert found[row, n] == phrases(symbols(parser, sample), whole)


def test_the_language_of_fewest_normalised_phrases_wins():
    """The choice and its score, from plainly counted phrases."""
    draw = random.Random(8)
    words = {lang: ["".join(draw.choices("abcdefgh", k=4)) for _ in range(40)] for lang in ("x", "y", "z")}
    learned = tuple((lang, " ".join(draw.choices(w, k=60 * n))) for n, (lang, w) in enumerate(words.items(), 1))
    parser = language.CrossParser(learned)
    texts = [" ".join(draw.choices(words[lang], k=k)) for lang in words for k in (1, 5, 40)] + ["q ab", "aaaa"]
    chosen, score = parser.predict(texts)
    for text, lang, share in zip(texts, chosen.to_pylist(), score.to_pylist()):
        whole = symbols(parser, text)
        bits = [
            phrases(symbols(parser, sample), whole) * math.log2(len(symbols(parser, sample))) / len(whole)
            for _, sample in learned
        ]
        weights = [math.exp(-b / language.SCORE_BITS) for b in bits]
        assert lang == learned[bits.index(min(bits))][0]
        assert math.isclose(share, max(weights) / sum(weights), rel_tol=1e-9)


def test_hard_rows(spark):
    rows = documents(spark, hard_rows())
    kept_out = held_out(F.col("doc_id"))
    learned = language.learned_texts(rows, F.lit(True))
    found = language.identify(rows, learned, kept_out).collect()
    assert len(found) == len(hard_rows())
    assert all(0 <= r.score <= 1 for r in found)
    undetermined = [r for r in found if r.lang_pred == "und"]
    assert sorted(str(r.doc_id) for r in undetermined) == ["3", "4", "6", "None"]


def test_empty_table_and_nothing_learned(spark):
    empty = documents(spark, [])
    assert language.learned_texts(empty, F.lit(True)) == []
    assert language.identify(empty, [], F.lit(False)).collect() == []
    found = language.identify(documents(spark, [(1, "abc")]), [], F.lit(False)).collect()
    assert [(r.lang_pred, r.score) for r in found] == [("und", 0.0)]


def test_held_out_accuracy(spark, sf_dir):
    truth = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    found = op1_language(spark, sf_dir).join(truth, "doc_id").where("held_out")
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right > 0.97


def test_copies_count_once_in_what_is_learned(spark):
    """Groups of 70 copies each, more than the documents that are learned."""
    texts = [f"text number {n} of a language" for n in range(20)]
    rows = documents(spark, [(n, text, "en") for n, text in enumerate(texts * 70)])
    (learned,) = language.learned_texts(rows, F.lit(True))
    assert sorted(learned[1].split("\n")) == sorted(texts)


def test_every_script_has_its_own_letters():
    """Common scripts of many letters leave none out, rare ones are told apart."""
    latin, cyrillic = "abcdefghijklmnopqrstuvwxyz", "".join(map(chr, range(0x430, 0x450)))
    scripts = {
        "ar": "".join(map(chr, range(0x627, 0x64B))),
        "en": latin,
        "hi": "".join(map(chr, range(0x905, 0x939))),
        "mr": "".join(map(chr, range(0x905, 0x939))),
        "ru": cyrillic,
        "ta": "".join(map(chr, (*range(0xB85, 0xB8B), *range(0xB92, 0xB96), *range(0xBAE, 0xBBA)))),
        "th": "".join(map(chr, range(0xE01, 0xE2F))),
        "zh": "".join(map(chr, range(0x4E00, 0x5A00))),
    }

    def prose(lang, seed, words):
        draw, of = random.Random(lang), random.Random(seed)
        known = ["".join(draw.choices(scripts[lang], k=5)) for _ in range(200)]
        return " ".join(of.choices(known, k=words))

    often = {"ar": 4000, "en": 4000, "ru": 4000}
    learned = tuple((lang, prose(lang, 1, often.get(lang, 600))) for lang in scripts)
    parser = language.CrossParser(learned)
    chosen, score = parser.predict([prose(lang, 2, 30) for lang in scripts] + ["\u10d0\u10d1 \u10d2"])
    assert chosen.to_pylist()[:-1] == list(scripts)
    assert all(s > 0.9 for s in score.to_pylist()[:-1])
    text = prose("zh", 3, 20) + " \u10d0 " + prose("hi", 3, 20)
    found, _, _ = parser.phrases([text])
    for row, (_, sample) in enumerate(learned):
        assert found[row, 0] == phrases(symbols(parser, sample), symbols(parser, text))


def test_many_languages_learn_all_their_characters(spark, monkeypatch):
    monkeypatch.setattr(language, "STATES_TOGETHER", 7)
    monkeypatch.setattr(language, "RESULTS_TOGETHER", 500)
    texts = {f"l{n:02}": f"{chr(0x4E00 + n)}\u5000 " * 1000 for n in range(40)}
    rows = documents(spark, [(n, text, lang) for n, (lang, text) in enumerate(texts.items())])
    learning = language.Learning(language_chars=2500)
    learned = language.learned_texts(rows, F.lit(True), learning)
    assert [(lang, len(text)) for lang, text in learned] == [(lang, 2500) for lang in texts]
    chosen, _ = language.CrossParser(tuple(learned)).predict([text[:60] for text in texts.values()])
    assert chosen.to_pylist() == list(texts)
    full = [(n, "x" * 30_000, f"m{n:02}") for n in range(21)]
    learned = language.learned_texts(documents(spark, full), F.lit(True))
    assert all(len(text) == 24_000 for _, text in learned)
