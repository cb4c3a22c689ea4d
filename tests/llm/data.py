"""Hand-made tables with the hard cases: nulls, empty and long texts, repeats."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

#: Columns of documents, and names that operators use inside.
DOCUMENTS = (
    "doc_id long, text string, lang string, source string, n_chars long,"
    " id long, version int, kept string, bucket string, cell string, range string,"
    " block string, tokens string, key string, label string, node string, spans string"
)


def documents(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Documents from (doc_id, text[, lang[, source]])."""
    filled = []
    for row in rows:
        doc_id, text, lang, source = (*row, *[None] * (4 - len(row)))
        size = None if text is None else len(text)
        filled.append((doc_id, text, lang, source, size, 1, 2, *["x"] * 10))
    return spark.createDataFrame(filled, DOCUMENTS)


def prose(seed: int, words: int, vocabulary: int = 400) -> str:
    draw = random.Random(seed)
    letters = "abcdefghijklmnopqrstuvwxyz"
    known = ["".join(draw.choices(letters, k=draw.randint(1, 9))) for _ in range(vocabulary)]
    out = []
    for n in range(words):
        word = draw.choice(known)
        out.append(word + (".\n" if n % 17 == 16 else ""))
    return " ".join(out)


def hard_rows() -> list[tuple]:
    """Nulls in every column, empty texts, a long one, ties and repeated rows."""
    long = prose(5, 30_000)
    text = prose(1, 60)
    return [
        (1, text, "en", "a"),
        (1, text, "en", "a"),
        (2, text, None, None),
        (3, None, "en", "b"),
        (4, "", "de", "b"),
        (None, prose(2, 40), "en", "a"),
        (None, None, None, None),
        (5, long, "en", "c"),
        (6, " \n\t ", "de", "c"),
        (7, "éè \U0001f600 naïve", "fr", "c"),
        (7, "another text of the same id", "fr", "c"),
        (8, "x\0y. z e s \0", "en", "a"),
    ]
