"""Quality classifier: a generalised additive model with pairwise interactions.

Every whole text is reduced to ``FEATURES``. Each feature is cut into bins at
quantiles of the learning rows. Boosting goes round the features, one at a time:
a shallow tree on that feature alone is fitted to what the model so far leaves
unexplained, and its leaves are added, by a small rate, to the feature's lookup
table. Then pairs of features that explain most of the rest get tables of their
own in the same way. A score adds up one entry of each table and passes the sum
through the logistic function.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acquaint.llm.shared import encoded, giving_back, slices

FEATURES = (
    "chars",
    "words",
    "word_chars",
    "letters",
    "capitals",
    "digits",
    "marks",
    "symbols",
    "spaces",
    "beyond_ascii",
    "repeated_bytes",
    "words_distinct",
    "words_unlike_previous",
    "pairs_distinct",
    "commonest_word",
    "longest_word",
    "lines",
    "lines_distinct",
    "line_chars",
    "sentence_words",
    "words_marked",
    "words_short",
)

SCORED = "doc_id long, held_out boolean, score double, predicted int"

THRESHOLD = 0.3


@dataclass(frozen=True)
class Learning:
    """Bounds of the learning sample and of the model."""

    rows: int = 20_000
    bins: int = 48
    rounds: int = 120
    rate: float = 0.15
    leaves: int = 3
    pairs: int = 8
    pair_bins: int = 12
    pair_rounds: int = 60
    smooth: float = 4.0


@dataclass(frozen=True)
class AdditiveModel:
    base: float
    cuts: tuple[np.ndarray, ...]
    tables: tuple[np.ndarray, ...]
    pairs: tuple[tuple[int, int, np.ndarray, np.ndarray, np.ndarray], ...] = ()

    def score(self, values: np.ndarray) -> np.ndarray:
        total = np.full(len(values), self.base)
        for column, (cuts, table) in enumerate(zip(self.cuts, self.tables)):
            total += table[np.searchsorted(cuts, values[:, column], side="right")]
        for a, b, cuts_a, cuts_b, table in self.pairs:
            at = np.searchsorted(cuts_a, values[:, a], side="right")
            total += table[at, np.searchsorted(cuts_b, values[:, b], side="right")]
        return 1 / (1 + np.exp(-total))


_KIND = np.zeros(256, np.uint8)  # 0 other control, 1 space, 2 small, 3 capital, 4 digit,
_KIND[[9, 10, 11, 12, 13, 32]] = 1  # 5 mark of prose, 6 other symbol, 7 beyond ASCII
_KIND[97:123], _KIND[65:91], _KIND[48:58] = 2, 3, 4
_KIND[33:48] = _KIND[58:65] = _KIND[91:97] = _KIND[123:127] = 6
_KIND[[ord(c) for c in ".,;:?'\"-()"]] = 5
_KIND[128:] = 7

_SENTENCE = re.compile(r"[.!?](?:\s|$)")


def text_features(texts: pa.Array) -> np.ndarray:
    """One row of ``FEATURES`` for each text; a null text is empty. All are finite."""
    flat, bounds = encoded(texts)
    n = len(texts)
    out = np.zeros((n, len(FEATURES)))
    sizes = np.diff(bounds)
    owner = np.repeat(np.arange(n), sizes)
    kinds = np.bincount(owner * 8 + _KIND[flat], minlength=n * 8).reshape(n, 8)
    same = np.zeros(len(flat), bool)
    same[1:] = (flat[1:] == flat[:-1]) & (owner[1:] == owner[:-1])
    repeated = np.bincount(owner[same], minlength=n)
    size = np.maximum(1, sizes)
    column = {name: out[:, i] for i, name in enumerate(FEATURES)}
    column["letters"][:] = (kinds[:, 2] + kinds[:, 3] + kinds[:, 7]) / size
    column["capitals"][:] = kinds[:, 3] / np.maximum(1, kinds[:, 2] + kinds[:, 3])
    column["digits"][:] = kinds[:, 4] / size
    column["marks"][:] = kinds[:, 5] / size
    column["symbols"][:] = kinds[:, 6] / size
    column["spaces"][:] = kinds[:, 1] / size
    column["beyond_ascii"][:] = kinds[:, 7] / size
    column["repeated_bytes"][:] = repeated / size
    for row, text in enumerate(texts.to_pylist()):
        if not text:
            continue
        words = text.split()
        lines = [x for x in text.split("\n") if x]
        many = max(1, len(words))
        unlike = sum(map(str.__ne__, words[1:], words[:-1]))
        counts: dict[str, int] = {}
        for word in words:
            counts[word] = counts.get(word, 0) + 1
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        marked = sum(not x[-1].isalnum() for x in counts)
        out[row, 0] = np.log1p(len(text))
        out[row, 1] = np.log1p(len(words))
        column["word_chars"][row] = lengths.mean() if len(words) else 0
        column["words_distinct"][row] = len(counts) / many
        column["words_unlike_previous"][row] = (unlike + 1) / many
        column["pairs_distinct"][row] = len(set(zip(words, words[1:]))) / many
        column["commonest_word"][row] = max(counts.values(), default=0) / many
        column["longest_word"][row] = np.log1p(lengths.max(initial=0))
        column["lines"][row] = np.log1p(len(lines))
        column["lines_distinct"][row] = len(set(lines)) / max(1, len(lines))
        column["line_chars"][row] = np.log1p(len(text) / max(1, len(lines)))
        column["sentence_words"][row] = np.log1p(many / (1 + len(_SENTENCE.findall(text))))
        column["words_marked"][row] = marked / max(1, len(counts))
        column["words_short"][row] = (lengths <= 2).mean() if len(words) else 0
    return out


def learning_rows(
    documents: DataFrame, labels: DataFrame, learnable: Column, learning: Learning
) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of a bounded sample of labelled documents.

    A document whose label rows disagree counts as what most of them say, a tie
    as 1, and one of several rows counts once, by its smallest features. The sample is
    drawn by a hash of doc_id; its expected size is ``learning.rows``, or all
    documents if there are fewer.
    """
    marked = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality")
        .where(learnable & F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg((F.avg("quality") >= 0.5).cast("double").alias("label"))
    )
    there = marked.count()
    share = min(1.0, learning.rows / max(1, there))
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < F.lit(int(share * 1_000_000))
    chosen = marked.where(drawn)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # About learning.rows ids, so their size is bounded whatever the tables hold.
    rows = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text")

    @giving_back
    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last in slices(encoded(batch.column("text"))[1]):
                part = batch.slice(first, last - first)
                values = text_features(part.column("text"))
                lists = pa.FixedSizeListArray.from_arrays(values.ravel(), len(FEATURES))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("label"), lists.cast(pa.list_(pa.float64()))],
                    ["doc_id", "label", "features"],
                )

    found = rows.mapInArrow(features, "doc_id long, label double, features array<double>")
    # One row a document, whatever rows share its id.
    found = found.groupBy("doc_id", "label").agg(F.min("features").alias("features")).toArrow()
    values = np.array(found.column("features").to_pylist(), float)
    label = found.column("label").to_numpy()
    values = values.reshape(-1, len(FEATURES))
    order = np.lexsort([*values.T, label])  # the same model whatever the tasks' order
    return values[order], label[order]


def fit(values: np.ndarray, labels: np.ndarray, learning: Learning = Learning()) -> AdditiveModel:
    """The additive model of these rows; without rows it scores 0.5 everywhere."""
    mean = np.clip(labels.mean(), 1e-3, 1 - 1e-3) if len(labels) else 0.5
    base = float(np.log(mean / (1 - mean)))
    cuts = tuple(_cuts(column, learning.bins) for column in values.T)
    if not len(labels):
        cuts = tuple(np.zeros(0) for _ in FEATURES)
    at = [np.searchsorted(c, column, side="right") for c, column in zip(cuts, values.T)]
    tables = [np.zeros(len(c) + 1) for c in cuts]
    total = np.full(len(labels), base)
    for _ in range(learning.rounds if len(labels) else 0):
        for column, bins in enumerate(at):
            gradient, weight = _sums(total, labels, bins, len(tables[column]))
            step = learning.rate * _tree(gradient, weight, learning)
            tables[column] += step
            total += step[bins]
    pairs = _pairs(values, labels, total, learning) if len(labels) else ()
    return AdditiveModel(base, cuts, tuple(tables), pairs)


def _cuts(column: np.ndarray, bins: int) -> np.ndarray:
    if not len(column):
        return np.zeros(0)
    return np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1]))


def _sums(
    total: np.ndarray, labels: np.ndarray, bins: np.ndarray, size: int
) -> tuple[np.ndarray, np.ndarray]:
    chance = 1 / (1 + np.exp(-total))
    gradient = np.bincount(bins, weights=labels - chance, minlength=size)
    return gradient, np.bincount(bins, weights=chance * (1 - chance), minlength=size)


def _tree(gradient: np.ndarray, weight: np.ndarray, learning: Learning) -> np.ndarray:
    """Leaf values of the best tree over ordered bins, for each bin."""
    edges = [0, len(gradient)]
    up, wp = (np.concatenate(([0.0], np.cumsum(x))) for x in (gradient, weight))

    def worth(a: np.ndarray | int, b: np.ndarray | int) -> np.ndarray:
        return (up[b] - up[a]) ** 2 / (wp[b] - wp[a] + learning.smooth)

    for _ in range(learning.leaves - 1):
        best, cut = 1e-9, None
        for a, b in zip(edges, edges[1:]):
            if b - a > 1:
                between = np.arange(a + 1, b)
                gain = worth(a, between) + worth(between, b) - worth(a, b)
                i = int(gain.argmax())
                if gain[i] > best:
                    best, cut = gain[i], a + 1 + i
        if cut is None:
            break
        edges = sorted([*edges, cut])
    low, high = np.array(edges[:-1]), np.array(edges[1:])
    return np.repeat((up[high] - up[low]) / (wp[high] - wp[low] + learning.smooth), high - low)


def _pairs(
    values: np.ndarray, labels: np.ndarray, total: np.ndarray, learning: Learning
) -> tuple[tuple[int, int, np.ndarray, np.ndarray, np.ndarray], ...]:
    cuts = [_cuts(column, learning.pair_bins) for column in values.T]
    at = [np.searchsorted(c, column, side="right") for c, column in zip(cuts, values.T)]
    worth = []
    for a in range(values.shape[1]):
        for b in range(a + 1, values.shape[1]):
            size = (len(cuts[a]) + 1) * (len(cuts[b]) + 1)
            cell = at[a] * (len(cuts[b]) + 1) + at[b]
            gradient, weight = _sums(total, labels, cell, size)
            worth.append((float((gradient**2 / (weight + learning.smooth)).sum()), a, b))
    chosen = sorted(worth, key=lambda x: (-x[0], x[1], x[2]))[: learning.pairs]
    tables = [np.zeros((len(cuts[a]) + 1, len(cuts[b]) + 1)) for _, a, b in chosen]
    total = total.copy()
    for _ in range(learning.pair_rounds):
        for (_, a, b), table in zip(chosen, tables):
            # Trees on one of the two features within halves of the other.
            step = np.zeros_like(table)
            cell = at[a] * table.shape[1] + at[b]
            gradient, weight = (
                x.reshape(table.shape) for x in _sums(total, labels, cell, table.size)
            )
            half = table.shape[0] // 2
            for part in (slice(0, half), slice(half, None)):
                if table[part].size:
                    step[part] = _tree(gradient[part].sum(0), weight[part].sum(0), learning)
            half = table.shape[1] // 2
            for part in (slice(0, half), slice(half, None)):
                if table[:, part].size:
                    step[:, part] += _tree(
                        gradient[:, part].sum(1), weight[:, part].sum(1), learning
                    )[:, None]
            step *= learning.rate / 2
            table += step
            total += step.ravel()[cell]
    return tuple((a, b, cuts[a], cuts[b], t) for (_, a, b), t in zip(chosen, tables))


def score_documents(documents: DataFrame, model: AdditiveModel, held_out: Column) -> DataFrame:
    """Score of every whole text, and 1 where it reaches ``THRESHOLD``.

    Null and empty texts have the score of a text without words. Repeated rows
    and null ids are kept as they are; other columns are ignored.
    """
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), "text"
    )

    @giving_back
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = score_texts(model, batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(score),
                    pa.array((score >= THRESHOLD).astype(np.int32)),
                ],
                ["doc_id", "held_out", "score", "predicted"],
            )

    return rows.mapInArrow(scored, SCORED)


def accepted_documents(documents: DataFrame, model: AdditiveModel) -> DataFrame:
    """The rows, with all their columns, that the model does not reject."""

    @giving_back
    def accepted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = score_texts(model, batch.column("text")) >= THRESHOLD
            yield batch.filter(pa.array(keep))

    return documents.mapInArrow(accepted, documents.schema)


def score_texts(model: AdditiveModel, texts: pa.Array) -> np.ndarray:
    found = [
        model.score(text_features(texts.slice(first, last - first)))
        for first, last in slices(encoded(texts)[1])
    ]
    return np.concatenate([np.zeros(0), *found])
