from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from acquaint.llm import quality
from acquaint.llm.queries import op3_quality
from tests.llm.data import documents, hard_rows


def test_model_finds_an_interaction():
    draw = np.random.default_rng(1)
    values = np.zeros((4000, len(quality.FEATURES)))
    values[:, 3:5] = draw.uniform(size=(4000, 2))
    labels = ((values[:, 3] > 0.5) ^ (values[:, 4] > 0.5)).astype(float)
    found = quality.fit(values[:3000], labels[:3000]).score(values[3000:])
    assert ((found > 0.5) == (labels[3000:] > 0.5)).mean() > 0.95


def test_scores_add_up_lookups():
    model = quality.AdditiveModel(
        0.5,
        tuple(np.array([1.0]) for _ in quality.FEATURES),
        tuple(np.array([0.0, 0.1 * i]) for i, _ in enumerate(quality.FEATURES)),
        ((0, 1, np.array([0.0]), np.array([0.0]), np.array([[1.0, 2.0], [3.0, 4.0]])),),
    )
    values = np.zeros((1, len(quality.FEATURES)))
    values[0, 2], values[0, 0] = 1.0, -1.0
    assert np.isclose(model.score(values)[0], 1 / (1 + np.exp(-(0.5 + 0.2 + 2.0))))


def test_features_are_finite_and_of_whole_texts():
    texts = pa.array([None, "", " \n", "a", "A,b. c", "x" * 100_000 + " end", "éè"])
    found = quality.text_features(texts)
    assert np.isfinite(found).all() and (found[0] == 0).all() and (found[1] == 0).all()
    assert found[5][quality.FEATURES.index("words")] == np.log1p(2)


def test_hard_rows_and_labels(spark):
    rows = documents(spark, hard_rows())
    labels = spark.createDataFrame(
        [(1, 1, 0, "x"), (1, 1, 0, "x"), (1, 0, 0, "x"), (4, 0, 0, "x"), (None, 1, 0, "x"), (5, None, 0, "x")],
        "doc_id long, quality int, toxic int, text string",
    )
    found = quality.learning_rows(rows, labels, F.lit(True), quality.Learning())
    assert found[1].tolist() == [0.0, 1.0]
    scores = quality.score_documents(rows, quality.fit(*found), F.lit(False)).collect()
    assert len(scores) == len(hard_rows())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in scores)
    kept = quality.accepted_documents(rows, quality.fit(*found))
    assert kept.columns == rows.columns and kept.count() == sum(r.predicted for r in scores)


def test_nothing_to_learn_from(spark):
    rows, labels = documents(spark, []), spark.createDataFrame([], "doc_id long, quality int")
    found = quality.learning_rows(rows, labels, F.lit(True), quality.Learning())
    model = quality.fit(*found)
    assert quality.score_documents(rows, model, F.lit(False)).collect() == []
    assert model.score(np.zeros((1, len(quality.FEATURES)))).tolist() == [0.5]


def test_held_out_accuracy(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    found = op3_quality(spark, sf_dir).join(labels, "doc_id").where("held_out").collect()
    right = sum(r.predicted == r.quality for r in found)
    assert right / len(found) > 0.95


def test_an_id_of_many_rows_teaches_once(spark):
    rows = documents(spark, [(1, f"text {n}") for n in range(3000)] + [(2, "other")])
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    values, marks = quality.learning_rows(rows, labels, F.lit(True), quality.Learning())
    assert len(values) == 2 and sorted(marks) == [0.0, 1.0]
