from __future__ import annotations

from collections import defaultdict

import pyarrow as pa

import __spark_entry__
import corpus_pipeline
from acquaint.llm import minhash, queries
from tests.llm.data import documents, hard_rows, prose
from tests.llm.test_minhash import components
from tests.llm.test_repeats import brute


def tables(spark, tmp_path, rows, labels):
    docs = documents(spark, rows).select(*corpus_pipeline.COLUMNS)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet"
    )
    return str(tmp_path)


def test_stages_of_hard_rows(spark, tmp_path):
    sf_dir = tables(spark, tmp_path, hard_rows(), [(1, 1, 0), (None, None, None)])
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, sf_dir)
        assert found.schema == docs.schema, name
        assert found.count() > 0
    assert corpus_pipeline.run(spark, sf_dir).count() > 0


def test_empty_tables(spark, tmp_path):
    assert corpus_pipeline.run(spark, tables(spark, tmp_path, [], [])).collect() == []


def test_one_of_each_group_stays(spark, tmp_path):
    rows = [(i, prose(i % 30, 80), "en", "a") for i in range(60)] + [(7, prose(7, 80), "en", "a")]
    rows += [(None, "null id", "en", "a"), (100, None, "en", "a")]
    sf_dir = tables(spark, tmp_path, rows, [])
    docs = queries.table(spark, sf_dir, "documents")
    found = corpus_pipeline.near_deduplication(spark, docs, sf_dir).collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(map(str, [*range(30), 100, None]))


def test_stages_against_plain_python(spark, sf_dir):
    """Near-duplicates and repeated passages of a whole small table."""
    docs = queries.table(spark, sf_dir, "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    near = components(rows, minhash.Similarity())
    stay = sorted((d, t) for d, t in rows if near[d] == d)
    found = corpus_pipeline.near_deduplication(spark, docs, sf_dir)
    assert sorted((r.doc_id, r.text) for r in found.collect()) == stay
    cut = corpus_pipeline.repeated_passages(spark, found, sf_dir).collect()
    sizes = {d: (n, gone) for (d, _), (n, gone, *_) in zip(stay, brute([t.encode() for _, t in stay]))}
    left = {d for d, (n, gone) in sizes.items() if n > gone or not n}
    by_id = {r.doc_id: r for r in cut}
    assert left - set(by_id) <= {d for d in left if sizes[d][0] - sizes[d][1] < 4}
    for d, r in by_id.items():
        assert 0 <= sizes[d][0] - sizes[d][1] - len(r.text.encode()) <= 6 * len(r.text) + 6


def test_mixing_repeats_and_loses_nothing(spark, sf_dir):
    docs = queries.table(spark, sf_dir, "documents")
    copies = defaultdict(int)
    for r in corpus_pipeline.mixing_sources(spark, docs, sf_dir).select("doc_id").collect():
        copies[r.doc_id] += 1
    assert len(copies) == docs.count() and max(copies.values()) <= 2


def test_texts_go_to_workers_in_small_batches(spark, tmp_path, monkeypatch):
    """Long texts, one longer than a batch, reach packing a few at a time, all of them."""
    monkeypatch.setattr(corpus_pipeline, "BATCH_BYTES", 100_000)
    rows = [(i, "word " * 2000, "en", "a") for i in range(200)]
    rows += [(200, "word " * 30_000, "en", "a"), (201, None, None, None)]
    sf_dir = tables(spark, tmp_path, rows, [])
    docs = queries.table(spark, sf_dir, "documents").coalesce(1)

    def sizes(batches):
        for batch in batches:
            n = pa.array([batch.num_rows])
            yield pa.RecordBatch.from_arrays([n, pa.array([batch.nbytes])], ["n", "size"])

    monkeypatch.setattr(
        corpus_pipeline, "pack_documents", lambda docs, _: docs.mapInArrow(sizes, "n long, size long")
    )
    spark.conf.unset(corpus_pipeline.BATCH_SETTING)
    try:
        found = corpus_pipeline.packing(spark, docs, sf_dir).collect()
        assert sum(r.n for r in found) == 202
        # A batch ends with the row that fills it.
        assert max(r.size for r in found if r.n > 1) < 100_000 + 160_000
        assert len(found) >= 15
        spark.conf.set(corpus_pipeline.BATCH_SETTING, "64m")
        assert len(corpus_pipeline.packing(spark, docs, sf_dir).collect()) == 1
    finally:
        spark.conf.unset(corpus_pipeline.BATCH_SETTING)


def test_all_are_registered():
    found = __spark_entry__.queries()
    assert {n.split("_")[0] for n in found if n.startswith("op")} == {f"op{n}" for n in range(1, 14)}
    assert found["pipeline"] is corpus_pipeline.run
    assert set(__spark_entry__.oracle_sql()) <= set(found)
