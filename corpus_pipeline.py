"""A corpus pipeline: quality, near-duplicates, repeated passages, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stages before
it kept. All but the last return the columns of ``documents``; the last returns
pieces of token sequences. Between stages the rows are written as Parquet to the
shared folder and read again.

Stages hand whole texts to Python workers, so each first bounds the bytes of a batch of
rows in the session, unless the session has a bound of its own (``bounded_batches``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acquaint.llm import minhash, mixing, quality, repeats
from acquaint.llm.packing import pack_documents
from acquaint.llm.queries import table, tokenizer_path
from acquaint.llm.shared import held_out, without_keys, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

#: By default Spark sends 10,000 rows or 64 MB at once, of which each task of an executor
#: and its Python worker hold a batch and more.
BATCH_BYTES = 4 << 20

#: Every document is used at least once, those of small sources more often.
MIXTURE = mixing.Target(repetitions=1.5)


def bounded_batches(spark: SparkSession) -> None:
    """Rows go to Python workers some ``BATCH_BYTES`` at a time from now on; a longer row
    alone. A bound that the session was given stays."""
    if BATCH_SETTING not in spark.conf.getAll:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject. It is trained on labelled
    rows of the documents given; without any it rejects nothing. Null and empty texts
    are scored like others, equal rows get equal scores, null ids teach nothing."""
    bounded_batches(spark)
    docs, labels = docs.select(*COLUMNS), table(spark, sf_dir, "labels")
    rows = quality.learning_rows(docs, labels, ~held_out(F.col("doc_id")), quality.Learning())
    return quality.accepted_documents(docs, quality.fit(*rows))


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest
    doc_id. A document's rows are those that share its id: they stay or go together,
    rows that are also equal in text as one. Rows with null ids, and documents
    without words, are near nothing and stay."""
    bounded_batches(spark)
    table(spark, sf_dir, "documents")  # makes the package importable in workers
    docs = docs.select(*COLUMNS)
    found = written(minhash.near_duplicates(docs), "near")
    gone = written(found.where(~F.col("kept")).select("doc_id").distinct(), "gone")
    rows = without_keys(docs, gone, "doc_id")
    several = found.where("doc_id IS NOT NULL AND kept").groupBy("doc_id").count().where("count > 1")
    if several.isEmpty():
        return rows
    several = written(several.select("doc_id"), "several")
    once = rows.join(several, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return rows.join(several, "doc_id", "left_anti").unionByName(once).select(*COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that start earlier; characters that were cut in
    two go too. Documents of which nothing is left go, empty ones stay."""
    bounded_batches(spark)
    table(spark, sf_dir, "documents")
    return repeats.shortened_documents(docs.select(*COLUMNS))


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of all sources, repeated by their source's weight. A null source is
    one of its own; null and empty texts count one token; of equal rows each is drawn
    for itself."""
    bounded_batches(spark)
    table(spark, sf_dir, "documents")
    return mixing.mixed_documents(docs.select(*COLUMNS), MIXTURE)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in token sequences. A null or empty text is one token;
    rows are packed as often as they are there; null ids stay null."""
    bounded_batches(spark)
    table(spark, sf_dir, "documents")
    return pack_documents(docs.select(*COLUMNS), tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality_classifier),
    ("MinHash near-dedup", near_deduplication),
    ("suffix-array dedup", repeated_passages),
    ("mixing sources to target weights", mixing_sources),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, in order, applied to the table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = written(docs, f"stage-{number}")
    return docs


#: SQL has no boosted trees, MinHash buckets, suffix order or tokenizer.
ORACLE_SQL = None

QUERIES = {"pipeline": run}

ORACLES: dict[str, str] = {}
