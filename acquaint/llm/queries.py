"""One query per operator, over whole tables, with production parameters."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acquaint.llm import (
    conversations,
    language,
    merkle,
    minhash,
    mixing,
    quality,
    repeats,
    resampling,
    rules,
    sharding,
    topk,
    warc,
)
from acquaint.llm.packing import pack_documents
from acquaint.llm.shared import held_out

TOKENIZER = "byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Python workers import this package too, wherever the driver was started.
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        joined = os.pathsep.join([root, *filter(None, paths)])
        spark.sparkContext.environment["PYTHONPATH"] = joined
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path(TOKENIZER))


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    documents = table(spark, sf_dir, "documents")
    kept_out = held_out(F.col("doc_id"))
    return language.identify(
        documents, language.learned_texts(documents, ~kept_out), kept_out
    )


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle fingerprints of every document and of its edited text."""
    return merkle.fingerprints(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    kept_out = held_out(F.col("doc_id"))
    rows = quality.learning_rows(documents, labels, ~kept_out, quality.Learning())
    return quality.score_documents(documents, quality.fit(*rows), kept_out)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed so that no source is used more than 1.5 times."""
    target = mixing.Target(repetitions=1.5)
    return mixing.mixture(table(spark, sf_dir, "documents"), target)


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document, by 4-word shingles at 0.8."""
    near = minhash.Similarity(words=4, percent=80)
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), near)


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of near-equal bytes."""
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without passages that start earlier."""
    return repeats.removal(table(spark, sf_dir, "documents")).drop("version", "kept")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages, read back from WARC archives."""
    return warc.archive_pages(table(spark, sf_dir, "pages"))


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best inner products of every vector whose id is divisible by 20."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 20 == 0)


def op11_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every document, and whether the base and the learned rules keep it."""
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return rules.judge_documents(documents, labels, ~held_out(F.col("doc_id")))[0]


def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all rebuilt conversations."""
    whole = conversations.sequences(table(spark, sf_dir, "conversations"))
    return conversations.prefix_nodes(conversations.rebuilt(whole))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored, and five percent of them drawn, for likeness to benchmark."""
    documents, target = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return resampling.resample(documents, target)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language": op1_language,
    "op2_fingerprints": op2_fingerprints,
    "op3_quality": op3_quality,
    "op4_mixing": op4_mixing,
    "op5_minhash": op5_minhash,
    "op6_sharding": op6_sharding,
    "op7_repeats": op7_repeats,
    "op8_packing": op8_packing,
    "op9_warc": op9_warc,
    "op10_topk": op10_topk,
    "op11_rules": op11_rules,
    "op12_trie": op12_trie,
    "op13_resampling": op13_resampling,
}


def _crc32(data: str) -> str:
    """SQL for the CRC-32 of a list of bytes: the register moves on by a byte, and
    each bit of what falls out adds its own remainder."""
    remainders = []
    for bit in range(8):
        value = 1 << bit
        for _ in range(8):
            value = (value >> 1) ^ (0xEDB88320 if value & 1 else 0)
        remainders.append(value)
    added = "a >> 8"
    for bit, value in enumerate(remainders):
        added = f"xor({added}, ((xor(a, b) >> {bit}) & 1) * {value})"
    start = 0xFFFFFFFF
    return f"xor(list_reduce({data}, lambda a, b: {added}, CAST({start} AS BIGINT)), {start})"


_WORDS = "regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')"

_TRIE = f"""
    WITH turns AS (
        SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
               row_number() OVER (PARTITION BY conv_id
                   ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
        FROM conversations WHERE conv_id IS NOT NULL
    ), ids AS (
        SELECT conv_id, {_crc32("list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))")} % 4 AS h
        FROM (SELECT DISTINCT conv_id FROM turns)
    ), rebuilt AS (
        SELECT i.conv_id, 0 AS kind, t.place, t.role, t.text
        FROM ids i JOIN turns t ON t.conv_id = i.conv_id - i.conv_id % 20 AND t.place <= i.h
        UNION ALL
        SELECT i.conv_id, 1, t.place, t.role, t.text
        FROM ids i JOIN turns t ON t.conv_id = i.conv_id AND t.place > i.h
    ), paths AS (
        SELECT i.conv_id, coalesce(list({{'role': r.role, 'text': r.text}} ORDER BY r.kind, r.place)
                                   FILTER (r.place IS NOT NULL), []) AS path
        FROM ids i LEFT JOIN rebuilt r ON r.conv_id = i.conv_id GROUP BY i.conv_id
    ), prefixes AS (
        SELECT conv_id, depth, path[1:depth] AS prefix, len(path) AS n
        FROM paths, unnest(range(0, len(path) + 1)) AS u(depth)
    ), nodes AS (
        SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
               sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)
                               FILTER (n = depth), '')) AS ends_sha256
        FROM prefixes GROUP BY prefix, depth
    ), parents AS (
        SELECT prefix[1:depth - 1] AS prefix, depth - 1 AS depth, count(*) AS n_children
        FROM nodes WHERE depth > 0 GROUP BY ALL
    ), own AS (
        SELECT n.*, coalesce(p.n_children, 0) AS n_children,
               CASE WHEN n.depth = 0 THEN 0
                    ELSE (n_convs - 1) * len({_WORDS.replace("(text", "(n.prefix[n.depth].text")}) END AS saved
        FROM nodes n LEFT JOIN parents p ON p.prefix = n.prefix AND p.depth = n.depth
    ), below AS (
        SELECT prefix[1:above] AS prefix, above AS depth, sum(saved) AS saved_tokens,
               count(*) FILTER (n_children = 0) AS n_leaves
        FROM own, unnest(range(0, depth + 1)) AS u(above) GROUP BY ALL
    )
    SELECT o.conv_id, o.depth, q.conv_id AS parent_conv_id, o.n_convs, o.n_children, b.n_leaves,
           CAST(b.saved_tokens AS BIGINT) AS saved_tokens, o.ends_sha256
    FROM own o JOIN below b ON b.prefix = o.prefix AND b.depth = o.depth
    LEFT JOIN nodes q ON q.prefix = o.prefix[1:o.depth - 1] AND q.depth = o.depth - 1
"""

_RESAMPLING = f"""
    WITH texts AS (
        SELECT 0 AS target, doc_id, row_number() OVER () AS row, text FROM documents
        UNION ALL SELECT 1, item_id, -row_number() OVER (), text FROM benchmark
    ), words AS (
        SELECT target, doc_id, row,
               regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
        FROM texts
    ), features AS (
        SELECT target, row, array_to_string(w[i:i + k - 1], ' ') AS feature
        FROM words, unnest([1, 2, 3]) AS ks(k), unnest(range(1, len(w) - k + 2)) AS u(i)
    ), counted AS (
        SELECT target, row, feature, count(*) AS n FROM features GROUP BY ALL
    ), buckets AS (
        SELECT feature, {_crc32("list_transform(range(0, octet_length(encode(feature))), lambda i: CAST(concat('0x', substr(hex(encode(feature)), 2 * i + 1, 2)) AS BIGINT))")} % 10000 AS bucket
        FROM (SELECT DISTINCT feature FROM counted)
    ), bucketed AS (
        SELECT target, row, bucket, sum(n) AS n FROM counted JOIN buckets USING (feature) GROUP BY ALL
    ), used AS (
        SELECT bucket, coalesce(sum(n) FILTER (target = 0), 0) AS s,
               coalesce(sum(n) FILTER (target = 1), 0) AS t FROM bucketed GROUP BY bucket
    ), gains AS (
        SELECT bucket, CAST(floor(1000 * ln(CAST((t + 1) * (sum(s) OVER () + 10000) AS DOUBLE)
                   / CAST((s + 1) * (sum(t) OVER () + 10000) AS DOUBLE))) AS BIGINT) AS gain FROM used
    ), weights AS (
        SELECT row, sum(n) AS n_features, sum(n * gain) AS weight
        FROM bucketed JOIN gains USING (bucket) WHERE target = 0 GROUP BY row
    ), scored AS (
        SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features,
               coalesce(weight, 0) AS weight,
               coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST(concat('0x', substr(
                   sha256(concat('42:', coalesce(CAST(doc_id AS VARCHAR), ''))), 1, 8)) AS BIGINT) + 0.5::DOUBLE)
                   / 4294967296))) AS BIGINT) AS score
        FROM words LEFT JOIN weights USING (row) WHERE target = 0
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place,
               count(*) FILTER (n_words >= 20) OVER () AS eligible FROM scored
    )
    SELECT doc_id, n_words, CAST(n_features AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight,
           CAST(score AS BIGINT) AS score,
           CASE WHEN n_words >= 20 AND place <= 5 * eligible // 100 THEN place END AS rank
    FROM ranked
"""

_NEAR = """
    WITH RECURSIVE words AS (
        SELECT doc_id, row_number() OVER () AS row,
               regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
        FROM documents
    ), sets AS (
        SELECT doc_id, row, CASE WHEN len(w) = 0 THEN []
            WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
            ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')))
            END AS s
        FROM words
    ), shingles AS (
        SELECT row, unnest(s) AS shingle FROM sets WHERE doc_id IS NOT NULL
    ), shared AS (
        SELECT a.row AS a, b.row AS b, count(*) AS n
        FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.row < b.row GROUP BY ALL
    ), links AS (
        SELECT x.doc_id AS a, y.doc_id AS b
        FROM shared JOIN sets x ON x.row = a JOIN sets y ON y.row = b
        WHERE 100 * n >= 80 * (len(x.s) + len(y.s) - n)
    ), ways AS (
        SELECT a, b FROM links UNION SELECT b, a FROM links
    ), reach AS (
        SELECT doc_id, doc_id AS label FROM documents WHERE doc_id IS NOT NULL
        UNION SELECT b, label FROM reach JOIN ways ON a = doc_id WHERE label < b
    ), components AS (
        SELECT doc_id, min(label) AS component_id FROM reach GROUP BY doc_id
    )
    SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, component_id,
           coalesce(component_id = s.doc_id, true) AS kept
    FROM sets s LEFT JOIN components c ON c.doc_id = s.doc_id
"""

ORACLES: dict[str, str] = {
    "op5_minhash": _NEAR,
    "op9_warc": """
        WITH payloads AS (
            SELECT page_id, coalesce(html, '') AS payload,
                   CAST(octet_length(CAST(encode(coalesce(html, '')) AS BLOB)) AS BIGINT) AS payload_bytes
            FROM pages
        ), grouped AS (
            SELECT *, min(page_id) OVER (PARTITION BY payload) AS first FROM payloads
        ), typed AS (
            SELECT *, payload_bytes >= 100 AND first IS NOT NULL
                      AND page_id IS DISTINCT FROM first AS again FROM grouped
        )
        SELECT page_id, payload_bytes, sha256(payload) AS payload_digest,
               CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN again THEN first END AS refers_to
        FROM typed
    """,
    "op10_topk": """
        WITH whole AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
                   CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
            FROM whole q JOIN whole c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
            WHERE q.vec_id % 20 = 0
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
            FROM scored
        )
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20
    """,
    "op12_trie": _TRIE,
    "op13_resampling": _RESAMPLING,
}
