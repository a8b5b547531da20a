"""The registered queries of this package, over whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendloom.llm import bpe, htmltext, lexical, linededup, minhash, packing, quality, runs, sharding, surrogates, tokenfile, topk, warc

Query = Callable[[SparkSession, str], DataFrame]

#: Of the registered query only; a job passes its own secret.
KEY = b"a key for tests"
SHARDS = tuple(f"shard-{i:03d}" for i in range(64))


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip(_documents(spark, sf_dir), path, public_tokenizers.PATTERN).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_documents(spark, sf_dir), size=2, percent=80)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = warc.through_archives(spark, spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return pages.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = tokenfile.through_files(spark, _documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), end=0)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op5_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id % 20 = 0", k=20)


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(_documents(spark, sf_dir), ["doc_id"], SHARDS).select("doc_id", "slot", "shard")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = linededup.deduplicated(_documents(spark, sf_dir))
    return found.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = quality.trusted_of(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    found = quality.judged(_documents(spark, sf_dir), trusted, keep=["doc_id"])
    return found.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = surrogates.pseudonymised(_documents(spark, sf_dir), KEY)
    return found.select("row.doc_id", F.col("new_text").alias("text"), "n_entities")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), end=1)


def op11_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digests(_documents(spark, sf_dir))


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(spark.read.parquet(f"{sf_dir}/benchmark.parquet"), _documents(spark, sf_dir), k=10)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_byte_bpe,
        op2_minhash_dedup,
        op3_warc,
        op4_token_files,
        op5_top_k,
        op6_sharding,
        op7_line_dedup,
        op8_quality,
        op9_surrogates,
        op10_packing,
        op11_main_text,
        op12_runs,
        op13_lexical,
    )
}

ORACLES: dict[str, str] = {
    "op3_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages),
        g AS (SELECT html, max(page_id) AS first FROM p WHERE n >= 1000 GROUP BY html)
        SELECT page_id, n AS payload_bytes, sha1(p.html) AS payload_digest,
               CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id <> first THEN first END AS refers_to
        FROM p LEFT JOIN g ON p.html = g.html
    """,
    "op5_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS q FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT a.vec_id AS query_id, b.vec_id AS vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
            FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id
        ), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
        SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 20
    """,
    "op7_line_dedup": """
        WITH l AS (
            SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos
            FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents)
        ), k AS (
            SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
        ), r AS (
            SELECT key, max(doc_id) AS owner FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
        ), m AS (SELECT k.*, owner IS NOT NULL AND doc_id < owner AS lost FROM k LEFT JOIN r ON k.key = r.key)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT lost), '')) AS kept_sha256
        FROM m GROUP BY doc_id
    """,
    "op13_lexical": r"""
        WITH t AS (
            SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents
        ), tf AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY doc_id, term),
        d AS (SELECT doc_id, sum(tf) AS n FROM tf GROUP BY doc_id),
        c AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS len FROM d),
        q AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
        ), w AS (
            SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
            FROM tf, c GROUP BY term, docs
        ), s AS (
            SELECT q.item_id, tf.doc_id,
                   CAST(sum(w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * (10 + (90 * CAST(d.n AS BIGINT) * docs) // len)))) AS BIGINT) AS score
            FROM q JOIN tf USING (term) JOIN w USING (term) JOIN d USING (doc_id), c GROUP BY q.item_id, tf.doc_id
        ), r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS n FROM s WHERE score > 0)
        SELECT item_id, CAST(n AS INTEGER) AS rank, doc_id, score FROM r WHERE n <= 10
    """,
}
