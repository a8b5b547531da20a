"""A corpus from raw documents to packed sequences: five stages, each over all that the one before kept."""

from __future__ import annotations

import os
import secrets
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from trendloom.llm import linededup, minhash, packing, quality, surrogates
from trendloom.llm.frames import settled

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


#: Where no secret is set, surrogates are made with one that this process draws and nobody knows.
_DRAWN = secrets.token_hex(32)


def _key() -> bytes:
    """The secret that surrogates are made with. Set ``SURROGATE_KEY`` for surrogates that agree from run to run."""
    return (os.environ.get("SURROGATE_KEY") or _DRAWN).encode("utf-8")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the simple rules or are unlike the trusted ones go."""
    return quality.without_poor_text(docs, quality.trusted_of(spark.read.parquet(f"{sf_dir}/labels.parquet")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that three documents or more have stay in the one with the largest id."""
    return linededup.without_repeated_lines(docs)


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are alike, on shingles of five words, the one with the smallest id stays."""
    return minhash.without_copies(docs, size=5, percent=80)


def surrogate_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes surrogates."""
    return surrogates.without_personal_data(docs, _key())


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokenized documents are packed into sequences; one row for each piece."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end=1)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", minhash_dedup),
    ("PII surrogates", surrogate_pii),
    ("best-fit packing", best_fit_packing),
]

#: Tokens, signatures and keyed surrogates are beyond SQL; the stages are tested against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = settled(docs, "stage-" + name.replace(" ", "-"))
    return docs
