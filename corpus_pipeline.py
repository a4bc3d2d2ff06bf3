"""Training-corpus pipeline over `documents`, in five stages.

Each stage gets all rows that the one before kept, as (spark, docs, sf_dir), and returns a DataFrame. Null
and empty texts do not pass the quality rules; in a later stage they would have no copy, leak, secret or token.
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sluiceway.llm import bpe, decontaminate, jaccard, rules_cascade, secrets  # noqa: E402
from sluiceway.llm.common import shared_dir, table  # noqa: E402


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return rules_cascade.keep(docs)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest doc_id, of each group of near copies."""
    return jaccard.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked."""
    return secrets.mask_secrets(docs)


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the digest of the text they decode to."""
    return bpe.encode_checked(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", ngram_jaccard),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("BPE encoding and decoding", bpe_tokens),
]

#: SQL cannot express WAND retrieval, nested decoding and BPE; tests compare the rows with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what a stage returns is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark).rstrip('/')}/corpus-pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{number}")
            docs = spark.read.parquet(f"{folder}/{number}")
    return docs
