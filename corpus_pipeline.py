"""The corpus pipeline: whole documents in, encoded documents out, one operator per stage.

Each stage gets what the one before kept, reread from Parquet, and all but the last return the
columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ringtrail.llm import byte_bpe, exact_dedup, language_id, mixing, simhash
from ringtrail.llm.common import prepare, staging, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go, null texts and texts without a letter, and documents whose text is
    clearly in another language than their label."""
    prepare(spark)
    return language_id.keep_identified(docs, language_id.learn(docs))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id stays."""
    return exact_dedup.drop_copies(docs, staging(spark))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash component the document with the smallest id stays."""
    return simhash.drop_near_copies(docs, staging(spark))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: 0, 1 or 2 rows. Null texts have no words, a null source is
    a source of its own."""
    return mixing.repeat_documents(docs, staging(spark))


def encode_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the text decoded from them, a row per document taken;
    a null text is empty."""
    prepare(spark)
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.round_trip(docs, ranks, public_tokenizers.PATTERN)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("simhash", drop_near_copies),
    ("mixing", mix_sources),
    ("byte_bpe", encode_bytes),
]

# SimHash, automata and entropy balancing have no SQL form: tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each is written below spark.checkpoint.dir and read again."""
    stage = staging(spark)
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
