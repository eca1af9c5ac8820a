"""A training-data pipeline over ``documents``: five stages, each one of the dealt operators.

Language ID drops documents without a known language and names the language of the others, exact deduplication leaves one row of equal
texts, SimHash near-deduplication one row of each group of near texts, mixing repeats or leaves out
rows until the sources have their target weights, and the last stage turns texts into token ids.
Every stage reads all that its predecessor kept, as Parquet, and all but the last return the
columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from newsloom.llm import bpe, exact, language, mixing, simhash
from newsloom.llm.common import Scratch, scratch_scope


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.keep_known(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.repeat_by_mix(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, ids, n_tokens, ids_sha256, decoded_sha256``; a repeated document has several rows."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.encode(docs, ranks, public_tokenizers.PATTERN)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("mix_to_weights", mix_sources),
    ("byte_bpe", tokenize),
]

#: Suffix automata, fingerprints and merges have no SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again, and what a
    stage kept there besides is removed."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        with scratch_scope():
            before, docs = docs, scratch.save(stage(spark, docs, sf_dir), name)
        if hasattr(before, "scratch_path"):
            scratch.drop(before)
    return docs
