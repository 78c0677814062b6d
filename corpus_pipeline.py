"""Corpus pipeline over ``documents``: language ID, exact dedup, SimHash
near-dedup, mixing of sources, byte-level BPE.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``; all but the last
return the columns of ``documents``.  Null and empty texts, repeated rows and
empty tables are handled by the operators as their docstrings say.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from twinline.llm import language_id
from twinline.llm.bpe import encode_documents
from twinline.llm.common import read_table, shared_folder
from twinline.llm.exact_dedup import keep_unique
from twinline.llm.mixing import repeat_rows
from twinline.llm.quality import vocabulary_path
from twinline.llm.simhash import keep_first_of_component


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn from the labelled rows and drop documents without a language."""
    return language_id.keep_known(docs, language_id.train(docs.where(~language_id.held_out())))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return keep_unique(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked at 3 or fewer differing bits."""
    return keep_first_of_component(docs, shingle=3, max_bits=3)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it."""
    return repeat_rows(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of ids and decoded bytes, a row per row."""
    return encode_documents(docs, vocabulary_path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, digest=True)


STAGES = [
    ("language_id", known_language),
    ("exact_dedup", exact_copies),
    ("simhash", near_copies),
    ("mixing", mixture),
    ("bpe", tokens),
]

# Language ID and the random rounding have no SQL; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's table lies in the shared folder."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
