"""A corpus pipeline: quality rules, languages, near-duplicates, mixture, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. What a stage returns is
written as Parquet and read again as the next one's docs. All but the last return the
columns of documents, others that docs may have included.

Odd rows. A missing or empty text and one without words is rejected by the quality rules. A
text without a letter, or in no language that the network knows, is rejected by the language
stage. Near-duplicates are rows: of rows with equal or nearly equal texts one stays, that
with the smallest id, a missing id being the largest; rows without words are equal to none. The
mixture draws rows, so that a repeated id is drawn row by row, and keeps the last document of
a leaf whole; a missing language or source is a leaf of its own, and leaves without words are
not read. Texts of any length are read whole in every stage. Without documents every stage is
empty; without labels the learned rules keep what the base limits keep.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspan.llm import bpe, language, minhash, mixing, rules
from gridspan.llm.frames import table
from gridspan.session import materialize

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
#: Most of the corpus is read, once; large sources give way to small ones.
MIXTURE = mixing.Mixture(percent=80, epochs=1)
#: Percentage of common shingles from which two documents are near-duplicates.
SIMILAR = 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base limits and the learned list keep."""
    return rules.filtered(docs, table(spark, sf_dir, "labels"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the network knows."""
    return language.filtered(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return minhash.deduplicated(docs, SIMILAR)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the target weights draw."""
    return mixing.drawn(docs, MIXTURE)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether they decode to its text again."""
    encoded = bpe.encode(docs, RANKS, ["doc_id", "lang", "source"], check=True)
    return encoded.select(
        "doc_id", "lang", "source", F.size("ids").cast("bigint").alias("n_tokens"), "ids",
        "round_trip",
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("mixture", mixture),
    ("tokens", tokens),
]

#: Learned models have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents, one after the other."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
