"""The registered queries of the corpus operators, with their production parameters.

Each runs over its whole table. How missing, empty, long and repeated rows are treated is said
in the operator's module.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from gridspan.llm import (
    bpe, chat, fingerprint, language, licenses, lm, merkle, minhash, mixing, quality, rules, variants,
    warc,
)
from gridspan.llm.frames import table

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every whole text by the rank file, digested, and decoded again."""
    return bpe.digests(table(spark, sf_dir, "documents"), RANKS)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places and labels of license phrases, and labels of notices, of every text."""
    return licenses.scan(table(spark, sf_dir, "documents"))


def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of near-duplicates of every document, at 85 %."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op4_log_bilinear_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and model log-probability of every text; remainder 2 of 7 is held out."""
    return lm.score(table(spark, sf_dir, "documents"))


def op5_lz_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and its edited text, and how like they are."""
    return fingerprint.fingerprints(table(spark, sf_dir, "documents"))


def op6_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written into archives, read back and put into a capture history."""
    return warc.archived(table(spark, sf_dir, "pages"))


def op7_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every text; labels of remainder 0 of 5 are held out."""
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text; remainder 2 of 4 is held out."""
    return language.identified(table(spark, sf_dir, "documents"))


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, budget, epochs and tokens read of every document."""
    return mixing.mixed(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base verdict and learned verdict of every text."""
    return rules.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document, checked against a copy tampered with."""
    return merkle.checked(table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near words, form and root of every word that occurs often enough."""
    return variants.grouped(table(spark, sf_dir, "documents"))


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is read back from every formatted conversation, the planted one included."""
    return chat.digests(chat.with_planted(table(spark, sf_dir, "conversations")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_license_scan": op2_license_scan,
    "op3_minhash_dedup": op3_minhash_dedup,
    "op4_log_bilinear_lm": op4_log_bilinear_lm,
    "op5_lz_fingerprint": op5_lz_fingerprint,
    "op6_warc_index": op6_warc_index,
    "op7_rule_ensemble": op7_rule_ensemble,
    "op8_language_id": op8_language_id,
    "op9_source_mixing": op9_source_mixing,
    "op10_quality_rules": op10_quality_rules,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_chat_format": op13_chat_format,
}

ORACLE: dict[str, str] = {
    "op3_minhash_dedup": minhash.sql(),
    "op6_warc_index": warc.SQL,
    "op9_source_mixing": mixing.sql(),
    "op11_merkle_manifest": merkle.sql(),
    "op12_spelling_variants": variants.sql(),
    "op13_chat_format": chat.SQL,
}
