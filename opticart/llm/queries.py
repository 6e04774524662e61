"""Registered queries of the numbered operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from opticart.llm import (conversation_repair, decontaminate, html_extract, jaccard_forest,
                          language_mix, line_dedup, merkle_manifest, packing, piecewise_hash, pii,
                          quality_rank, quality_rules, sql, substring_dedup)
from opticart.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_language_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learnt from those not held out."""
    return language_mix.identify(table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that resemble an earlier line."""
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words covered by repeated windows of 35 words removed, per document."""
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), with_text=False)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 1024 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rules and the verdict of the learnt thresholds, per document."""
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with pseudonyms in place of personal numbers, dates and addresses."""
    return pii.pseudonymise(table(spark, sf_dir, "documents"))


def op7_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op8_quality_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learnt from labels that are not held out."""
    return quality_rank.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, also with other numbers and names."""
    return (decontaminate.leaks(table(spark, sf_dir, "documents"),
                                table(spark, sf_dir, "benchmark")).drop("mark"))


def op10_jaccard_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near-duplicates and number of links of every document."""
    return (jaccard_forest.jaccard_classes(table(spark, sf_dir, "documents"))
            .select("doc_id", "class_id", "copies", "n_links"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and repaired digest of every damaged conversation."""
    rows = conversation_repair.damaged(table(spark, sf_dir, "conversations"))
    return conversation_repair.repair(rows, present="present")


def op12_piecewise_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likenesses."""
    return piecewise_hash.compared_with_next(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots, proof and verification of every document, some of them tampered with."""
    return merkle_manifest.manifest(table(spark, sf_dir, "documents"), merkle_manifest.by_crc())


QUERIES: dict[str, Query] = {
    "op1_language_mix": op1_language_mix,
    "op2_line_dedup": op2_line_dedup,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_packing": op4_packing,
    "op5_quality_rules": op5_quality_rules,
    "op6_pii": op6_pii,
    "op7_html_extract": op7_html_extract,
    "op8_quality_rank": op8_quality_rank,
    "op9_decontamination": op9_decontamination,
    "op10_jaccard_forest": op10_jaccard_forest,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_piecewise_hash": op12_piecewise_hash,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLE_SQL: dict[str, str] = {
    "op2_line_dedup": sql.OP2,
    "op5_quality_rules": sql.OP5,
    "op9_decontamination": sql.OP9,
}
