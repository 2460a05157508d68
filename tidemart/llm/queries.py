"""Queries of the corpus operators by name, and the SQL they must equal where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemart.llm import decontaminate, filter_audit, hash_tree, lm, near_dups, neighbours, oracles, pieces, pii, string_kernel, substrings, token_alignment, toxicity, warc
from tidemart.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_deobfuscated_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.span_report(table(spark, sf_dir, "documents"))


def op2_sampled_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.piece_report(table(spark, sf_dir, "documents"))


def op3_simhash_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leak_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_weak_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_adaptive_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.neighbour_report(table(spark, sf_dir, "embeddings"))


def op6_hash_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_tree.shard_report(table(spark, sf_dir, "documents"))


def op7_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicate_report(table(spark, sf_dir, "documents"))


def op8_warc_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.capture_report(table(spark, sf_dir, "pages"))


def op9_elias_fano_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_report(table(spark, sf_dir, "documents"))


def op10_difference_cover_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeat_report(table(spark, sf_dir, "documents"))


def op11_string_kernel_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return string_kernel.language_report(table(spark, sf_dir, "documents"))


def op12_fragment_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.alignment_report(table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries() -> dict[str, Query]:
    found = [
        op1_deobfuscated_pii,
        op2_sampled_pieces,
        op3_simhash_leaks,
        op4_weak_toxicity,
        op5_adaptive_neighbours,
        op6_hash_tree_shards,
        op7_circulant_minhash,
        op8_warc_captures,
        op9_elias_fano_scores,
        op10_difference_cover_repeats,
        op11_string_kernel_languages,
        op12_fragment_alignment,
        op13_filter_audit,
    ]
    return {fn.__name__: fn for fn in found}


def oracle_sql() -> dict[str, str]:
    return {
        "op7_circulant_minhash": oracles.OP7,
        "op8_warc_captures": oracles.OP8,
        "op10_difference_cover_repeats": oracles.OP10,
        "op13_filter_audit": oracles.OP13,
    }
