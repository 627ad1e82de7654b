"""Named queries of the text operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from holdfast.llm import (
    bitplane_kmeans,
    chat,
    exact_dedup,
    hilbert_negatives,
    html_density,
    line_rules,
    mixing,
    packing,
    parity_join,
    quality_conv,
    token_counts,
    toxicity,
    winnowing,
)
from holdfast.llm.common import table


def tokenizer_file(name: str) -> str:
    """Path of a public tokenizer's file, as installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_conv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_conv.quality_query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.chat_query(table(spark, sf_dir, "conversations"))


def op3_html_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_density.html_query(table(spark, sf_dir, "pages"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decide(table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packing_query(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_query(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixing_query(table(spark, sf_dir, "documents"))


def op9_parity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity_join.join_query(table(spark, sf_dir, "documents"))


def op10_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.rules_query(table(spark, sf_dir, "documents"))


def op11_bitplane_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitplane_kmeans.kmeans_query(table(spark, sf_dir, "embeddings"))


def op12_hilbert_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_negatives.negatives_query(table(spark, sf_dir, "embeddings"))


def op13_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.fingerprint_query(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    listed = (
        op1_quality_conv,
        op2_chat_format,
        op3_html_density,
        op4_toxicity,
        op5_exact_dedup,
        op6_packing,
        op7_token_counts,
        op8_mixing,
        op9_parity_join,
        op10_line_rules,
        op11_bitplane_kmeans,
        op12_hilbert_negatives,
        op13_winnowing,
    )
    return {f.__name__: f for f in listed}


def oracle_sql() -> dict[str, str]:
    return {
        "op5_exact_dedup": exact_dedup.ORACLE,
        "op8_mixing": mixing.ORACLE,
        "op10_line_rules": line_rules.ORACLE,
        "op11_bitplane_kmeans": bitplane_kmeans.ORACLE,
        "op12_hilbert_negatives": hilbert_negatives.ORACLE,
    }
