"""One query per operator of this folder, over whole tables, and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from reviewgrove.llm import (
    decontamination,
    html_text,
    id_blocks,
    language_model,
    mixing,
    near_dedup,
    packing,
    perspectives,
    quality_rules,
    ranked_search,
    sharding,
    spelling,
    url_filter,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    """Place of a public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perspectives.perspectives(table(spark, sf_dir, "conversations"))


def op2_id_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return id_blocks.id_digests(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def op3_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.piece_digests(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.texts(table(spark, sf_dir, "pages"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.verdicts(table(spark, sf_dir, "pages"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), size=2, percent=80)


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_hash_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assignments(table(spark, sf_dir, "documents"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"))


REGISTERED: dict[str, Query] = {
    "op1_perspectives": op1_perspectives,
    "op2_id_blocks": op2_id_blocks,
    "op3_language_model": op3_language_model,
    "op4_pack": op4_pack,
    "op5_html_text": op5_html_text,
    "op6_url_filter": op6_url_filter,
    "op7_near_dedup": op7_near_dedup,
    "op8_decontaminate": op8_decontaminate,
    "op9_quality_rules": op9_quality_rules,
    "op10_hash_ring": op10_hash_ring,
    "op11_ranked_search": op11_ranked_search,
    "op12_spelling": op12_spelling,
    "op13_mixing": op13_mixing,
}
SQL: dict[str, str] = {
    "op1_perspectives": perspectives.SQL,
    "op6_url_filter": url_filter.sql(),
    "op11_ranked_search": ranked_search.SQL,
    "op12_spelling": spelling.SQL,
    "op13_mixing": mixing.SQL,
}
