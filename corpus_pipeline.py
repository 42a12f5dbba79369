"""From raw documents to packed sequences: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from reviewgrove.llm import decontamination, language_model, near_dedup, packing, quality_rules
from reviewgrove.llm.queries import table, tokenizer
from reviewgrove.session import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go whose perplexity under a model of trusted text is too high for their language."""
    return language_model.keep_documents(docs, table(spark, sf_dir, "labels"))


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that fail a base rule or read too little like trusted text."""
    return quality_rules.keep_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five-word shingles, similarity of 0.8 or more."""
    return near_dedup.drop_copies(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that hold too much of a test item."""
    return decontamination.drop_documents(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in sequences of at most 2048: one row per piece of a document."""
    pieces = packing.pack(docs, tokenizer("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids")


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", rules),
    ("near_dedup", near_duplicates),
    ("decontamination", decontaminate),
    ("packing", pack),
]
# Several stages train models or compare sets across documents, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
