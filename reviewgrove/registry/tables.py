"""Review records made from the tables ``documents`` and ``labels``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewgrove.plans.features import ID, TEXT
from reviewgrove.sources.reviews import REVIEW_SCHEMA, spread

RECORD_SCHEMA = T.StructType([T.StructField(ID, T.LongType()), *REVIEW_SCHEMA.fields])


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Columns of ``documents``; text work gets at least one task per core."""
    df = spark.read.parquet(f"{sf_dir}/documents.parquet").select(ID, *columns)
    return spread(df, ID) if "text" in columns else df


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def overall() -> Column:
    """Rating from 1 to 4 out of the two labels."""
    return (1 + 2 * F.col("quality") + (1 - F.col("toxic"))).cast("double")


def reviews(spark: SparkSession, sf_dir: str, labelled: bool = True) -> DataFrame:
    """``doc_id, reviewText, overall``. Without a hint: Spark sees the size of both sides."""
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select(ID, F.col("text").alias(TEXT))
    rated = labels(spark, sf_dir).select(ID, overall().alias("overall"))
    return spread(texts.join(rated, ID, "inner" if labelled else "left"), ID)


def side_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The side columns of a review, computed from ``doc_id`` and ``lang``."""
    return documents(spark, sf_dir, "lang").select(ID, *side_values())


def side_values() -> list[Column]:
    n = F.col(ID)
    return [
        F.when(n % 3 == 0, "none").when(n % 7 == 1, F.concat(n, F.lit(" votes"))).otherwise(n.cast("string")).alias("vote"),
        F.when(n % 2 == 0, F.lpad(n.cast("string"), 10, "0")).otherwise(F.concat(F.lit("B"), n)).alias("asin"),
        F.struct(F.col("lang").alias("Format:")).alias("style"),
        F.when(n % 13 == 0, "no date")
        .otherwise(F.concat_ws("", F.lpad((n % 12 + 1).cast("string"), 2, "0"), F.lit(" "), n % 28 + 1, F.lit(", "), 2000 + n % 20))
        .alias("reviewTime"),
        (F.lit(1262304000) + n * 86461).alias("unixReviewTime"),
    ]
