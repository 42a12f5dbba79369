"""Review records in JSON lines or Parquet."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewgrove.session import fresh_path, stage

REVIEW_SCHEMA = T.StructType(
    [
        T.StructField("asin", T.StringType()),
        T.StructField("image", T.ArrayType(T.StringType())),
        T.StructField("overall", T.DoubleType()),
        T.StructField("reviewText", T.StringType()),
        T.StructField("reviewTime", T.StringType()),
        T.StructField("reviewerID", T.StringType()),
        T.StructField("reviewerName", T.StringType()),
        T.StructField("style", T.StructType([T.StructField("Format:", T.StringType())])),
        T.StructField("summary", T.StringType()),
        T.StructField("unixReviewTime", T.LongType()),
        T.StructField("verified", T.BooleanType()),
        T.StructField("vote", T.StringType()),
    ]
)

_CORRUPT = "_corrupt_record"

# What tells one review from another.
ID_FIELDS = ("reviewerID", "asin", "unixReviewTime", "overall", "reviewText")


def read_reviews_json(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = REVIEW_SCHEMA,
    columns: Iterable[str] | None = None,
) -> DataFrame:
    """Scan JSON lines. ``schema=None`` infers it, which reads the whole input one extra time.

    ``columns`` narrows the schema, so the parser skips the fields that are not wanted.
    """
    if schema is None:
        df = spark.read.json(path)
        return df.select(*columns) if columns is not None else df
    if columns is not None:
        schema = T.StructType([schema[name] for name in columns])
    return spark.read.schema(schema).json(path)


@dataclass(frozen=True)
class ReviewScan:
    """``good`` records under the schema, and ``bad`` lines with the file they are from, in a written side table."""

    good: DataFrame
    bad: DataFrame

    def n_bad(self) -> int:
        return self.bad.count()


def read_reviews_checked(
    spark: SparkSession, path: str, bad_path: str | None = None, schema: T.StructType = REVIEW_SCHEMA
) -> ReviewScan:
    """Scan JSON lines and put aside those that are no record of ``schema``: broken JSON, or a value of another type.

    The plain reader turns such lines into nulls and tells nobody. Every line is parsed once; the parsed records
    are written in two folders, of which the bad ones are ``file, line`` at ``bad_path`` (default: the shared folder).
    Blank lines are no records and not bad. A field that the line lacks is null, as in the plain reader.
    """
    wider = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    parsed = lines.filter(F.trim("value") != "").select("file", F.from_json("value", wider, options).alias("record"), "value")
    # JSON that is no object gives a null record.
    is_bad = F.col("record").isNull() | F.col("record").getField(_CORRUPT).isNotNull()
    split = stage(parsed.withColumn("is_bad", is_bad), "json-lines", partition_by=["is_bad"])
    bad = split.filter("is_bad").select("file", F.col("value").alias("line"))
    if bad_path is not None:
        bad.write.mode("overwrite").parquet(bad_path)
        bad = spark.read.schema(bad.schema).parquet(bad_path)
    good = split.filter("NOT is_bad").select(*[F.col("record").getField(name).alias(name) for name in schema.names])
    return ReviewScan(good, bad)


def read_reviews(
    spark: SparkSession, path: str, input_format: str = "json", base_path: str | None = None, infer: bool = False
) -> DataFrame:
    """Scan reviews in one of the two formats."""
    if input_format == "json":
        return read_reviews_json(spark, path, schema=None if infer else REVIEW_SCHEMA)
    if input_format == "parquet":
        return read_reviews_parquet(spark, path, base_path)
    raise ValueError(f"input format is json or parquet, not {input_format!r}")


def write_reviews_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_reviews_parquet(
    spark: SparkSession,
    path: str,
    base_path: str | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Scan Parquet files or a glob such as ``<base>/product_category=Books/*.parquet``.

    With ``base_path`` the partition columns in the path stay columns of the result, so a filter on
    them prunes directories and needs no glob at all.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if base_path is not None:
        reader = reader.option("basePath", base_path)
    return reader.parquet(path)


def in_partitions_of(df: DataFrame, side: DataFrame, column: str) -> DataFrame:
    """Rows of a partitioned scan whose partition ``column`` is in the small table ``side``.

    Spark reads ``side`` first and scans only the directories that its values name, so a filter on
    another column of ``side`` prunes files. Without a hint: Spark broadcasts ``side`` if its size allows it, and prunes only then.
    """
    return df.join(side.select(column), column, "left_semi")


def write_partitioned(df: DataFrame, path: str, *columns: str) -> None:
    """Write Parquet directories per value of ``columns``.

    There is no shuffle by the partition columns: every task writes its own file per value, so a value
    that holds most of the rows is still written by all tasks.
    """
    df.write.mode("overwrite").partitionBy(*columns).parquet(path)


def spread(df: DataFrame, key: str | None) -> DataFrame:
    """Give text work two tasks per core, since long texts make uneven tasks. Rows are dealt by ``key``, or in turn without one.

    Only an input with fewer splits than cores is shuffled, for instance one small file. A large input
    has many splits already and passes through unchanged.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(2 * cores, *([] if key is None else [key]))


def with_review_id(df: DataFrame, name: str = "doc_id") -> DataFrame:
    """Add an id made of the fields that tell a review, for input without one.

    Only those fields are read, and other columns, such as those of partition directories, do not change the id.
    Copies of a review get the same id and therefore fall into the same part and the same fold.
    """
    if name in df.columns:
        return df
    parts = [F.coalesce(F.md5(F.col(key).cast("string")), F.lit("")) for key in ID_FIELDS if key in df.columns]
    return df.withColumn(name, F.md5(F.concat_ws("|", *parts)))


def json_copy(df: DataFrame, name: str, schema: T.StructType | None) -> DataFrame:
    """Write ``df`` as JSON lines to the shared folder and scan it back."""
    path = fresh_path(df.sparkSession, name)
    write_reviews_json(df, path)
    return read_reviews_json(df.sparkSession, path, schema=schema)
