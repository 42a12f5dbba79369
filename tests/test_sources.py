"""Readers, writers, side columns, shared folder."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from reviewgrove import session
from reviewgrove.functions import fields
from reviewgrove.operators.collapse import collapse_first
from reviewgrove.sources import records, reviews, sinks

LINES = """\
{"asin":"000100039X","image":["a.jpg"],"overall":4.9,"reviewText":"Good\\nbook 5pm","reviewTime":"09 1, 2016","reviewerID":"A1","reviewerName":"N","style":{"Format:":" Hardcover"},"summary":"s","unixReviewTime":1472688000,"verified":true,"vote":"12"}
{"asin":"123","overall":-4.9,"reviewTime":"not a date","unixReviewTime":0,"vote":"none"}
{"overall":1.0,"reviewText":"","vote":"many"}
"""


@pytest.fixture()
def path(tmp_path):
    (tmp_path / "reviews.json").write_text(LINES)
    return str(tmp_path / "reviews.json")


def test_json_with_schema(spark, path):
    rows = reviews.read_reviews_json(spark, path).collect()
    assert [r.overall for r in rows] == [4.9, -4.9, 1.0]
    assert rows[0].style["Format:"] == " Hardcover" and rows[0].image == ["a.jpg"]
    assert [r.reviewText for r in rows] == ["Good\nbook 5pm", None, ""]


def test_json_columns_and_inference(spark, path):
    narrow = reviews.read_reviews_json(spark, path, columns=["reviewText", "overall"])
    assert narrow.columns == ["reviewText", "overall"]
    inferred = reviews.read_reviews_json(spark, path, schema=None)
    assert sorted(inferred.columns) == sorted(reviews.REVIEW_SCHEMA.names)
    assert reviews.read_reviews_json(spark, path, schema=None, columns=["overall"]).columns == ["overall"]


def test_side_columns(spark, path):
    df = reviews.read_reviews_json(spark, path)
    rows = df.select(
        fields.label(F.col("overall")).alias("label"),
        fields.vote_number(F.col("vote")).alias("vote"),
        fields.asin_number(F.col("asin")).alias("asin"),
        fields.style_format(F.col("style")).alias("style"),
        fields.epoch_time(F.col("unixReviewTime")).alias("epoch"),
        fields.review_time(F.col("reviewTime")).alias("time"),
    ).collect()
    assert [r.label for r in rows] == [4, -4, 1]
    assert [r.vote for r in rows] == [12.0, None, None]
    assert [r.asin for r in rows] == [None, 123.0, None]
    assert [r.style for r in rows] == [" Hardcover", None, None]
    assert [r.epoch for r in rows] == ["2016-09-01 00:00:00", "1970-01-01 00:00:00", None]
    assert [r.time for r in rows] == [datetime.datetime(2016, 9, 1), None, None]


@pytest.mark.parametrize("zone", ["America/Los_Angeles", "Asia/Kolkata"])
def test_times_do_not_depend_on_the_zone(spark, path, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        test_side_columns(spark, path)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_drop_ignores_missing_columns(spark, path):
    df = fields.drop_unused(reviews.read_reviews_json(spark, path))
    assert df.columns == ["reviewText"]
    assert fields.drop_unused(df).columns == ["reviewText"]


def test_review_id(spark, path):
    df = reviews.read_reviews_json(spark, path)
    ids = [r.doc_id for r in reviews.with_review_id(df.union(df)).collect()]
    assert ids[:3] == ids[3:] and len(set(ids)) == 3
    own = df.withColumn("doc_id", F.lit(1))
    assert reviews.with_review_id(own) is own


def test_partitions(spark, tmp_path):
    df = spark.range(90).select("id", F.concat(F.lit("c"), F.col("id") % 3).alias("kind"))
    reviews.write_partitioned(df, str(tmp_path), "kind")
    one = reviews.read_reviews_parquet(spark, f"{tmp_path}/kind=c1/*.parquet", base_path=str(tmp_path))
    assert {(r.id % 3, r.kind) for r in one.collect()} == {(1, "c1")} and one.count() == 30
    whole = reviews.read_reviews_parquet(spark, str(tmp_path), schema=df.schema)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, df.collect()))


def test_spread_only_touches_small_inputs(spark):
    cores = spark.sparkContext.defaultParallelism
    assert reviews.spread(spark.range(10, numPartitions=1), "id").rdd.getNumPartitions() == 2 * cores
    many = spark.range(10, numPartitions=cores)
    assert reviews.spread(many, "id") is many


def test_csv_keeps_blanks_quotes_and_empty_text(spark, tmp_path):
    rows = [(1, " a b "), (2, ""), (3, None), (4, 'say "hi", you'), (5, "back\\slash")]
    df = spark.createDataFrame(rows, "id int, text string")
    sinks.write_csv(df, str(tmp_path / "out"))
    sinks.write_csv(df, str(tmp_path / "out"))
    assert sorted(map(tuple, sinks.read_csv(spark, str(tmp_path / "out"), df.schema).collect())) == rows


def test_records_keep_their_types(spark):
    given = [{"bootstrap": True}, {"maxDepth": 5}, {"minInfoGain": 0.01}, {"impurity": "gini"}, {"minInfoGain": 1}]
    df = records.records_to_frame(spark, given)
    assert dict(df.dtypes) == {"bootstrap": "boolean", "maxDepth": "bigint", "minInfoGain": "double", "impurity": "string"}
    assert df.count() == 5
    row = collapse_first(df.limit(4))
    assert row.columns == list(df.columns)
    assert [tuple(r) for r in row.collect()] == [(True, 5, 0.01, "gini")]


def test_records_without_a_common_type(spark):
    with pytest.raises(TypeError, match="depth"):
        records.records_to_frame(spark, [{"depth": 1}, {"depth": "x"}])
    assert records.records_to_frame(spark, [{"x": None}]).dtypes == [("x", "string")]


def test_stage_and_held(spark):
    df = spark.range(30).select("id", (F.col("id") % 3).cast("string").alias("kind"))
    copy = session.stage(df, "copy", partition_by=["kind"])
    assert sorted(map(tuple, copy.collect())) == sorted(map(tuple, df.collect()))
    assert session.stage(df, "copy").inputFiles() != session.stage(df, "copy").inputFiles()
    with session.held(df) as kept:
        assert kept.storageLevel.useMemory and kept.storageLevel.useDisk
    assert not df.storageLevel.useMemory


class _Context:
    """Stands in for a context without a folder for checkpoints."""

    def __init__(self, master):
        self.master = master
        self.folder = None

    def getCheckpointDir(self):  # noqa: N802
        return self.folder

    def setCheckpointDir(self, folder):  # noqa: N802
        self.folder = folder


class _Session:
    def __init__(self, master, **conf):
        self.conf = conf
        self.sparkContext = _Context(master)


def test_the_folder_named_by_the_session_comes_first():
    named = _Session("yarn", **{"spark.checkpoint.dir": "hdfs:///shared/"})
    assert session.shared_folder(named) == "hdfs:///shared/"
    first, second = session.fresh_path(named, "words"), session.fresh_path(named, "words")
    assert first.startswith("hdfs:///shared/reviewgrove/words-") and first != second


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(_Session("yarn"))


def test_a_local_session_gets_a_folder_of_its_own():
    local = _Session("local[2]")
    assert session.shared_folder(local) == session.shared_folder(local) == local.sparkContext.folder


def test_ratings_as_text_and_ids_without_partition_columns(spark):
    rows = [("r1", "a1", 5, "5.0", "good", "Books"), ("r2", "a1", 6, "none", "bad", "Music")]
    df = spark.createDataFrame(rows, "reviewerID string, asin string, unixReviewTime long, overall string, reviewText string, product_category string")
    assert [r.n for r in df.select(fields.label(F.col("overall")).alias("n")).collect()] == [5, None]
    wide, narrow = reviews.with_review_id(df), reviews.with_review_id(df.drop("product_category"))
    assert [r.doc_id for r in wide.collect()] == [r.doc_id for r in narrow.collect()]
    assert len({r.doc_id for r in wide.collect()}) == 2
