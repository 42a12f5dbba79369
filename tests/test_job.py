"""The whole job on a small file of reviews."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from reviewgrove import __main__ as command
from reviewgrove import session
from reviewgrove.operators.vectors import vocabulary_of
from reviewgrove.plans import job, tuning
from reviewgrove.plans.features import weight_stage
from reviewgrove.plans.search import Ledger, fold_shares, out_of_fold

GRID = tuning.Grid({"bootstrap": [True], "maxDepth": [2, 4], "numTrees": [3], "minInfoGain": [0.0], "impurity": ["gini"]}, 2)
GOOD = "great wonderful loving superb enjoyed".split()
BAD = "awful boring terrible wasted disappointing".split()


@pytest.fixture(scope="module")
def reviews_path(tmp_path_factory):
    rng = random.Random(2)
    path = tmp_path_factory.mktemp("in") / "reviews.json"
    with open(path, "w") as out:
        for i in range(300):
            good = rng.random() < 0.6
            words = [rng.choice(GOOD if good else BAD) for _ in range(6)] + ["books"] * rng.randint(0, 2)
            record = {
                "asin": f"{i:010d}", "overall": 5.0 if good else 1.0, "reviewText": " ".join(words) + " 5pm\n",
                "reviewerID": f"A{i}", "unixReviewTime": i, "verified": True, "vote": "none",
            }
            out.write(json.dumps(record) + "\n")
    return str(path)


@pytest.mark.parametrize("with_indexers", [False, True])
def test_report_goes_to_csv(spark, reviews_path, tmp_path, capsys, with_indexers):
    result = job.run(spark, reviews_path, str(tmp_path / "out"), with_indexers=with_indexers, grid=GRID)
    written = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert written.columns == ["bootstrap", "maxDepth", "numTrees", "minInfoGain", "impurity"]
    assert written.count() == 1 and written.first().bootstrap == "true"
    row = result.accuracy.first()
    assert row.n_test == result.predictions.count() and 40 < row.n_test < 110
    assert row.accuracy > 0.9 and row.test_error == pytest.approx(1 - row.accuracy)
    assert result.scores.count() == 2
    assert "test_error" in capsys.readouterr().out


def test_trial_run_shows_the_report(spark, reviews_path, capsys):
    result = job.run(spark, reviews_path, None, is_test=True, is_local=True, grid=GRID, min_df=5)
    assert "maxDepth" in capsys.readouterr().out
    words = result.predictions.count()
    assert 0 < words < 50


def test_words_come_from_the_training_part_only(spark):
    rows = [(i, "common words here", 5.0) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, reviewText string, overall double")
    parts = job.split_words(df, 2)
    test_ids = [r.doc_id for r in parts.filter("part = 'test'").collect()]
    df = df.withColumn(
        "reviewText", F.when(F.col("doc_id").isin(test_ids), "common words zebra").otherwise(F.col("reviewText"))
    ).withColumn("overall", 1.0 + F.col("doc_id") % 2)
    one = tuning.Grid({"maxDepth": [1], "numTrees": [1]}, 2)
    assert "zebra" not in vocabulary_of(job.learn(df, grid=one).features_model)
    assert "zebra" in vocabulary_of(job.learn(df, grid=one, fit_on_all=True).features_model)


def test_reviews_without_rating_are_rejected(spark):
    df = spark.createDataFrame([("good", 5.0), ("bad", None)], "reviewText string, overall double")
    with pytest.raises(ValueError, match="1 of 2 rows have no label"):
        job.learn(df)


def test_command_line(spark, reviews_path, tmp_path, monkeypatch):
    monkeypatch.setattr(command, "create_session", lambda is_local: spark)
    monkeypatch.setitem(command.GRIDS, "default", GRID)
    out = str(tmp_path / "out")
    monkeypatch.setattr("sys.argv", ["reviewgrove", reviews_path, out, "--grid", "default", "--vocab-size", "50"])
    command.main()
    assert spark.read.option("header", True).csv(out).count() == 1


def test_parquet_input(spark, reviews_path, tmp_path):
    source = str(tmp_path / "books")
    df = spark.read.json(reviews_path).withColumn("product_category", F.lit("Books"))
    df.write.partitionBy("product_category").parquet(source)
    from_json = job.run(spark, reviews_path, str(tmp_path / "a"), grid=GRID, infer=True)
    from_parquet = job.run(
        spark, f"{source}/product_category=Books/*.parquet", str(tmp_path / "b"), grid=GRID, input_format="parquet"
    )
    assert from_parquet.accuracy.first().n_test == from_json.accuracy.first().n_test
    with pytest.raises(ValueError, match="json or parquet"):
        job.run(spark, source, None, input_format="xml")


def test_command_line_needs_an_output(monkeypatch):
    monkeypatch.setattr("sys.argv", ["reviewgrove", "in.json"])
    with pytest.raises(SystemExit):
        command.main()


def test_session_factory(spark):
    assert session.create_session(False) is spark


def test_bounds_of_the_forest(spark):
    rows = spark.range(4000).select(F.col("id").alias(job.ID))
    assert 300 < job.bounded_rows(rows, 400).count() < 500
    assert job.bounded_rows(rows, 4000).count() == 4000
    rows = [(i, int(i % 5 > 2), [f"w{k}" for k in range(i % 5 + 1)]) for i in range(60)]
    words = spark.createDataFrame(rows, "doc_id long, label int, words_stemmed array<string>")
    model = weight_stage(min_df=1).fit(words)
    small = job.bounded_features(model, words, 2).transform(words)
    assert job.bounded_features(model, words, 5) is model
    full = {r.doc_id: r.tfidf for r in model.transform(words).collect()}
    # w3 is the label itself, w2 comes closest to it.
    for r in small.collect():
        assert list(r.tfidf.toArray()) == list(full[r.doc_id].toArray()[2:4])


def test_search_scores_all_rows_of_a_bounded_forest(spark, reviews_path, tmp_path):
    """The forest may be fitted on fewer rows; the scores and out-of-fold predictions are of all training rows."""
    reviews = spark.read.json(reviews_path)
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    result = job.learn(reviews, grid=GRID, forest_rows=90, ledger=ledger.path)
    n_train = reviews.count() - result.predictions.count()
    marked = result.train.filter("fitted").count()
    assert result.train.count() == n_train > marked > 50
    scored = out_of_fold(result.train, ledger, result.run, [0, 1], GRID.folds)
    shares = {(r.point, r.fold): (r.n_rows, r.share) for r in fold_shares(scored, "label").collect()}
    assert sum(n for (point, _), (n, _) in shares.items() if point == 0) == n_train
    kept = {(r.point, r.fold): r.score for r in ledger.rows().collect()}
    assert kept == {key: pytest.approx(share) for key, (_, share) in shares.items()}
    other = job.learn(reviews, grid=GRID, forest_rows=60, ledger=ledger.path)
    assert other.run != result.run
    assert other.train.filter("fitted").count() < marked
