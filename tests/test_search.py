"""Ledger of a grid search, its restart, and predictions of rows that no model has seen."""

from __future__ import annotations

import random

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from reviewgrove.operators.split import fold
from reviewgrove.plans import tuning
from reviewgrove.plans.search import Ledger, LedgerValidator, fold_shares, out_of_fold, run_key

GRID = tuning.Grid({"maxDepth": [1, 3], "numTrees": [3]}, 2)


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(4)
    rows = []
    for i in range(200):
        x, y = rng.random(), rng.random()
        rows.append((i, int(1 + 2 * (x > 0.5) + (y > 0.7)), Vectors.sparse(3, {0: x, 1: y})))
    df = spark.createDataFrame(rows, ["doc_id", "label", "tfidf"]).withColumn("fold", fold(F.col("doc_id"), 2))
    return df.repartition(2, "doc_id").persist()


def searched(data, ledger, **options):
    return tuning.search_of(tuning.plain_stages(GRID, "fold", ledger=ledger, **options).fit(data))


def test_same_scores_as_without_a_ledger(spark, data, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    plain = tuning.search_of(tuning.plain_stages(GRID, "fold").fit(data))
    kept = searched(data, ledger)
    assert kept.avgMetrics == pytest.approx(plain.avgMetrics)
    assert kept.bestModel.totalNumNodes == plain.bestModel.totalNumNodes
    assert len(ledger.finished(kept.run)) == 4


def test_second_start_fits_only_the_rest(spark, data, tmp_path, monkeypatch):
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    fitted = []
    fit_one = LedgerValidator.fit_one

    def failing(self, train, point):
        if len(fitted) == 3:
            raise RuntimeError("stopped")
        fitted.append(point)
        return fit_one(self, train, point)

    monkeypatch.setattr(LedgerValidator, "fit_one", failing)
    with pytest.raises(RuntimeError, match="stopped"):
        searched(data, ledger, parallelism=1)
    assert ledger.rows().count() == 3

    def counting(self, train, point):
        fitted.append(point)
        return fit_one(self, train, point)

    monkeypatch.setattr(LedgerValidator, "fit_one", counting)
    del fitted[:]
    second = searched(data, Ledger(spark, str(tmp_path / "ledger")))
    # One fold model that was missing, and the best point on all rows.
    assert len(fitted) == 2
    del fitted[:]
    third = searched(data, Ledger(spark, str(tmp_path / "ledger")))
    assert len(fitted) == 1 and third.avgMetrics == second.avgMetrics and third.run == second.run
    del fitted[:]
    searched(data, Ledger(spark, str(tmp_path / "ledger")), seed=9)
    assert len(fitted) == 5


def test_run_key_tells_data_apart(data):
    forest = tuning.forest()
    points = tuning.param_maps(forest, GRID.values)
    key = run_key(data, forest, points, "fold", 2)
    assert key == run_key(data.repartition(5), forest, points, "fold", 2)
    assert key != run_key(data.filter("doc_id > 0"), forest, points, "fold", 2)
    assert key != run_key(data, forest, points[:1], "fold", 2)


def test_every_row_is_scored_by_a_model_that_has_not_seen_it(spark, data, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    search = searched(data, ledger)
    scored = out_of_fold(data, ledger, search.run, [0, 1], 2).persist()
    assert scored.count() == 2 * data.count() == scored.select("doc_id", "point").distinct().count()
    shares = {(r.point, r.fold): r.share for r in fold_shares(scored, "label").collect()}
    for point in (0, 1):
        assert (shares[point, 0] + shares[point, 1]) / 2 == pytest.approx(search.avgMetrics[point])
        for part in (0, 1):
            model = tuning.forest(maxDepth=[1, 3][point], numTrees=3).fit(data.filter(F.col("fold") != part))
            expected = {r.doc_id: r.prediction for r in model.transform(data.filter(F.col("fold") == part)).collect()}
            own = scored.filter((F.col("point") == point) & (F.col("fold") == part)).collect()
            assert {r.doc_id: r.prediction for r in own} == expected


def test_ledger_needs_folds(spark, data, tmp_path):
    with pytest.raises(ValueError, match="column of folds"):
        tuning.plain_stages(GRID, ledger=Ledger(spark, str(tmp_path / "ledger"))).fit(data)
