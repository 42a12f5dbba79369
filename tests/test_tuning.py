"""Forest, grid, folds, report."""

from __future__ import annotations

import random

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from reviewgrove.operators.scores import accuracy, accuracy_evaluator
from reviewgrove.operators.split import fold
from reviewgrove.plans import report, tuning

SMALL = tuning.Grid({"bootstrap": [True], "maxDepth": [1, 4], "minInfoGain": [0.0], "impurity": ["gini"], "numTrees": [3]}, 2)


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(1)
    rows = []
    for i in range(240):
        x, y = rng.random(), rng.random()
        rows.append((i, int(1 + 2 * (x > 0.5) + (y > 0.7)), Vectors.sparse(3, {0: x, 1: y})))
    df = spark.createDataFrame(rows, ["doc_id", "label", "tfidf"]).withColumn("label", F.col("label").cast("int"))
    return df.withColumn("fold", fold(F.col("doc_id"), 2)).repartition(2, "doc_id").persist()


def test_grid_sizes():
    sizes = {name: (len(tuning.param_maps(tuning.forest(), grid.values)), grid.folds) for name, grid in tuning.GRIDS.items()}
    assert sizes == {"default": (64, 3), "as_written": (64, 3), "indexed": (24, 5), "exploratory": (54, 5)}


def test_grid_order_is_fixed():
    forest = tuning.forest()
    points = [{p.name: v for p, v in m.items()} for m in tuning.param_maps(forest, {"maxDepth": [1, 2], "maxBins": [3, 4]})]
    assert points == [{"maxDepth": d, "maxBins": b} for d in (1, 2) for b in (3, 4)]


def test_search_repeats_and_reports_its_best_point(spark, data):
    first, second = (tuning.search_of(tuning.plain_stages(SMALL, "fold").fit(data)) for _ in range(2))
    assert first.avgMetrics == second.avgMetrics
    assert report.best_point(first) == max(range(2), key=lambda i: first.avgMetrics[i])
    assert first.avgMetrics[1] > first.avgMetrics[0]
    row = report.report(spark, first)
    assert [tuple(r) for r in row.collect()] == [(True, 4, 0.0, "gini", 3)]
    assert dict(row.dtypes) == {
        "bootstrap": "boolean", "maxDepth": "bigint", "minInfoGain": "double", "impurity": "string", "numTrees": "bigint"
    }
    scores = report.grid_scores(spark, first).orderBy("point").collect()
    assert [r.accuracy for r in scores] == first.avgMetrics and [r.maxDepth for r in scores] == [1, 4]


def test_first_of_equal_points_wins():
    class Search:
        avgMetrics = [0.5, 0.7, 0.7, 0.1]

    assert report.best_point(Search) == 1


def test_folds_may_be_random(data):
    assert len(tuning.search_of(tuning.plain_stages(SMALL).fit(data)).avgMetrics) == 2


def test_grid_as_written_cannot_learn(data):
    values = {name: choices[:1] for name, choices in tuning.GRIDS["as_written"].values.items()}
    model = tuning.forest(**{**{n: c[0] for n, c in values.items()}, "numTrees": 3}).fit(data)
    assert model.totalNumNodes == 3
    learns = {n: c[0] for n, c in tuning.GRIDS["default"].values.items()}
    assert tuning.forest(**{**learns, "numTrees": 3}).fit(data).totalNumNodes > 3


def test_missing_labels_are_rejected(data):
    with pytest.raises(ValueError, match="240 of 240 rows have no label"):
        tuning.check_labels(data.withColumn("label", F.lit(None).cast("int")))
    with pytest.raises(ValueError, match="no rows"):
        tuning.check_labels(data.limit(0))
    tuning.check_labels(data)


def test_indexed_stages(spark, data):
    train = data.filter("label < 4")
    model = tuning.indexed_stages(train, SMALL, "fold").fit(train)
    rows = model.transform(data).select("label", "predictedLabel").collect()
    assert {r.predictedLabel for r in rows} <= {"1", "2", "3"}
    hits = sum(str(r.label) == r.predictedLabel for r in rows)
    measured = accuracy(model.transform(data), tuning.INDEXED_LABEL, tuning.PREDICTION).first()
    assert measured.accuracy == pytest.approx(hits / 240) and hits > 120


def test_accuracy_equals_the_evaluator(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 1.0), (3.0, 3.0)], ["label", "prediction"])
    row = accuracy(df).first()
    assert (row.n_test, row.accuracy) == (3, pytest.approx(accuracy_evaluator().evaluate(df)))
    assert row.test_error == pytest.approx(1 / 3)
