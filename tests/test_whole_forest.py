"""Forests are fitted on all training rows and all terms of the vocabulary, unless a caller asks for less."""

from __future__ import annotations

from itertools import islice, product

import pytest
from pyspark.sql import functions as F

from reviewgrove.operators.vectors import vocabulary_of
from reviewgrove.plans import job, tuning
from reviewgrove.plans.search import FITTED
from reviewgrove.registry import queries

# More than 32,768 and 50,000, which were the limits.
N_TERMS, N_ROWS = 33_000, 70_000


@pytest.fixture
def given(monkeypatch):
    """``(rows, terms)`` of every forest that is fitted."""
    found, fit = [], tuning.MarkedForest._fit

    def noting(self, dataset):
        model = fit(self, dataset)
        found.append(((dataset.filter(FITTED) if FITTED in dataset.columns else dataset).count(), model.numFeatures))
        return model

    monkeypatch.setattr(tuning.MarkedForest, "_fit", noting)
    return found


@pytest.fixture
def learnt(monkeypatch):
    """Results of the jobs that run."""
    found, learn = [], job.learn

    def noting(*args, **options):
        found.append(learn(*args, **options))
        return found[-1]

    monkeypatch.setattr(job, "learn", noting)
    return found


def written(spark, folder, texts):
    """The tables ``documents`` and ``labels``, with two of the four labels."""
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs.write.parquet(f"{folder}/documents.parquet")
    docs.select("doc_id", (F.col("doc_id") % 3 % 2).cast("int").alias("quality"), F.lit(0).alias("toxic")).write.parquet(f"{folder}/labels.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def many_terms(spark, tmp_path_factory):
    """Forty texts of which every second one has a word; no word has a digit or a suffix."""
    words = ["".join(letters) for letters in islice(product("bcdfghjkm", repeat=5), N_TERMS)]
    return written(spark, tmp_path_factory.mktemp("terms"), [" ".join(words[i % 2 :: 2]) for i in range(40)])


@pytest.mark.parametrize("name", ["indexed_accuracy", "out_of_fold_scores", "forest_accuracy"])
def test_forests_are_given_all_terms(spark, many_terms, given, learnt, name):
    rows = queries.REGISTERED[name](spark, many_terms).collect()
    assert given and {terms for _, terms in given} == {N_TERMS}
    assert all((result.n_terms, result.n_left_out) == (N_TERMS, 0) for result in learnt)
    if name == "out_of_fold_scores":
        assert len(rows) == 4 and all(r.is_score and r.is_mean for r in rows)
    else:
        assert len(rows) == 1 and rows[0].is_hit_share


def test_forests_are_given_all_rows(spark, given):
    kind = F.col("id") % 2
    reviews = spark.range(N_ROWS, numPartitions=4).select(
        F.col("id").alias(job.ID), F.when(kind == 1, "great book").otherwise("awful book").alias("reviewText"), (1.0 + kind).alias("overall")
    )
    with job.learn(reviews, grid=tuning.Grid({"maxDepth": [1], "numTrees": [1], "bootstrap": [False]}, 2)) as result:
        n_train = N_ROWS - result.accuracy.first().n_test
        root = tuning.search_of(result.model).bestModel.trees[0]._call_java("rootNode")
        assert root.impurityStats().rawCount() == n_train > 50_000
        assert given[-1][0] == n_train == sum(rows for rows, _ in given[:-1])


def test_learnt_rule_learns_from_all_terms(spark, tmp_path, given, learnt):
    words = "river stone cloud ember frost".split()
    sf_dir = written(spark, tmp_path, [" ".join(w for k, w in enumerate(words) if (i >> k) % 2) for i in range(200)])
    row = queries.learnt_rule(spark, sf_dir).first()
    assert (row.maxDepth, row.accuracy, row.two_terms) == (2, 1.0, True)
    assert {terms for _, terms in given} == {len(vocabulary_of(learnt[0].features_model))} == {7} and learnt[0].n_left_out == 0


def test_models_at_a_time():
    assert job.models_at_a_time(100, 1000, 4) == job.models_at_a_time(0, 0, 4) == 4
    assert job.models_at_a_time(15_000, 50_000, 4) == 2
    assert job.models_at_a_time(80_000, 100_000, 4) == 1
