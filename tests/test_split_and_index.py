"""Parts, folds, label and feature indexes."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.ml.feature import CountVectorizer, IDF, StringIndexer, VectorIndexer
from pyspark.sql import functions as F

from reviewgrove.operators import indexing, split
from reviewgrove.operators.terms import term_counts


def _parts(df):
    return {r.id: (r.part, r.fold) for r in df.select("id", split.part(F.col("id")).alias("part"), split.fold(F.col("id"), 5).alias("fold")).collect()}


def test_parts_do_not_depend_on_layout(spark):
    df = spark.range(2000)
    parts = _parts(df.repartition(1))
    assert parts == _parts(df.repartition(7))
    assert len(parts) == 2000
    for i, (part, fold) in parts.items():
        digest = hashlib.md5(str(i).encode()).hexdigest()
        assert part == ("train" if int(digest[:8], 16) % 100 < 75 else "test")
        assert fold == int(digest[8:16], 16) % 5


def test_folds_do_not_follow_parts(spark):
    parts = _parts(spark.range(20_000)).values()
    for fold in range(5):
        inside = [part for part, f in parts if f == fold]
        assert 0.72 < inside.count("train") / len(inside) < 0.78


def test_random_parts_cover_all_rows_once(spark):
    train, test = split.random_parts(spark.range(1000))
    assert sorted(r.id for r in train.union(test).collect()) == list(range(1000))


LABELS = [3] * 5 + [1] * 7 + [2] * 5 + [10] * 5 + [4]


def test_label_index_equals_string_indexer(spark):
    df = spark.createDataFrame([(v,) for v in LABELS] + [(None,)], "label int")
    got = sorted((r.idx, str(r.label)) for r in indexing.label_index(df).collect())
    model = StringIndexer(inputCol="label", outputCol="idx").fit(df.dropna())
    assert [label for _, label in got] == list(model.labels) == ["1", "10", "2", "3", "4"]


@pytest.mark.parametrize("limit", [indexing.BROADCAST_LIMIT, 0])
def test_unindex_gives_the_label_back(spark, monkeypatch, limit):
    monkeypatch.setattr(indexing, "BROADCAST_LIMIT", limit)
    df = spark.createDataFrame(list(enumerate(LABELS)), "id int, label int")
    index = indexing.label_index(df)
    coded = df.join(index, "label").select("id", F.col("idx").alias("prediction"))
    back = indexing.label_unindex(coded, index, "prediction", "name").collect()
    assert {r.id: r.name for r in back} == {i: str(v) for i, v in enumerate(LABELS)}


def test_feature_categories_equal_vector_indexer(spark):
    docs = [["all"] * (i % 7 + 1) + ["few"] * (i % 3) + ["many"] * (i % 9) + ["four"] * (i % 4) + ["one"] * (i == 5) for i in range(40)]
    df = spark.createDataFrame(list(enumerate(docs)), "id int, w array<string>")
    cells = term_counts(df, "w", keep=["id"])
    counts = CountVectorizer(inputCol="w", outputCol="n").fit(df)
    vectors = counts.transform(df)
    weights = IDF(inputCol="n", outputCol="tfidf").fit(vectors).transform(vectors)
    model = VectorIndexer(inputCol="tfidf", outputCol="i", maxCategories=4).fit(weights)
    expected = {term: i in model.categoryMaps for i, term in enumerate(counts.vocabulary)}
    got = indexing.feature_categories(cells, len(docs)).collect()
    assert {r.term: r.is_categorical for r in got} == expected
    assert {r.term: r.n_values for r in got} == {"all": 1, "few": 3, "many": 9, "four": 4, "one": 2}
