"""Choice of terms, value mapping, weights by heat, quarantine, pruning, publishing, owned tables."""

from __future__ import annotations

import json
import os
import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.ml.feature import VectorIndexer
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from reviewgrove import session
from reviewgrove.functions import stemming
from reviewgrove.operators import indexing, terms
from reviewgrove.operators.choice import best_terms, label_counts, term_chi_square, term_impurity
from reviewgrove.operators.vectors import TfIdf, vocabulary_of
from reviewgrove.plans import job, tuning
from reviewgrove.plans.features import weight_stage
from reviewgrove.sources import reviews, sinks


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(6)
    words = [f"t{k}" for k in range(30)]
    return [(i, rng.choice([1, 2, 5]), [w for k, w in enumerate(words) if rng.random() < 1 / (k % 7 + 1)] * rng.randint(1, 3)) for i in range(90)]


@pytest.fixture(scope="module")
def cells(spark, texts):
    df = spark.createDataFrame(texts, "doc_id long, label int, words array<string>")
    return terms.term_counts(df, "words", keep=["doc_id", "label"]).persist()


def test_chi_square(spark, texts, cells):
    labels = label_counts(spark.createDataFrame(texts, "doc_id long, label int, words array<string>"))
    found = {r.term: (r.df, r.chi_square) for r in term_chi_square(cells, labels).collect()}
    n, sizes = len(texts), Counter(label for _, label, _ in texts)
    for term in {w for *_, ws in texts for w in ws}:
        value, df = 0.0, sum(term in ws for *_, ws in texts)
        for label, size in sizes.items():
            o = sum(term in ws and own == label for _, own, ws in texts)
            for seen, expected in ((o, df * size / n), (size - o, (n - df) * size / n)):
                value += (seen - expected) ** 2 / expected if expected else 0
        assert found[term] == (df, pytest.approx(value, abs=1e-8))
    ranked = best_terms(term_chi_square(cells, labels), 4).collect()
    assert [r.term for r in ranked] == sorted(found, key=lambda t: (-found[t][1], t))[:4]


def test_forest_takes_the_terms_that_depend_on_the_label(spark):
    rng = random.Random(8)
    common = [f"c{k}" for k in range(12)]
    rows = [(i, int(i % 4 == 0), [w for w in common if rng.random() < 0.8] * 2 + (["signal"] if i % 4 == 0 else [])) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, label int, words_stemmed array<string>")
    model = weight_stage(min_df=1).fit(df)
    narrow = job.bounded_features(model, df, 1)
    position = vocabulary_of(model).index("signal")
    assert narrow.stages[-1].getIndices() == [position] and position == len(vocabulary_of(model)) - 1
    assert job.bounded_features(model, df, 13) is model


def test_value_mapping_equals_the_indexer(spark, texts, cells):
    n_docs = len(texts)
    everywhere = cells.unionByName(
        spark.createDataFrame([(i, label, "all", i % 3 + 1) for i, label, _ in texts], "doc_id long, label int, term string, tf int")
    )
    found = {}
    for r in indexing.value_mapping(everywhere, n_docs).collect():
        found.setdefault(r.term, {})[r.tf] = r.code
    constant = {"all", *(w for *_, ws in texts for w in ws if all(w in own for *_, own in texts))}
    assert len(constant) > 1 and all(set(found.pop(w).values()) == {0} for w in constant)
    names = sorted({w for *_, ws in texts for w in ws} - constant)
    rows = [(Vectors.dense([ws.count(name) for name in names]),) for *_, ws in texts]
    maps = VectorIndexer(inputCol="v", outputCol="o", maxCategories=4).fit(spark.createDataFrame(rows, ["v"])).categoryMaps
    assert found == {names[i]: {int(v): c for v, c in values.items()} for i, values in maps.items()}


def test_unseen_values_get_the_code_behind_the_last(spark):
    schema = "doc_id long, term string, tf int"
    train = spark.createDataFrame([(1, "a", 2), (2, "a", 5), (1, "b", 1), (2, "b", 3), (3, "b", 2)], schema)
    mapping = indexing.value_mapping(train, 3)
    rows = [(7, "a", 2), (8, "a", 5), (9, "a", 3), (7, "b", 9), (7, "x", 4)]
    test = spark.createDataFrame(rows, schema).withColumn("tfidf", F.col("tf") * 0.5)
    values = {(r.doc_id, r.term): r.value for r in indexing.indexed_values(test, mapping).collect()}
    assert values == {(7, "a"): 1.0, (8, "a"): 2.0, (9, "a"): 3.0, (7, "b"): 0.0, (7, "x"): 2.0}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_weights_by_heat(spark, cells):
    vocabulary = terms.fit_vocabulary(cells, 90, min_df=1)
    whole = {(r.doc_id, r.term): r.tfidf for r in terms.weigh(cells, vocabulary).collect()}
    hot_bytes = 9 * 67
    split = terms.weigh(cells, vocabulary, limit=hot_bytes)
    assert {(r.doc_id, r.term): r.tfidf for r in split.collect()} == whole and split.count() == len(whole)
    least = terms.lowest_hot_count(vocabulary, hot_bytes)
    hot = vocabulary.table.filter(F.col("corpus_count") >= least)
    assert 0 < hot.count() <= 9
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(terms.weigh(cells, vocabulary, limit=hot_bytes))
        assert plan.count("BroadcastHashJoin") == 2 and plan.count("SortMergeJoin") == 1 and "LeftAnti" in plan
        cold = plan_of(terms.weigh(cells, vocabulary, limit=1))
        assert "BroadcastHashJoin" not in cold and terms.lowest_hot_count(vocabulary, 1) is None
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert {(r.doc_id, r.term): r.tfidf for r in terms.weigh(cells, vocabulary, limit=1).collect()} == whole


LINES = [
    '{"overall": 4.0, "reviewText": "good"}',
    '{"overall": 4.0, "reviewText": "cut of',
    "",
    "   ",
    '{"overall": "four", "reviewText": "typed"}',
    "[1, 2]",
    "null",
    '{"reviewText": "no rating"}',
    '{"overall": 1.0, "reviewText": "bad \\u00e9", "extra": {"a": 1}}',
]


def test_quarantine(spark, tmp_path):
    for name, lines in (("a.json", LINES[:5]), ("b.json", LINES[5:])):
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    scan = reviews.read_reviews_checked(spark, str(tmp_path / "*.json"), str(tmp_path / "bad"))
    assert sorted((r.overall, r.reviewText) for r in scan.good.fillna(0.0, ["overall"]).collect()) == [(0.0, "no rating"), (1.0, "bad é"), (4.0, "good")]
    bad = sorted((os.path.basename(r.file), r.line) for r in spark.read.parquet(str(tmp_path / "bad")).collect())
    assert bad == sorted([("a.json", LINES[1]), ("a.json", LINES[4]), ("b.json", "[1, 2]"), ("b.json", "null")])
    assert scan.n_bad() == 4 and scan.good.schema == reviews.REVIEW_SCHEMA


def test_pruning_by_a_join(spark, tmp_path):
    path = str(tmp_path / "by")
    rows = spark.range(100).select("id", (F.col("id") % 5).cast("int").alias("part"))
    reviews.write_partitioned(rows, path, "part")
    side = session.stage(spark.createDataFrame([(k, f"n{k}") for k in range(5)], "part int, name string"), "side")
    df = reviews.in_partitions_of(reviews.read_reviews_parquet(spark, path), side.filter("name = 'n3'"), "part")
    assert {r.id % 5 for r in df.collect()} == {3} and df.count() == 20
    assert "dynamicpruning" in plan_of(df).lower()


def test_publishing(spark, tmp_path):
    path = str(tmp_path / "report")
    first, second = spark.createDataFrame([(1, "a")], "n long, s string"), spark.createDataFrame([(2, "b"), (3, "")], "n long, s string")
    assert sinks.publish_csv(first, path) == {"columns": ["n", "s"], "rows": 1}

    def failing(df, place):
        sinks.write_csv(df, place)
        raise RuntimeError("disk")

    with pytest.raises(RuntimeError, match="disk"):
        sinks.publish_csv(second, path, write=failing)
    assert [tuple(r) for r in sinks.read_csv(spark, path, first.schema).collect()] == [(1, "a")]
    assert sorted(os.listdir(tmp_path)) == ["report"]
    sinks.publish_csv(second, path)
    assert sorted(map(tuple, sinks.read_csv(spark, path, first.schema).collect())) == [(2, "b"), (3, "")]
    assert json.loads((tmp_path / "report" / "_manifest.json").read_text()) == {"columns": ["n", "s"], "rows": 2}
    assert sorted(os.listdir(tmp_path)) == ["report"]


def test_recovery_of_a_cut_off_swap(spark, tmp_path):
    path = str(tmp_path / "report")
    df = spark.createDataFrame([(1,)], "n long")
    sinks.write_csv(df, path)
    os.rename(path, f"{path}._old")
    sinks.recover(spark, path)
    assert sinks.read_csv(spark, path, df.schema).count() == 1
    sinks.publish_csv(spark.createDataFrame([(5,)], "n long"), f"{path}._next")
    os.rename(path, f"{path}._old")
    sinks.recover(spark, path)
    assert [r.n for r in sinks.read_csv(spark, path, df.schema).collect()] == [5]
    assert sorted(os.listdir(tmp_path)) == ["report"]


def test_owned_tables_are_deleted(spark):
    with session.owning(spark) as owner:
        table = session.stage(spark.range(5), "owned")
        other = session.stage(spark.range(3), "owned")
    paths = list(owner.paths)
    assert len(paths) == 2 and table.count() + other.count() == 8 and all(map(os.path.isdir, paths))
    owner.close()
    owner.close()
    assert not any(map(os.path.exists, paths))
    with pytest.raises(ZeroDivisionError), session.owning(spark) as owner:
        session.stage(spark.range(5), "owned")
        paths = list(owner.paths)
        raise ZeroDivisionError
    assert paths and not any(map(os.path.exists, paths))


def test_job_leaves_nothing_behind(spark, tmp_path):
    rng = random.Random(3)
    good, bad = ["great", "lovely"], ["awful", "boring"]
    path = tmp_path / "in.json"
    lines = [json.dumps({"overall": 5.0 if i % 2 else 1.0, "reviewerID": f"r{i}", "reviewText": " ".join(rng.choices(good if i % 2 else bad, k=5) + ["book"])}) for i in range(120)]
    path.write_text("\n".join(lines + ['{"overall": 5.0, "rev']) + "\n")
    folder = os.path.join(session.shared_folder(spark), "reviewgrove")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    grid = tuning.Grid({"maxDepth": [2], "numTrees": [2]}, 2)
    with job.run(spark, str(path), str(tmp_path / "out"), grid=grid, vocab_size=4, min_df=2, forest_features=2, bad_lines=str(tmp_path / "bad")) as result:
        assert (result.n_terms, result.n_dropped, result.n_left_out, result.n_bad_lines) == (4, 1, 2, 1)
        assert set(os.listdir(folder)) - before and result.accuracy.first().n_test > 10
    assert set(os.listdir(folder)) == before
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).count() == 1


def test_indexer_learns_the_same_from_few_vectors(spark):
    rng = random.Random(3)
    rows = []
    for i in range(70):
        cells = {0: 2.0, 1: float(i), 2: i % 3 - 1.0, 3: i % 2 * 1.5, 5: 1.0 + i % 4, 6: 1.0 + i % 5}
        rows.append((i, Vectors.sparse(8, {k: v for k, v in cells.items() if k in (0, 5, 6) or rng.random() < 0.8})))
    sparse = spark.createDataFrame(rows, ["doc_id", "v"]).repartition(3)
    dense = spark.createDataFrame([(i, Vectors.dense(v.toArray())) for i, v in rows], ["doc_id", "v"])
    for df in (sparse, dense, sparse.unionByName(dense)):
        for most in (2, 4, 5):
            expected = VectorIndexer(inputCol="v", outputCol="x", maxCategories=most).fit(df)
            few = indexing.vector_values(df, "v", most)
            found = indexing.fit_indexer(df, "v", "x", most)
            assert few.count() == most + 1 and found.numFeatures == expected.numFeatures == 8
            assert found.categoryMaps == expected.categoryMaps
            assert found.transform(sparse).orderBy("doc_id").collect() == expected.transform(sparse).orderBy("doc_id").collect()
    with pytest.raises(ValueError, match="no vectors"):
        indexing.vector_values(sparse.limit(0), "v")


def test_frequencies_straight_from_the_words(spark, texts, cells):
    df = spark.createDataFrame([*texts, (900, 1, []), (901, 1, None)], "doc_id long, label int, words array<string>")
    found, expected = terms.word_frequencies(df, "words"), terms.document_frequencies(cells)
    assert found.dtypes == expected.dtypes and sorted(found.collect()) == sorted(expected.collect())


def test_impurity_of_a_split(spark, texts, cells):
    df = spark.createDataFrame(texts, "doc_id long, label int, words array<string>")
    found = {r.term: (r.df, r.impurity) for r in term_impurity(cells, label_counts(df)).collect()}
    for term in {w for *_, ws in texts for w in ws}:
        sides = [[own for _, own, ws in texts if (term in ws) is there] for there in (True, False)]
        if not all(sides):
            assert term not in found
            continue
        value = sum(len(side) - sum(c * c for c in Counter(side).values()) / len(side) for side in sides)
        assert found[term] == (len(sides[0]), pytest.approx(value))


def test_terms_of_a_model_are_broadcast(spark):
    df = spark.createDataFrame([(i, [f"t{i % 3}", "all"]) for i in range(40)], "doc_id long, words array<string>")
    model = TfIdf(inputCol="words", outputCol="tfidf", minDF=1).fit(df)
    assert "ResolvedHint (strategy=broadcast)" in model.positions._jdf.queryExecution().analyzed().toString()


def test_stemming_works_on_runs_of_words():
    lists = pa.array([["a"] * n if n is not None else None for n in (3, None, 0, 9, 1, 1, 1, 0)])
    parts = list(stemming.runs(lists, 4))
    assert pa.concat_arrays(parts).equals(lists) and [len(p) for p in parts] == [3, 1, 4]
    stems = stemming.Stems()
    some = pa.array([["loving", None, "books"], None, [], ["loved"] * 5])
    whole = stemming.stem_lists(some, stems).to_pylist()
    assert [row for part in stemming.runs(some, 2) for row in stemming.stem_lists(part, stems).to_pylist()] == whole
    assert list(stemming.runs(some.slice(0, 0), 2)) == []
