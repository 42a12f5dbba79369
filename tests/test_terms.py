"""Vocabulary and TF-IDF, as tables and as vectors."""

from __future__ import annotations

import math
import random
from collections import Counter

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from reviewgrove.operators import terms
from reviewgrove.operators.vectors import EmptyVocabularyError, TfIdf, counting_model, vocabulary_of
from reviewgrove.plans.features import TEXT, WORDS_STEMMED, builtin_feature_stages, feature_stages, prepare, review_words, text_stages


def _corpus(n=300, seed=5):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    return [[words[int(60 * rng.random() ** 2)] for _ in range(rng.randint(0, 25))] for _ in range(n)]


@pytest.fixture(scope="module")
def corpus():
    return _corpus()


@pytest.fixture(scope="module")
def cells(spark, corpus):
    df = spark.createDataFrame(list(enumerate(corpus)), "doc_id int, w array<string>")
    return terms.term_counts(df, "w", keep=["doc_id"]).persist()


def _frequencies(corpus):
    df, total = Counter(), Counter()
    for words in corpus:
        df.update(set(words))
        total.update(words)
    return df, total


def test_vocabulary_and_weights(cells, corpus):
    df, total = _frequencies(corpus)
    vocabulary = terms.fit_vocabulary(cells, len(corpus), min_df=12)
    got = {r.term: (r.df, r.corpus_count) for r in vocabulary.table.collect()}
    assert got == {t: (df[t], total[t]) for t in df if df[t] >= 12}
    assert vocabulary.n_terms == len(got)
    weights = {(r.doc_id, r.term): r.tfidf for r in terms.weigh(cells, vocabulary).collect()}
    expected = {
        (i, t): n * math.log((len(corpus) + 1) / (df[t] + 1))
        for i, words in enumerate(corpus)
        for t, n in Counter(words).items()
        if df[t] >= 12
    }
    assert weights == pytest.approx(expected)


def test_large_vocabulary_is_shuffled_with_the_same_result(cells, corpus, monkeypatch, capsys):
    vocabulary = terms.fit_vocabulary(cells, len(corpus), min_df=5)
    small = sorted(map(tuple, terms.weigh(cells, vocabulary).collect()))
    monkeypatch.setattr(terms, "BROADCAST_LIMIT", 0)
    cells.sparkSession.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        large = terms.weigh(cells, vocabulary)
        large.explain()
        assert "Broadcast" not in capsys.readouterr().out
        assert sorted(map(tuple, large.collect())) == small
    finally:
        cells.sparkSession.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("limits", [{"min_df": 0.1}, {"min_df": 0.05, "max_df": 0.3}, {"min_df": 1, "max_df": 40}])
def test_limits_as_shares_and_counts(cells, corpus, limits):
    df, _ = _frequencies(corpus)
    m = len(corpus)
    low = limits["min_df"] if limits["min_df"] >= 1 else limits["min_df"] * m
    high = limits.get("max_df", m)
    high = high if high >= 1 else high * m
    got = {r.term for r in terms.fit_vocabulary(cells, m, **limits).table.collect()}
    assert got == {t for t in df if low <= df[t] <= high}


@pytest.mark.parametrize("size", [0, 1, 3, 4, 7, 8, 9, 50])
def test_most_frequent_with_ties(spark, size):
    rows = [(t, c) for c, names in {9: "a", 5: "dbc", 2: "hgef", 1: "z"}.items() for t in names]
    df = spark.createDataFrame(rows, "term string, corpus_count long").repartition(3)
    got = sorted(r.term for r in terms.most_frequent(df, size).collect())
    assert got == sorted(t for t, _ in sorted(rows, key=lambda r: (-r[1], r[0]))[:size])


def test_vocabulary_is_cut_to_size(cells, corpus):
    _, total = _frequencies(corpus)
    vocabulary = terms.fit_vocabulary(cells, len(corpus), min_df=1, vocab_size=10)
    top = sorted(total, key=lambda t: (-total[t], t))[:10]
    assert sorted(r.term for r in vocabulary.table.collect()) == sorted(top)


def _texts(spark, corpus):
    return spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(corpus)], f"doc_id int, {TEXT} string")


def _weights(model, df):
    terms_at = vocabulary_of(model)
    return {
        (r.doc_id, terms_at[i]): v
        for r in model.transform(df).select("doc_id", "tfidf").collect()
        for i, v in zip(r.tfidf.indices.tolist(), r.tfidf.values.tolist())
    }


@pytest.mark.parametrize("stem", [False, True])
def test_pipeline_equals_builtin_stages(spark, corpus, stem):
    names = "cats cat dogs dog running runs flies happy happily the an".split()
    named = [[names[int(w[1:]) % len(names)] + ("" if int(w[1:]) < 30 else "ing") for w in words] for words in corpus]
    df = _texts(spark, named)
    ours = feature_stages(stem=stem, min_df=20).fit(df)
    builtin = builtin_feature_stages(stem=stem, min_df=20).fit(df)
    assert _weights(ours, df) == pytest.approx(_weights(builtin, df))
    assert sorted(vocabulary_of(ours)) == sorted(vocabulary_of(builtin))


def test_upper_limit(spark, corpus):
    df = _texts(spark, corpus)
    frequencies, _ = _frequencies(corpus)
    model = feature_stages(min_df=5, max_df=0.2, stem=False).fit(df)
    assert set(vocabulary_of(model)) == {t for t in frequencies if 5 <= frequencies[t] <= 60}


def test_positions_follow_count_then_term(spark, corpus):
    _, total = _frequencies(corpus)
    df = spark.createDataFrame([(w,) for w in corpus], "w array<string>")
    model = TfIdf(inputCol="w", outputCol="tfidf", minDF=1).fit(df)
    assert vocabulary_of(model) == sorted(total, key=lambda t: (-total[t], t))
    again = TfIdf(inputCol="w", outputCol="tfidf", minDF=1).fit(df.repartition(7))
    assert vocabulary_of(again) == vocabulary_of(model)


def test_column_functions_equal_the_text_stages(spark):
    rows = [(1, "The cats, a run 5pm me@x.org happily\n", 5.0), (2, "", 1.0), (3, " a null", 2.0), (4, None, 3.9)]
    df = spark.createDataFrame(rows, f"doc_id int, {TEXT} string, overall double")
    ml = PipelineModel(text_stages()).transform(prepare(df)).select("doc_id", "label", WORDS_STEMMED)
    ours = review_words(df)
    assert ours.columns == ml.columns
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, ml.collect()))


def test_too_few_texts(spark):
    df = spark.createDataFrame([(["cat"],)] * 9, "w array<string>")
    with pytest.raises(EmptyVocabularyError, match="9 texts"):
        TfIdf(inputCol="w", outputCol="tfidf").fit(df)


def test_terms_with_unusual_characters(spark):
    model = counting_model(["a b", "é", "x\x01y", ""], "w", "n")
    assert model.vocabulary == ["a b", "é", "x\x01y", ""]
    df = spark.createDataFrame([(["é", "a b", "é", "other"],)], "w array<string>")
    assert counting_model(["a b", "é"], "w", "n").transform(df).first().n.toArray().tolist() == [1.0, 2.0]


def test_stages_can_be_saved(spark, corpus, tmp_path):
    df = _texts(spark, corpus).withColumn("w", F.split(TEXT, " "))
    estimator = Pipeline(stages=[TfIdf(inputCol="w", outputCol="tfidf", minDF=30, vocabSize=20)])
    estimator.write().save(str(tmp_path / "estimator"))
    model = Pipeline.load(str(tmp_path / "estimator")).fit(df)
    model.write().save(str(tmp_path / "model"))
    loaded = PipelineModel.load(str(tmp_path / "model"))
    assert len(vocabulary_of(loaded)) <= 20
    assert _weights(loaded, df) == pytest.approx(_weights(model, df))


def test_each_word(spark):
    df = spark.createDataFrame([(1, ["b", "a", "b"]), (2, []), (3, None)], "doc_id int, w array<string>")
    assert [tuple(r) for r in terms.each_word(df, "w", keep=["doc_id"]).collect()] == [(1, 0, "b"), (1, 1, "a"), (1, 2, "b")]
    assert sorted(r.term for r in terms.distinct_words(df, "w").collect()) == ["a", "b"]


def test_words_are_computed_once(spark, capsys):
    df = review_words(spark.createDataFrame([(1, "the cats run", 1.0)], f"doc_id int, {TEXT} string, overall double"))
    for plan in (terms.each_word(df, WORDS_STEMMED), terms.term_counts(df, WORDS_STEMMED, keep=["doc_id"])):
        plan.explain()
        assert capsys.readouterr().out.count("stem_arrays(") == 1


def test_the_long_form_keeps_every_term(cells, corpus, monkeypatch):
    monkeypatch.setattr(terms, "VOCAB_SIZE", 5)
    df, _ = _frequencies(corpus)
    vocabulary = terms.fit_vocabulary(cells, len(corpus), min_df=1)
    assert (vocabulary.n_terms, vocabulary.n_dropped) == (len(df), 0)
    assert terms.fit_vocabulary(cells, len(corpus), min_df=1, vocab_size=10).n_dropped == len(df) - 10
