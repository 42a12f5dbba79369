"""Token arrays and counts inside a row."""

from __future__ import annotations

import random
from collections import Counter

from pyspark.ml.feature import RegexTokenizer, StopWordsRemover
from pyspark.sql import functions as F

from reviewgrove.functions import tokens as t
from reviewgrove.operators.terms import term_counts


def _texts(n=400):
    rng = random.Random(3)
    words = ["the", "a", "cat", "cats", "i", "not", "dog", "don", "null", "book"]
    return [" ".join(rng.choice(words) for _ in range(rng.randint(0, 60))) for _ in range(n)] + ["", " ", " x "]


def test_words_equal_the_ml_stages(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(_texts())], "id int, text string")
    ml = StopWordsRemover(inputCol="words", outputCol="kept").transform(
        RegexTokenizer(inputCol="text", outputCol="words", pattern=r"\W").transform(df)
    )
    words = t.tokens(F.col("text"))
    rows = ml.select("words", words.alias("w"), "kept", t.drop_stop_words(words, t.stop_words()).alias("k")).collect()
    assert all(row.words == row.w and row.kept == row.k for row in rows)


def test_stop_list(spark):
    words = t.stop_words()
    assert len(words) == 181 and "the" in words


def test_repeats_survive_stop_words(spark):
    row = spark.createDataFrame([(["the", "cat", "the", "cat"],)], "w array<string>").select(
        t.drop_stop_words(F.col("w"), ["the"]).alias("k")
    ).first()
    assert row.k == ["cat", "cat"]


def test_counts_in_a_row_equal_a_counter(spark):
    texts = _texts()
    df = spark.createDataFrame([(i, s.split()) for i, s in enumerate(texts)] + [(-1, None)], "id int, w array<string>")
    got = {(r.id, r.term): r.tf for r in term_counts(df, "w", keep=["id"]).collect()}
    expected = {(i, w): n for i, s in enumerate(texts) for w, n in Counter(s.split()).items()}
    assert got == expected


def test_one_hot_text(spark):
    n = 300_000
    df = spark.range(1).select("id", F.array_repeat(F.lit("hot"), n).alias("w"))
    assert [tuple(r) for r in term_counts(df, "w", keep=["id"]).collect()] == [(0, "hot", n)]


def test_counts_need_no_shuffle(spark, capsys):
    df = spark.range(10).select("id", F.array(F.lit("a"), F.lit("b")).alias("w"))
    term_counts(df, "w", keep=["id"]).explain()
    assert "Exchange" not in capsys.readouterr().out
