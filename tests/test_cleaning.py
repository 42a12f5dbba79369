"""Cleaning: fixed results, and every step against its fixed pattern."""

from __future__ import annotations

import random
import time

import pytest
from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewgrove.functions import cleaning
from reviewgrove.functions.tokens import tokens

EDGES = [
    ("mail a@b.com now end x@y.org", "mail now end x y org"),
    ("a b c d e", "a c e"),
    ("it's 5pm\tok\nyes I am", "it s ok yes am"),
    (None, "null"),
    ("", ""),
    ("Ünï café ß", " n caf "),
]


FIXED = (cleaning.EMAIL, cleaning.BREAK, cleaning.DIGIT_TOKEN, cleaning.SINGLE_LETTER, cleaning.NON_WORD)


def fixed_steps(text: Column) -> Column:
    for pattern in FIXED:
        text = F.regexp_replace(text, pattern, " ")
    return F.lower(text)


def all_steps(text: Column) -> Column:
    for step in cleaning.STEPS:
        text = step(text)
    return text


@pytest.mark.parametrize("clean", [cleaning.clean_text, all_steps, fixed_steps])
def test_edge_rows(spark, clean):
    df = spark.createDataFrame(EDGES, "text string, expected string")
    got = df.select("expected", cleaning.fill_missing(clean(F.col("text"))).alias("got")).collect()
    assert [row.got for row in got] == [row.expected for row in got]


def _random_texts(n: int) -> list[str]:
    rng = random.Random(7)
    letters = "ab@1 _\n\t\r\f\x0b.,'é  ж日😀"
    pieces = [
        "a", "I", "it's", "x@y", "@", "@@", "a@", "@b", "a@b", "5pm", "12", "é", "éa", "word", "Word_2", "_", "--", "a-b",
        "x@1 ", "😀", "ж", "жж", " ", " ", "1@b", "a@b@c", "@a@b",
    ]
    blanks = [" ", "  ", "\n", "\t", "\r", "\r\n", "\f", "\x0b", " , ", "", "."]
    texts = []
    for _ in range(n):
        if rng.random() < 0.4:
            texts.append("".join(rng.choice(letters) for _ in range(rng.randint(0, 25))))
        else:
            texts.append("".join(rng.choice(pieces) + rng.choice(blanks) for _ in range(rng.randint(0, 12))))
        if rng.random() < 0.3:
            texts[-1] = rng.choice(blanks) + texts[-1]
    return texts


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame([(t,) for t in _random_texts(40_000)], "text string").repartition(4).persist()


def _same(df, left, right):
    differing = df.select("text", left.alias("left"), right.alias("right")).filter("NOT left <=> right")
    assert differing.take(3) == []


def test_whole_equals_fixed_patterns(texts):
    _same(texts, cleaning.clean_text(F.col("text")), fixed_steps(F.col("text")))


@pytest.mark.parametrize("step, pattern", list(zip(cleaning.STEPS, FIXED)))
def test_step_equals_its_fixed_pattern(texts, step, pattern):
    _same(texts, step(F.col("text")), F.regexp_replace("text", pattern, " "))


def test_words_equal_those_of_the_clean_text(texts):
    _same(texts, cleaning.clean_words(F.col("text")), tokens(cleaning.clean_text(F.col("text"))))


LONG = ["x" * 400_000, "жы " * 150_000, "-" * 400_000, ". " * 200_000, "a " * 200_000, "@" * 400_000, "a@" * 200_000, "é" * 400_000]


@pytest.mark.parametrize("clean", [cleaning.clean_text, *cleaning.STEPS, lambda t: F.array_join(cleaning.clean_words(t), " ")])
def test_long_runs_take_linear_time(spark, clean):
    df = spark.createDataFrame([(t,) for t in LONG], "text string")
    start = time.monotonic()
    lengths = df.select(F.length(clean(F.col("text"))).alias("n")).collect()
    assert time.monotonic() - start < 20
    if clean is cleaning.clean_text:
        assert [row.n for row in lengths] == [400_000, 1, 1, 1, 200_000, 1, 400_000, 1]


def test_steps_alone(spark):
    row = spark.createDataFrame([("x a@b\nc 1st d e f",)], "text string").select(
        cleaning.strip_email(F.col("text")).alias("email"),
        cleaning.strip_breaks(F.col("text")).alias("breaks"),
        cleaning.strip_digit_tokens(F.col("text")).alias("digits"),
        cleaning.strip_single_letters(F.col("text")).alias("single"),
        cleaning.collapse_non_word(F.col("text")).alias("words"),
    ).first()
    assert row.email == "x  c 1st d e f"
    assert row.breaks == "x a@b c 1st d e f"
    assert row.digits == "x a@b\nc   d e f"
    assert row.single == "x a@b 1st e f"
    assert row.words == "x a b c 1st d e f"
