"""What the workers of the pipeline hold at a time: batches of rows, and the table of known ids."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewgrove.llm import language_model, near_dedup, packing, tokens
from reviewgrove.llm.batches import beside, slices
from reviewgrove.llm.queries import tokenizer
from reviewgrove.session import BATCH_BYTES, BATCH_SETTING


@pytest.fixture
def unset(spark):
    spark.conf.unset(BATCH_SETTING)
    yield spark
    spark.conf.unset(BATCH_SETTING)


def test_rows_go_to_workers_in_bounded_batches(unset):
    rows = unset.range(0, 4000, 1, 1).select("id", F.repeat(F.lit("x"), 4000).alias("text"))

    def start():
        return lambda texts: [pa.array([texts.nbytes] * len(texts), pa.int64()), pa.array([len(t) for t in texts.to_pylist()], pa.int64())]

    outputs = [T.StructField("size", T.LongType()), T.StructField("length", T.LongType())]
    found = beside(rows, "text", outputs, start, ["id"], slice_bytes=1 << 30).collect()
    assert [row["id"] for row in found] == list(range(4000)) and {row["length"] for row in found} == {4000}
    assert max(row["size"] for row in found) < 1.5 * BATCH_BYTES


@pytest.mark.parametrize(
    "step",
    [
        lambda df: packing.place(df, tokenizer("byte_bpe_50k.json")),
        lambda df: near_dedup.describe(df, 5),
        language_model.gram_counts,
    ],
)
def test_text_steps_bound_their_batches(unset, step):
    df = unset.createDataFrame([(1, "one text")], "doc_id long, text string")
    step(df)
    assert unset.conf.get(BATCH_SETTING, None) == str(BATCH_BYTES)
    unset.conf.set(BATCH_SETTING, "1234567")
    step(df)
    assert unset.conf.get(BATCH_SETTING, None) == "1234567"


def test_pieces_do_not_depend_on_batches(unset):
    rows = unset.range(0, 300, 1, 3).select(F.col("id").alias("doc_id"), F.repeat(F.concat(F.lit("some words "), F.hex("id")), F.col("id").cast("int")).alias("text"))
    found = []
    for limit in ("2000", str(64 << 20)):
        unset.conf.set(BATCH_SETTING, limit)
        found.append(sorted(tuple(row) for row in packing.piece_digests(rows, tokenizer("byte_bpe_50k.json")).collect()))
    assert found[0] == found[1] and {row[0] for row in found[0]} == set(range(300))


def test_null_texts_do_not_join_ranges():
    texts = pa.array(["a" * 10, None, *["b" * 10] * 8])
    assert list(slices(texts, 20)) == [(0, 3), (3, 5), (5, 7), (7, 9), (9, 10)]


def test_known_ids_are_not_copied_for_each_run():
    coder = tokens.Encoder(tokenizer("byte_bpe_50k.json"))
    text = pa.array(["known words, and later others"])
    expected = coder.encode(text)[0].tolist()
    keys = np.arange(1, 101, dtype=np.uint64)
    coder.known.add(keys, [np.zeros(100_000, np.uint32).tobytes()] * 100)
    tracemalloc.start()
    try:
        assert coder.encode(pa.array(["known words, and later others", "never seen before"]))[0].tolist()[: len(expected)] == expected
        again = coder.encode(pa.array(["yet another one", "known words, and later others"]))[0].tolist()
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert again[-len(expected) :] == expected
    assert peak < 40 << 20
