"""Token ids in compressed blocks, one frame per document, with a shared dictionary and an offset index.

A block is one binary value: magic, sha256 of the dictionary, number of documents n, then n document numbers (int64), n
token counts (uint32), n + 1 frame offsets (int64) and n flags for missing document numbers (uint8), then the frames.
A frame is the zstandard form of a document's ids as little-endian uint32, compressed alone with the shared
dictionary, so one short document can be read without its neighbours. Blocks lie in a Parquet table ``blocks`` with
their first and last document, in ascending document order; the dictionary lies beside it in ``dictionary``.

Defined cases: a null or empty text has the end id only; repeated documents are kept as often as they come, in a fixed order;
documents without a number come first. An empty table gives no blocks. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reviewgrove.llm.tokens import encoded
from reviewgrove.session import fresh_path

MAGIC = b"IDB1"
END_ID = 1
# Documents whose ids train the dictionary, and how many ids of each: only the ratio depends on them.
SAMPLE_DOCUMENTS = 1000
SAMPLE_IDS = 4096
DICTIONARY_BYTES = 64 << 10
BLOCK_BYTES = 1 << 20
LEVEL = 3
BLOCK_SCHEMA = "part int, block long, first_id long, last_id long, n_docs long, n_tokens long, before long, data binary"


def train_dictionary(samples: list[bytes]) -> bytes:
    """Dictionary from serialized id arrays; too few samples serve as they are."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


def dictionary_sample(df: DataFrame, tokenizer: str, end_id: int) -> list[bytes]:
    """Ids of the documents with the lowest hash of their number, a bounded sample."""
    number = F.xxhash64("doc_id")
    picked = df.select("doc_id").orderBy(number, "doc_id").limit(SAMPLE_DOCUMENTS).distinct()
    texts = df.select("doc_id", "text").join(F.broadcast(picked), "doc_id", "left_semi").select("doc_id", "text")

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, values, counts in encoded(batch.column(1), tokenizer, end_id):
                ends = np.cumsum(counts)
                frames = [values[e - n : e][:SAMPLE_IDS].tobytes() for n, e in zip(counts, ends)]
                numbers = batch.column(0).slice(first, last - first)
                yield pa.RecordBatch.from_arrays([numbers, pa.array(frames, pa.binary())], names=["doc_id", "ids"])

    rows = texts.mapInArrow(ids, "doc_id long, ids binary").orderBy("doc_id", "ids").limit(SAMPLE_DOCUMENTS)
    return [bytes(row["ids"]) for row in rows.collect()]


def pack_block(numbers: list, counts: list[int], frames: list[bytes], dictionary: bytes) -> bytes:
    offsets = np.concatenate(([0], np.cumsum([len(frame) for frame in frames]))).astype("<i8")
    missing = np.array([number is None for number in numbers], np.uint8)
    values = np.array([0 if number is None else number for number in numbers], "<i8")
    head = MAGIC + hashlib.sha256(dictionary).digest() + len(frames).to_bytes(8, "little")
    index = values.tobytes() + np.array(counts, "<u4").tobytes() + offsets.tobytes() + missing.tobytes()
    return b"".join([head, index, *frames])


class Block:
    """Reads a block. ``ids(i)`` opens only the frame of document i."""

    def __init__(self, data: bytes, dictionary: bytes) -> None:
        if data[:4] != MAGIC:
            raise ValueError("not a block of ids")
        if data[4:36] != hashlib.sha256(dictionary).digest():
            raise ValueError("the block was written with another dictionary")
        n = int.from_bytes(data[36:44], "little")
        at = 44
        values = np.frombuffer(data, "<i8", n, at)
        self.counts = np.frombuffer(data, "<u4", n, at + 8 * n)
        self.offsets = np.frombuffer(data, "<i8", n + 1, at + 12 * n)
        missing = np.frombuffer(data, np.uint8, n, at + 20 * n + 8)
        self.numbers = [None if gone else number for number, gone in zip(values.tolist(), missing)]
        self.data = memoryview(data)[at + 21 * n + 8 :]
        self.open = zstandard.ZstdDecompressor(dict_data=as_dictionary(dictionary)).decompress

    def ids(self, i: int) -> bytes:
        frame = self.data[self.offsets[i] : self.offsets[i + 1]]
        return self.open(frame, max_output_size=4 * int(self.counts[i]))


def as_dictionary(dictionary: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(dictionary) if dictionary else None


def write_blocks(df: DataFrame, tokenizer: str, path: str | None = None, end_id: int = END_ID) -> str:
    """Encode ``doc_id, text`` and write the blocks in ascending document order. Returns the path.

    The texts are dealt by ranges of the document number and encoded there, so blocks are in order without a later
    sort; a task keeps one block and one slice of texts in memory.
    """
    spark = df.sparkSession
    path = path or fresh_path(spark, "id-blocks")
    dictionary = train_dictionary(dictionary_sample(df, tokenizer, end_id))
    spark.createDataFrame([(dictionary, hashlib.sha256(dictionary).hexdigest())], "data binary, hash string").coalesce(
        1
    ).write.parquet(f"{path}/dictionary")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=LEVEL, dict_data=as_dictionary(dictionary)).compress
        part, number, before = TaskContext.get().partitionId(), 0, 0
        numbers, counts, frames, size = [], [], [], 0

        def finish() -> pa.RecordBatch:
            data = pack_block(numbers, counts, frames, dictionary)
            row = (part, number, numbers[0], numbers[-1], len(numbers), sum(counts), before, data)
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, _TYPES)], names=_NAMES)

        for batch in batches:
            for first, last, ids, each in encoded(batch.column(1), tokenizer, end_id):
                ends = np.cumsum(each).tolist()
                data = memoryview(ids.tobytes())
                named = batch.column(0).slice(first, last - first).to_pylist()
                for doc, count, end in zip(named, each.tolist(), ends):
                    frame = press(data[4 * (end - count) : 4 * end])
                    if frames and size + len(frame) > BLOCK_BYTES:
                        yield finish()
                        number, before = number + 1, before + sum(counts)
                        numbers, counts, frames, size = [], [], [], 0
                    numbers.append(doc)
                    counts.append(count)
                    frames.append(frame)
                    size += len(frame)
        if frames:
            yield finish()

    ordered = df.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange("doc_id")
    ordered = ordered.sortWithinPartitions("doc_id", F.xxhash64("text"))
    ordered.mapInArrow(blocks, BLOCK_SCHEMA).write.option("compression", "none").parquet(f"{path}/blocks")
    return path


_NAMES = ["part", "block", "first_id", "last_id", "n_docs", "n_tokens", "before", "data"]
_TYPES = [pa.int32(), *[pa.int64()] * 6, pa.binary()]


def read_dictionary(spark: SparkSession, path: str) -> bytes:
    return bytes(spark.read.parquet(f"{path}/dictionary").first()["data"])


def read_blocks(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` from the blocks; only those of ``doc_ids`` if given.

    ``start`` counts the ids of all documents before. Blocks hold what is before them in their part, and the parts, one
    row each, are summed up. For single documents Parquet's statistics leave out all blocks of other ranges.
    """
    dictionary = read_dictionary(spark, path)
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks")
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = parts.select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base"))
    wanted = None if doc_ids is None else set(doc_ids)
    if wanted is not None:
        inside = F.lit(False)
        for number in sorted(wanted):
            inside |= (F.col("first_id") <= number) & (F.col("last_id") >= number)
        blocks = blocks.filter(inside)

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for before, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                block = Block(data.as_py(), dictionary)
                starts = before + np.cumsum(block.counts, dtype=np.int64) - block.counts
                rows = [i for i, n in enumerate(block.numbers) if wanted is None or n in wanted]
                arrays = [
                    pa.array([block.numbers[i] for i in rows], pa.int64()),
                    pa.array(starts[rows], pa.int64()),
                    pa.array(block.counts[rows].astype(np.int64)),
                    pa.array([block.ids(i) for i in rows], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "start", "n_tokens", "ids"])

    # One row per part, and a part is a task's share of the input: far below any broadcast limit.
    placed = blocks.join(F.broadcast(base), "part").select((F.col("base") + F.col("before")).alias("before"), "data")
    return placed.mapInArrow(documents, "doc_id long, start long, n_tokens long, ids binary")


def id_digests(df: DataFrame, tokenizer: str) -> DataFrame:
    """Write all documents and read them back: place, length and checksum of each document's ids."""
    path = write_blocks(df, tokenizer)
    found = read_blocks(df.sparkSession, path)
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
