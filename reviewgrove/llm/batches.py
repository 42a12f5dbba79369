"""Work on Arrow batches inside tasks: carried columns, slices, and words found straight in UTF-8 bytes."""

from __future__ import annotations

import ctypes
import gc
import sys
import types
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from reviewgrove.session import bound_batches

ROW = "row"
# Bytes of text that one step of array work looks at. Bounds the memory of a task, not the texts.
SLICE_BYTES = 1 << 21
SEGMENT = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def alongside(
    df: DataFrame,
    text: str,
    outputs: Sequence[T.StructField],
    start: Callable[[], Callable[[pa.Array], Sequence[pa.Array]]],
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """``outputs`` computed in tasks from the column ``text``, next to the columns ``carry`` (default: all).

    ``start`` is called once per task and gives the function for a run of texts; null texts arrive as
    empty ones. A carried column named like an output is replaced by it.
    """
    carried = [name for name in (df.columns if carry is None else carry) if name not in {f.name for f in outputs}]
    sent = df.select(
        F.struct(*[F.col(f"`{name}`") for name in carried]).alias(ROW),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
    )
    if text in carried:  # the text is sent once
        sent = df.select(F.struct(*[F.col(f"`{name}`") for name in carried]).alias(ROW))
    schema = T.StructType([sent.schema[ROW], *outputs])
    names = [ROW, *[f.name for f in outputs]]
    within = text in carried

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            texts = batch.column(0).field(carried.index(text)) if within else batch.column(1)
            texts = pc.fill_null(texts, "")
            for first, last in slices(texts):
                arrays = work(texts.slice(first, last - first))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), *arrays], names=names)

    out = sent.mapInArrow(run, schema)
    return out.select(*[F.col(ROW).getField(name).alias(name) for name in carried], *[f.name for f in outputs])


def beside(
    df: DataFrame,
    text: str | Column,
    outputs: Sequence[T.StructField],
    start: Callable[[], Callable[[pa.Array], Sequence[pa.Array]]],
    carry: Sequence[str] | None = None,
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """The same as ``alongside``, but only the texts go to the workers and only the outputs come back.

    Spark keeps the other columns of the rows on its own side meanwhile and spills them if they are many. Right for rows that
    carry their text on; ``text`` may then be a field of what is carried.
    """
    schema = T.StructType(list(outputs))
    carried = [name for name in (df.columns if carry is None else carry) if name not in set(schema.names)]

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        work = start()
        for texts in batches:
            texts = pc.fill_null(texts, "")
            parts = [
                pa.StructArray.from_arrays(list(work(texts.slice(first, last - first))), names=schema.names)
                for first, last in slices(texts, slice_bytes)
            ]
            yield pa.concat_arrays(parts) if parts else pa.array([], to_arrow_type(schema))
        texts = parts = work = None
        give_back()

    bound_batches(df.sparkSession)
    text = F.col(f"`{text}`") if isinstance(text, str) else text
    # Not to be pushed down or taken twice.
    found = F.arrow_udf(run, schema).asNondeterministic()
    rows = df.select(*[F.col(f"`{name}`") for name in carried], found(text.cast("string")).alias("_found"))
    return rows.select(*[F.col(f"`{name}`") for name in carried], *[F.col("_found").getField(name).alias(name) for name in schema.names])


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``limit`` bytes; a longer text is a range of its own. Null has no bytes."""
    if not len(texts):
        return
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < len(texts):
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield first, last
        first = last


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string array without nulls, and where each text starts in them (one more at the end)."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    if not len(offsets):
        return data[:0], np.zeros(1, np.int64)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _table(is_member: Callable[[int], bool]) -> np.ndarray:
    return np.array([is_member(b) for b in range(256)])


# ``[^\x20\x09-\x0D]+`` and ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` (after A-Z became a-z), by byte. All bytes of a
# character beyond ASCII are 128 or more, so both patterns can be told byte by byte.
VISIBLE = _table(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
PLAIN = _table(lambda b: 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80)
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)


@dataclass(frozen=True)
class Words:
    """Words of a run of texts: byte span, 64-bit hash and text number of each; ``first[t]`` is the first of text t."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    text: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def process_store() -> dict:
    """Values that stay when a Python worker goes on to its next task. Only for what can be made again."""
    return sys.modules.setdefault("_task_store", types.ModuleType("_task_store")).__dict__


def give_back() -> None:
    """Return memory that this Python worker has freed to the machine; workers go on to tasks of other stages and keep it else."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
    if trim is not None:
        trim(0)


def powers(base: int, size: int) -> np.ndarray:
    """``base ** i`` modulo 2^64 for i below ``size``; kept per process."""
    store = process_store()
    known = store.get(base)
    if known is None or len(known) < size:
        factors = np.full(max(size, SEGMENT + 1), base, np.uint64)
        factors[0] = 1
        known = store[base] = np.cumprod(factors, dtype=np.uint64)
    return known[:size]


def mixed(hashes: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finisher of a public 64-bit hash)."""
    x = hashes ^ (hashes >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _spans(members: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true, cut at ``borders`` as well."""
    before = np.empty(len(members), bool)
    before[:1] = False
    before[1:] = members[:-1]
    before[borders] = False
    starts = np.flatnonzero(members & ~before)
    after = np.empty(len(members), bool)
    after[-1:] = False
    after[:-1] = members[1:]
    after[borders[borders > 0] - 1] = False
    return starts, np.flatnonzero(members & ~after) + 1


def words(texts: pa.Array, members: np.ndarray | Callable, fold: np.ndarray = LOWER) -> Words:
    """All words of ``texts``, hashed as folded. Long data are hashed piece by piece, cut between words.

    ``members`` tells the bytes of words by their value, or is a function from all bytes to true and false.
    """
    data, offsets = utf8(texts)
    is_word = members(data) if callable(members) else members[data]
    inner = offsets[:-1]
    starts, ends = _spans(is_word, inner[inner < len(data)])
    hashes = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        base = starts[at]
        stop = max(at + 1, int(np.searchsorted(ends, base + SEGMENT, "right")))
        size = int(ends[stop - 1] - base)
        values = (fold[data[base : base + size]].astype(np.uint64) + np.uint64(1)) * powers(_BASE, size)
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum(values, out=sums[1:])
        s, e = starts[at:stop] - base, ends[at:stop] - base
        hashes[at:stop] = (sums[e] - sums[s]) * powers(_INVERSE, size + 1)[s]
        at = stop
    text = np.searchsorted(offsets, starts, "right") - 1
    first = np.searchsorted(starts, offsets)
    return Words(data, starts, ends, mixed(hashes), text, first)


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` neighbours; depends on their order."""
    if len(hashes) < size:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(hashes) - size + 1, np.uint64)
    for i in range(size):
        total = total * np.uint64(_BASE) + hashes[i : len(hashes) - size + 1 + i]
    return mixed(total)
