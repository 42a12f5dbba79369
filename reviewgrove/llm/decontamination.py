"""Find and remove test passages in training documents.

The windows of 13 words of the test items become a hash set that is broadcast in blocks of a checked size. Tasks
scan the word windows of whole documents against it, and every hit is verified on the words themselves.

Defined cases: a null or empty text has no words and no hits; repeated rows are judged one by one; an item without
words is ignored, one with fewer than 13 words is one window; an empty table of items leaves every document clean.
Items with a null id take part, but have no name in the list of items. Other columns are carried.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewgrove.llm.batches import PLAIN, beside, utf8, window_hashes, words
from reviewgrove.session import stage

WINDOW = 13
# Bytes of window text in one broadcast block. More test data make more blocks, each scanned in its own pass.
BLOCK_BYTES = 32 << 20
SPANS = "spans"
FOUND = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType())]))
_RANGES = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
OUTPUTS = [
    T.StructField("n_words", T.LongType()),
    # Word positions covered by occurring windows, as disjoint ranges in order.
    T.StructField(SPANS, FOUND),
    # The same as byte ranges of the text.
    T.StructField("byte_spans", FOUND),
    T.StructField("items", T.ArrayType(T.StringType())),
]


def item_words(text: Column) -> Column:
    """Words of a text after A-Z became a-z."""
    low = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_remove(F.split(low, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``window, items``: the different windows of all test items, as joined words, and the items they are from."""
    split = items.select(F.col("item_id").cast("string").alias("item"), item_words(F.col("text")).alias("w"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)))
    each = split.filter(F.size("w") > 0).select("item", "w", F.explode(starts).alias("i"))
    joined = F.array_join(F.slice("w", F.col("i") + 1, window), " ")
    return each.groupBy(joined.alias("window")).agg(F.array_sort(F.collect_set("item")).alias("items"))


# A part of the window set: hashes by window size, and the items by window.
Block = tuple[dict[int, np.ndarray], dict[str, list[str]]]


def block_of(windows: pa.Table) -> Block:
    texts = windows.column("window").combine_chunks().cast(pa.string())
    found = words(texts, PLAIN)
    hashes: dict[int, list] = {}
    for i, n in enumerate(found.counts()):
        own = found.hashes[found.first[i] : found.first[i + 1]]
        hashes.setdefault(int(n), []).append(window_hashes(own, int(n)))
    sets = {n: np.unique(np.concatenate(parts)) for n, parts in hashes.items()}
    return sets, dict(zip(texts.to_pylist(), windows.column("items").to_pylist()))


def member(sorted_values: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which of ``values`` are in ``sorted_values``. A table of the top bits sorts out nearly all others first."""
    bits = max(10, min(22, int(len(sorted_values)).bit_length() + 6))
    shift = np.uint64(64 - bits)
    table = np.zeros(1 << bits, bool)
    table[sorted_values >> shift] = True
    maybe = np.flatnonzero(table[values >> shift])
    at = np.searchsorted(sorted_values, values[maybe])
    at[at == len(sorted_values)] = 0
    return maybe[sorted_values[at] == values[maybe]]


def merged(ranges: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint ranges in order with the same members."""
    out: list[tuple[int, int]] = []
    for start, stop in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(stop, out[-1][1]))
        else:
            out.append((start, stop))
    return out


def scan(texts: pa.Array, block: Block) -> list[pa.Array]:
    """The output columns for a run of texts."""
    found = words(texts, PLAIN)
    known_hashes, known_items = block
    hits: dict[int, list[tuple[int, int]]] = {}
    items: dict[int, set[str]] = {}
    for size, known in known_hashes.items():
        hashes = window_hashes(found.hashes, size)
        for at in member(known, hashes).tolist():
            text = int(found.text[at])
            if text != found.text[at + size - 1]:
                continue
            each = zip(found.starts[at : at + size].tolist(), found.ends[at : at + size].tolist())
            window = b" ".join(found.data[start:end].tobytes() for start, end in each).lower()
            if (named := known_items.get(window.decode("utf-8", "replace"))) is not None:
                hits.setdefault(text, []).append((at, at + size))
                items.setdefault(text, set()).update(named)
    first_byte = utf8(texts)[1]
    spans: list[list] = [[] for _ in range(len(texts))]
    cuts: list[list] = [[] for _ in range(len(texts))]
    for text, ranges in hits.items():
        for start, stop in merged(ranges):
            spans[text].append((start - int(found.first[text]), stop - int(found.first[text])))
            origin = int(first_byte[text])
            cuts[text].append((int(found.starts[start]) - origin, int(found.ends[stop - 1]) - origin))
    return [
        pa.array(found.counts(), pa.int64()),
        pa.array(spans, _RANGES),
        pa.array(cuts, _RANGES),
        pa.array([sorted(items.get(text, ())) for text in range(len(texts))], pa.list_(pa.string())),
    ]


def find_passages(
    df: DataFrame, items: DataFrame, text: str | Column = "text", window: int = WINDOW, carry: Sequence[str] | None = None
) -> DataFrame:
    """``df`` with ``n_words``, the ``spans`` and ``byte_spans`` of test passages and the ``items`` they are from.

    While the windows fit one block this is one pass without a shuffle. Beyond, the documents get a row number and are
    scanned once per block; the hits of a row are then brought together.
    """
    spark = df.sparkSession
    windows = stage(item_windows(items, window), "test-windows")
    size = windows.agg(F.coalesce(F.sum(F.octet_length("window") + 64 + 32 * F.size("items")), F.lit(0))).first()[0]
    n_blocks = 1 + size // BLOCK_BYTES
    if n_blocks == 1:
        return _one_pass(df, windows.toArrow(), text, carry)
    rows = stage(df.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    passes = []
    for number in range(n_blocks):
        part = windows.filter(F.pmod(F.xxhash64("window"), F.lit(n_blocks)) == number)
        passes.append(_one_pass(rows, part.toArrow(), text, ["_row"]))
    found = passes[0]
    for other in passes[1:]:
        found = found.unionByName(other)
    parts = found.groupBy("_row").agg(
        F.max("n_words").alias("n_words"),
        *[F.flatten(F.collect_list(name)).alias(name) for name in (SPANS, "byte_spans", "items")],
    )
    joined = parts.select(
        "_row", "n_words", _union(SPANS), _union("byte_spans"), F.array_sort(F.array_distinct("items")).alias("items")
    )
    names = [f.name for f in OUTPUTS]
    kept = [name for name in (df.columns if carry is None else carry) if name not in names]
    return rows.select("_row", *kept).join(joined, "_row").select(*kept, *names)


def _one_pass(df: DataFrame, windows: pa.Table, text: str | Column, carry: Sequence[str] | None) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(block_of(windows))

    def start():
        block = shared.value
        return lambda texts: scan(texts, block)

    return beside(df, text, OUTPUTS, start, carry)


def _union(name: str) -> Column:
    """Disjoint ranges in order out of ranges that may overlap; one text has few."""

    def add(done: Column, span: Column) -> Column:
        last = F.element_at(done, -1)
        longer = F.struct(last["start"].alias("start"), F.greatest(last["stop"], span["stop"]).alias("stop"))
        apart = (F.size(done) == 0) | (span["start"] > F.try_element_at(done, F.lit(-1))["stop"])
        return F.when(apart, F.concat(done, F.array(span))).otherwise(
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer))
        )

    empty = F.array().cast("array<struct<start:int,stop:int>>")
    return F.aggregate(F.array_sort(F.col(name)), empty, add).alias(name)


def n_hit() -> Column:
    """Words inside test passages."""
    return F.aggregate(SPANS, F.lit(0).cast("long"), lambda total, span: total + (span["stop"] - span["start"]))


def contaminated(share: int = 20) -> Column:
    """True if words were hit, and at least one in ``share``."""
    return (n_hit() > 0) & (n_hit() * share >= F.col("n_words"))


def drop_documents(df: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``df`` that are not contaminated, with their own columns."""
    plain = df.select(F.struct(*[F.col(f"`{name}`") for name in df.columns]).alias("_kept"))
    judged = find_passages(plain, items, F.col("_kept").getField(text), carry=["_kept"])
    return judged.filter(~contaminated()).select("_kept.*")


def cut_passages(text: str | None, byte_spans: Sequence) -> str | None:
    """``text`` without the byte ranges; null stays null."""
    if text is None:
        return None
    data, at, kept = text.encode(), 0, []
    for span in byte_spans:
        kept.append(data[at : span["start"]])
        at = span["stop"]
    return b"".join([*kept, data[at:]]).decode("utf-8", "replace")


def remove_passages(df: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """All rows of ``df`` with the test passages cut out of their texts; null texts stay null."""
    cut = F.udf(cut_passages, "string")
    plain = df.select(F.struct(*[F.col(f"`{name}`") for name in df.columns]).alias("_kept"), F.col(text).alias("text"))
    judged = find_passages(plain, items, carry=["_kept", "text"])
    value = F.when(F.size("byte_spans") > 0, cut("text", "byte_spans")).otherwise(F.col("text"))
    return judged.select("_kept.*", value.alias("_value")).withColumn(text, F.col("_value")).drop("_value")


def verdicts(df: DataFrame, items: DataFrame) -> DataFrame:
    """Per document: words, hit words, items with occurring windows and the verdict."""
    judged = find_passages(df.select("doc_id", "text"), items, carry=["doc_id"])
    return judged.select(
        "doc_id",
        "n_words",
        n_hit().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )
