"""Deal documents to shards on a hash ring with virtual nodes and bounded loads.

Every shard has VIRTUAL points on the ring; a document belongs to the shard of the next point clockwise. A shard takes as
many documents as its share, equal to one; what overflows goes on clockwise to the next point whose shard has
room. Which documents of an arc stay is decided by their place on the ring, so the result does not depend on the layout.
The walk needs the number of documents per arc only, a table of fixed length; the documents find their shard and slot by
their place in the order of the ring, which comes from a range partitioned sort.

Defined cases: a null text is empty; documents without a number are dealt by a fixed place; repeated rows are dealt as
often as they come; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from reviewgrove.session import stage

SHARDS = 16
VIRTUAL = 64
RING_BITS = 62


def points(shards: int, virtual: int) -> list[tuple[int, int]]:
    """``(place, shard)`` of all virtual nodes, in ring order."""
    places = []
    for shard in range(shards):
        for number in range(virtual):
            digest = hashlib.sha256(f"shard-{shard}-{number}".encode()).digest()
            places.append((int.from_bytes(digest[:8], "big") >> (64 - RING_BITS), shard))
    return sorted(places)


def place_of(doc_id: Column) -> Column:
    """Place of a document on the ring; those without a number share one place."""
    return F.xxhash64(F.lit("document"), doc_id).bitwiseAND(F.lit((1 << RING_BITS) - 1))


def walk(counts: list[int], owners: list[int], capacity: list[int]) -> list[list[tuple[int, int]]]:
    """``(shard, documents)`` for each arc in the order in which its documents are taken.

    ``counts`` are the documents per arc and ``owners`` the shards of the virtual nodes in ring order; arc i ends at node
    i, and the last arc goes on to the first. In every round each arc offers what is left of it to one node further on.
    """
    room, left, n = list(capacity), list(counts), len(owners)
    taken: list[list[tuple[int, int]]] = [[] for _ in counts]
    for step in range(n):
        if not any(left):
            break
        for arc in range(len(counts)):
            shard = owners[(arc + step) % n]
            share = min(left[arc], room[shard])
            if share:
                taken[arc].append((shard, share))
                left[arc] -= share
                room[shard] -= share
    return taken


def segments(taken: list[list[tuple[int, int]]]) -> list[tuple[int, int, int]]:
    """``(first rank in ring order, shard, slot of the first)`` for every run of documents of one shard."""
    out, rank, used = [], 0, {}
    for runs in taken:
        for shard, size in runs:
            out.append((rank, shard, used.get(shard, 0)))
            used[shard] = used.get(shard, 0) + size
            rank += size
    return out


def ranked(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` with ``rank``, its place in the whole order from 0.

    Rows are dealt by ranges and numbered in their part; the parts, one row each, are summed up.
    """

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            columns = [*batch.columns, pa.array(np.full(n, part, np.int32)), pa.array(np.arange(at, at + n))]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "_part", "_at"])
            at += n

    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = T.StructType([*df.schema, T.StructField("_part", T.IntegerType()), T.StructField("_at", T.LongType())])
    rows = stage(dealt.mapInArrow(number, schema), "in-order")
    parts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("n"))
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = parts.select("_part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("_base"))
    placed = rows.join(F.broadcast(base), "_part")
    return placed.select(*df.columns, (F.col("_base") + F.col("_at")).alias("rank"))


def deal(df: DataFrame, shards: int = SHARDS, virtual: int = VIRTUAL) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` per row of ``doc_id, text``; numbers of documents at most one apart."""
    ring = points(shards, virtual)
    nodes, owners = np.array([place for place, _ in ring]), [shard for _, shard in ring]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = df.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        place_of(F.col("doc_id")).alias("place"),
    )
    rows = ranked(rows, ["place", "doc_id", "size", "text_crc32"])

    def arcs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.searchsorted(nodes, batch.column(0).to_numpy()).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(found)], names=["arc"])

    # One row per arc: one more than there are virtual nodes, for the places behind the last.
    found = rows.select("place").mapInArrow(arcs, "arc int").groupBy("arc").agg(F.count(F.lit(1)).alias("n")).collect()
    counts = [0] * (len(ring) + 1)
    for row in found:
        counts[row["arc"]] = row["n"]
    total = sum(counts)
    capacity = [total // shards + (shard < total % shards) for shard in range(shards)]
    runs = segments(walk(counts, owners, capacity))
    first, shard, slot = (np.array(column, np.int64) for column in (zip(*runs) if runs else ([0], [0], [0])))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank = batch.column(3).to_numpy()
            at = np.searchsorted(first, rank, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(shard[at].astype(np.int32)), pa.array(slot[at] + rank - first[at])],
                names=["doc_id", "size", "text_crc32", "shard", "slot"],
            )

    return rows.select("doc_id", "size", "text_crc32", "rank").mapInArrow(
        place, "doc_id long, size long, text_crc32 long, shard int, slot long"
    )


def assignments(df: DataFrame) -> DataFrame:
    """Shards 0 to 15 under the law that numbers of documents are at most one apart."""
    return deal(df).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
