"""Pack token ids into sequences of bounded length with a fixed number of open windows per task.

Each task goes through its documents in order. Full windows of a long document go out at once; what is left goes into
the open window where it fits best. When it fits in none and all windows are open, the fullest one goes out. The windows
still open at the end of a task are merged over tasks, in rounds of a fixed fan-in, by the same best fit on their
pieces, longest first. Only the places of these pieces move, never the ids.

Defined cases: a null or empty text has the end id only; repeated rows are packed as often as they come; rows
without a document number are packed like others; an empty table gives no pieces. Other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewgrove.llm.batches import give_back
from reviewgrove.llm.tokens import encoded
from reviewgrove.session import bound_batches, stage

LENGTH = 2048
END_ID = 1
OPEN_WINDOWS = 128
# Bytes of text that are encoded at a time, and pieces that are sent back at a time. They bound the memory of a task.
SLICE_BYTES = 1 << 20
PIECES_AT_ONCE = 1024
# Tasks whose open windows are merged in one round by one group.
FAN_IN = 16
_PIECE = [
    ("doc_id", pa.int64()),
    ("start", pa.int64()),
    ("length", pa.int64()),
    ("doc_tokens", pa.int64()),
    ("ids", pa.binary()),
    ("part", pa.int32()),
    ("piece", pa.int64()),
    ("sequence_id", pa.int64()),
    ("offset", pa.int64()),
    ("open", pa.bool_()),
]
PIECE_SCHEMA = (
    "doc_id long, start long, length long, doc_tokens long, ids binary, part int, piece long, sequence_id long, "
    "`offset` long, open boolean"
)


class Windows:
    """At most ``limit`` open windows of ``length`` ids. ``add`` gives the windows that go out."""

    def __init__(self, length: int, limit: int | None) -> None:
        self.length, self.limit = length, limit
        self.free: list[tuple[int, int]] = []  # (room, window), in order
        self.held: dict[int, list] = {}
        self.made = 0

    def add(self, size: int, piece) -> list:
        at = bisect_left(self.free, (size, -1))
        out = []
        if at < len(self.free):
            room, window = self.free.pop(at)
        else:
            if self.limit is not None and len(self.free) >= self.limit:
                out.append(self.held.pop(self.free.pop(0)[1]))
            room, window = self.length, self.made
            self.made += 1
            self.held[window] = []
        self.held[window].append(piece)
        if room == size:
            out.append(self.held.pop(window))
        else:
            insort(self.free, (room - size, window))
        return out

    def rest(self) -> list:
        return [self.held[window] for _, window in self.free]


def _sequence(part: int, number: int, level: int = 0) -> int:
    """Number of a sequence: the merge round, the task or group, and a count within it."""
    return (level << 58) | (part << 34) | number


def place(df: DataFrame, tokenizer: str, length: int = LENGTH, windows: int = OPEN_WINDOWS, end_id: int = END_ID) -> DataFrame:
    """Pieces of ``doc_id, text`` with their ids; ``open`` ones lie in windows that were not yet full at the end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        part, sequence, piece = TaskContext.get().partitionId(), 0, 0
        state = Windows(length, windows)
        rows: list[tuple] = []

        def emit(pieces: list, is_open: bool) -> None:
            nonlocal sequence
            offset = 0
            for doc, start, size, total, ids, number in pieces:
                rows.append((doc, start, size, total, ids, part, number, _sequence(part, sequence), offset, is_open))
                offset += size
            sequence += 1

        def flush() -> pa.RecordBatch:
            columns = zip(*rows)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, (_, t) in zip(columns, _PIECE)], names=[n for n, _ in _PIECE]
            )

        for batch in batches:
            for first, last, ids, counts in encoded(batch.column(1), tokenizer, end_id, SLICE_BYTES):
                data, at = memoryview(ids).cast("B"), 0
                docs = batch.column(0).slice(first, last - first).to_pylist()
                for doc, total in zip(docs, counts.tolist()):
                    for start in range(0, total, length):
                        size = min(length, total - start)
                        own = bytes(data[4 * (at + start) : 4 * (at + start + size)])
                        for done in state.add(size, (doc, start, size, total, own, piece)):
                            emit(done, False)
                        piece += 1
                    at += total
                    if len(rows) >= PIECES_AT_ONCE:
                        yield flush()
                        rows.clear()
        for rest in state.rest():
            emit(rest, True)
        if rows:
            yield flush()
        rows.clear()
        give_back()

    bound_batches(df.sparkSession)
    texts = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, PIECE_SCHEMA)


def merge_round(pieces: DataFrame, level: int, length: int) -> DataFrame:
    """Pack the pieces of each group of tasks anew, longest first; a group holds a bounded number of windows."""

    def repack(table: pa.Table) -> pa.Table:
        group = table.column("group")[0].as_py()
        size, part, piece = (table.column(name).to_numpy() for name in ("length", "part", "piece"))
        order = np.lexsort((piece, part, -size))
        state = Windows(length, None)
        done = []
        for i in order.tolist():
            done += state.add(int(size[i]), i)
        rest = state.rest()
        sequence, offset, still = (np.zeros(len(size), t) for t in (np.int64, np.int64, bool))
        for number, rows in enumerate([*done, *rest]):
            at = 0
            for i in rows:
                sequence[i], offset[i], still[i] = _sequence(group, number, level), at, number >= len(done)
                at += int(size[i])
        return pa.table(
            {
                "part": table.column("part"),
                "piece": table.column("piece"),
                "length": table.column("length"),
                "group": pa.array(np.full(len(size), group, np.int32)),
                "sequence_id": sequence,
                "offset": offset,
                "open": still,
            }
        )

    schema = "part int, piece long, length long, group int, sequence_id long, `offset` long, open boolean"
    return pieces.groupBy("group").applyInArrow(repack, schema)


def pack(df: DataFrame, tokenizer: str, length: int = LENGTH, windows: int = OPEN_WINDOWS, end_id: int = END_ID) -> DataFrame:
    """Pieces with ids, their sequence and their place in it. Sequence numbers are unique, not gapless."""
    placed = stage(place(df, tokenizer, length, windows, end_id), "pieces")
    closed = placed.filter(~F.col("open"))
    columns = ["part", "piece", "length", "group", "sequence_id", "offset", "open"]
    last = placed.filter("open").select("part", "piece", "length", "sequence_id", "offset", "open")
    parts = last.agg(F.coalesce(F.max("part"), F.lit(0))).first()[0] + 1
    last = last.withColumn("group", F.col("part"))
    settled = None
    level = 0
    while parts > 1 or level == 0:
        level += 1
        parts = -(-parts // FAN_IN)
        todo = last.withColumn("group", F.floor(F.col("group") / FAN_IN).cast("int"))
        merged = stage(merge_round(todo.select(*columns), level, length), "merged")
        full = merged.filter(~F.col("open"))
        settled = full if settled is None else settled.unionByName(full)
        last = merged.filter("open")
    settled = settled.unionByName(last).select("part", "piece", "sequence_id", "offset")
    moved = placed.filter("open").drop("sequence_id", "offset").join(settled, ["part", "piece"])
    return closed.select(*[n for n, _ in _PIECE]).unionByName(moved.select(*[n for n, _ in _PIECE])).drop("open")


def padded_length(used: Column, length: int = LENGTH) -> Column:
    """Length of a sequence after padding: full, or as it is if that is a power of two."""
    return F.when(F.bit_count(used) == 1, used).otherwise(F.lit(length).cast("long"))


def sequences(pieces: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row per sequence: its ids, padding not written out, and its padded length. A group holds at most ``length`` ids."""
    in_order = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    whole = F.aggregate(in_order, F.lit(b"").cast("binary"), lambda done, piece: F.concat(done, piece["ids"]))
    return pieces.groupBy("sequence_id").agg(
        whole.alias("ids"), F.sum("length").alias("used"), padded_length(F.sum("length"), length).alias("padded")
    )


def piece_digests(df: DataFrame, tokenizer: str) -> DataFrame:
    """Place, length and checksum of every piece."""
    return pack(df, tokenizer).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
