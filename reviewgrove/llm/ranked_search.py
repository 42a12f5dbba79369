"""Rank all documents for many queries at once, with shared parts of the queries worked out once.

1. The terms of all items form one table. One pass over the texts keeps, per document, its number of terms and the counts of
   the terms that items ask for; it is written, so the texts are read once. Corpus counts come from that table.
2. Items that share terms share work. Pairs of terms, or of parts made before, that several items have in common are
   mined and become parts of their own, the most shared first. The result is a graph: an item is the sum of a few
   parts, a part the sum of two others.
3. For a run of documents, every part's partial scores are materialised once, as one array over the documents, and items are
   combined from these arrays along the graph. Each task keeps the best of its own documents per item; those are merged.

The items are taken in blocks of bounded size, by the hash of their number; what a block holds on the driver and
in the tasks does not grow with the documents.

Defined cases: a null or empty text has no terms and is not counted; a null item text, or one without terms, gives no rows; items
without a number give no rows; rows of one item number are one item, the same text counted once; documents without a number
count in the corpus and are not ranked; repeated documents are ranked one by one; equal scores go by number;
empty tables give an empty result. Very long texts are read whole. Other columns are not looked at.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator, Sequence
from copy import copy
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window

from reviewgrove.llm.batches import PLAIN, slices, words
from reviewgrove.session import stage

TOP = 10
SCALE = 1_000_000_000
# Terms, with repeats, of the items that are worked on at a time.
BLOCK_TERMS = 100_000
# Bytes of partial scores that a task holds at a time.
SCORE_BYTES = 32 << 20
# Of an item's parts, so many take part in the search for shared pairs. Only decides how much is shared.
MINED = 96
_MATCHES = "doc_id long, n long, terms array<int>, tfs array<long>"


def item_terms(items: DataFrame) -> DataFrame:
    """``item_id, term, q`` (occurrences) of the items that have a number."""
    rows = items.select("item_id", F.col("text").cast("string").alias("text")).filter("item_id IS NOT NULL").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            for first, last in slices(texts):
                found = words(texts.slice(first, last - first), PLAIN)
                terms = [term_bytes(found.data[s:e]).decode() for s, e in zip(found.starts, found.ends)]
                ids = batch.column(0).slice(first, last - first).take(pa.array(found.text))
                yield pa.RecordBatch.from_arrays([ids, pa.array(terms, pa.string())], names=["item_id", "term"])

    schema = T.StructType([items.schema["item_id"], T.StructField("term", T.StringType())])
    return rows.mapInArrow(run, schema).groupBy("item_id", "term").agg(F.count(F.lit(1)).alias("q"))


def term_bytes(data: np.ndarray) -> bytes:
    return data.tobytes().lower()


@dataclass(frozen=True)
class Wanted:
    """The terms of a block of items, sorted by hash: hashes, byte lengths, and the place of each in ``terms``."""

    hashes: np.ndarray
    lengths: np.ndarray
    places: np.ndarray

    @staticmethod
    def of(terms: Sequence[str]) -> Wanted:
        found = words(pa.array(terms, pa.string()), PLAIN)
        order = np.argsort(found.hashes, kind="stable")
        return Wanted(found.hashes[order], (found.ends - found.starts)[order], order.astype(np.int32))


def matches(df: DataFrame, terms: Sequence[str]) -> DataFrame:
    """``doc_id, n, terms, tfs`` per document: how many terms it has, and which of ``terms`` how often."""
    shared = df.sparkSession.sparkContext.broadcast(Wanted.of(terms))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, size = shared.value, len(terms)
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            for first, last in slices(texts):
                found = words(texts.slice(first, last - first), PLAIN)
                at = np.minimum(np.searchsorted(wanted.hashes, found.hashes), size - 1)
                hit = (wanted.hashes[at] == found.hashes) & (wanted.lengths[at] == found.ends - found.starts)
                pairs, tfs = np.unique(found.text[hit] * size + wanted.places[at[hit]], return_counts=True)
                cuts = pa.array(np.searchsorted(pairs // size, np.arange(last - first + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        pa.array(found.counts(), pa.int64()),
                        pa.ListArray.from_arrays(cuts, pa.array((pairs % size).astype(np.int32))),
                        pa.ListArray.from_arrays(cuts, pa.array(tfs.astype(np.int64))),
                    ],
                    names=["doc_id", "n", "terms", "tfs"],
                )

    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, _MATCHES)


@dataclass(frozen=True)
class Graph:
    """How items are put together: ``leaves`` (term, occurrences), ``parts`` as pairs of nodes, and the nodes of each item.

    Node numbers run over the leaves first and then over the parts, each part behind both of its nodes.
    """

    leaves: list[tuple[int, int]]
    parts: list[tuple[int, int]]
    items: list[list[int]]

    def additions(self) -> int:
        return len(self.parts) + sum(max(len(nodes) - 1, 0) for nodes in self.items)


def sharing_graph(items: Sequence[Sequence[tuple[int, int]]]) -> Graph:
    """Mine the parts that items share: again and again the pair of nodes that most items have together becomes one node."""
    leaves = sorted({leaf for item in items for leaf in item})
    number = {leaf: i for i, leaf in enumerate(leaves)}
    now = [{number[leaf] for leaf in item} for item in items]
    users = Counter(node for nodes in now for node in nodes)
    together: dict[tuple[int, int], set[int]] = {}

    def mined(nodes: set[int]) -> list[int]:
        return sorted(sorted((node for node in nodes if users[node] > 1), key=lambda node: (-users[node], node))[:MINED])

    for i, nodes in enumerate(now):
        few = mined(nodes)
        for k, a in enumerate(few):
            for b in few[k + 1 :]:
                together.setdefault((a, b), set()).add(i)
    together = {pair: who for pair, who in together.items() if len(who) > 1}
    heap = [(-len(who), pair) for pair, who in together.items()]
    heapq.heapify(heap)
    parts: list[tuple[int, int]] = []
    while heap:
        count, pair = heapq.heappop(heap)
        a, b = pair
        who = {i for i in together.get(pair, ()) if a in now[i] and b in now[i]}
        if len(who) < 2:
            continue
        if len(who) < -count:
            heapq.heappush(heap, (-len(who), pair))
            continue
        new = len(leaves) + len(parts)
        parts.append(pair)
        near: dict[int, set[int]] = {}
        for i in who:
            now[i] -= {a, b}
            for other in now[i]:
                near.setdefault(other, set()).add(i)
            now[i].add(new)
        for other, shared in near.items():
            if len(shared) > 1:
                together[(other, new)] = shared
                heapq.heappush(heap, (-len(shared), (other, new)))
    return Graph(leaves, parts, [sorted(nodes) for nodes in now])


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Ranking:
    """Partial scores of runs of documents along a graph, and the best documents per item so far."""

    def __init__(self, graph: Graph, weights: np.ndarray, n_docs: int, n_terms: int, top: int) -> None:
        self.graph, self.n_docs, self.n_terms, self.top = graph, n_docs, n_terms, top
        self.leaf_terms = np.array([term for term, _ in graph.leaves], np.int64)
        self.leaf_factors = weights[self.leaf_terms] * np.array([q for _, q in graph.leaves], np.int64)
        self.n_nodes = len(graph.leaves) + len(graph.parts)
        self.best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in graph.items]
        self.least = np.ones(len(graph.items), np.int64)
        # Leaves of each term, as ranges of the sorted leaves.
        self.first_leaf = np.searchsorted(self.leaf_terms, np.arange(len(weights) + 1))

    def fresh(self) -> Ranking:
        """The same plan with nothing ranked yet, for one task."""
        own = copy(self)
        own.best, own.least = list(self.best), self.least.copy()
        return own

    def rows_at_a_time(self) -> int:
        return max(1, SCORE_BYTES // (8 * (self.n_nodes + len(self.graph.items))))

    def add(self, ids: np.ndarray, n: np.ndarray, docs: np.ndarray, terms: np.ndarray, tfs: np.ndarray) -> None:
        """Documents ``ids`` with ``n`` terms; ``docs, terms, tfs`` are their counts (docs: place in ``ids``)."""
        m = 100 - 75 + (75 * n * self.n_docs) // self.n_terms
        values = (SCALE * tfs) // (1000 * tfs + 8 * m[docs])
        acc = np.zeros((self.n_nodes, len(ids)), np.int64)
        sizes = self.first_leaf[terms + 1] - self.first_leaf[terms]
        leaf = np.repeat(self.first_leaf[terms] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
        acc[leaf, np.repeat(docs, sizes)] = np.repeat(values, sizes) * self.leaf_factors[leaf]
        for place, (a, b) in enumerate(self.graph.parts, len(self.graph.leaves)):
            np.add(acc[a], acc[b], out=acc[place])
        for item, nodes in enumerate(self.graph.items):
            scores = acc[nodes].sum(axis=0)
            found = np.flatnonzero(scores >= self.least[item])
            if len(found):
                self._merge(item, scores[found], ids[found])

    def _merge(self, item: int, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.best[item][0], scores]), np.concatenate([self.best[item][1], ids])
        order = np.lexsort((ids, -scores))[: self.top]
        self.best[item] = scores[order], ids[order]
        if len(order) == self.top:
            self.least[item] = scores[order[-1]]


def ranked(found: DataFrame, item_ids: list, id_field: T.StructField, ranking: Ranking, top: int) -> DataFrame:
    """``item_id, rank, doc_id, score`` from the written ``matches``."""
    shared = found.sparkSession.sparkContext.broadcast((item_ids, ranking))
    schema = T.StructType([id_field, T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, plan = shared.value
        own = plan.fresh()
        step = own.rows_at_a_time()
        for whole in batches:
            for first in range(0, whole.num_rows, step):
                batch = whole.slice(first, step)
                lists, tfs = batch.column(2), batch.column(3)
                sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
                own.add(
                    batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64),
                    batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64),
                    np.repeat(np.arange(len(sizes)), sizes),
                    lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64),
                    tfs.flatten().to_numpy(zero_copy_only=False).astype(np.int64),
                )
        for name, (scores, ids) in zip(names, own.best):
            if len(ids):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(ids), id_type), pa.array(ids), pa.array(scores)], names=["item_id", "doc_id", "score"]
                )

    id_type = to_arrow_type(id_field.dataType)
    best = found.filter("doc_id IS NOT NULL AND size(terms) > 0").mapInArrow(run, schema)
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")


def search(df: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """``item_id, rank, doc_id, score``: the best documents of ``df`` (``doc_id, text``) for each item (``item_id, text``)."""
    asked = stage(item_terms(items), "item-terms")
    total = asked.agg(F.coalesce(F.sum("q"), F.lit(0))).first()[0]
    n_blocks = 1 + total // BLOCK_TERMS
    parts = []
    for number in range(n_blocks):
        # Bounded by the block: on average BLOCK_TERMS terms.
        rows = asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(n_blocks)) == number).orderBy("item_id", "term").collect()
        if rows:
            parts.append(_block(df, items.schema["item_id"], rows, top))
    if not parts:
        schema = T.StructType(
            [items.schema["item_id"], *[T.StructField(n, t) for n, t in (("rank", T.IntegerType()), ("doc_id", T.LongType()), ("score", T.LongType()))]]
        )
        return df.sparkSession.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, parts)


def _block(df: DataFrame, id_field: T.StructField, rows: list, top: int) -> DataFrame:
    terms = sorted({row["term"] for row in rows})
    place = {term: i for i, term in enumerate(terms)}
    bags: dict = {}
    for row in rows:
        bags.setdefault(row["item_id"], []).append((place[row["term"]], row["q"]))
    found = stage(matches(df, terms), "matches")
    corpus = found.filter("n > 0").agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    # One row per term of the block.
    per_term = found.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).collect()
    weights = np.zeros(len(terms), np.int64)
    for row in per_term:
        weights[row["term"]] = weight(corpus["docs"], row["df"])
    graph = sharing_graph(list(bags.values()))
    ranking = Ranking(graph, weights, corpus["docs"], max(corpus["terms"], 1), top)
    return ranked(found, list(bags), id_field, ranking, top)


SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents WHERE text IS NOT NULL
), i AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), q AS (
  SELECT item_id, term, count(*) AS q FROM i GROUP BY ALL
), c AS (
  SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS n_terms FROM d WHERE len(w) > 0
), o AS (
  SELECT doc_id, len(w) AS n, unnest(w) AS term FROM d
), t AS (
  SELECT doc_id, n, term, count(*) AS tf FROM o WHERE term IN (SELECT term FROM q) GROUP BY ALL
), f AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight FROM t, c GROUP BY term, n_docs
), p AS (
  SELECT doc_id, term, weight * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * n_docs) // n_terms))) AS part
  FROM t JOIN f USING (term), c
), s AS (
  SELECT item_id, doc_id, sum(q * part)::BIGINT AS score FROM p JOIN q USING (term) GROUP BY ALL
), r AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
  FROM s WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
"""
