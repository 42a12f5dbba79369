"""Group spelling variants: words one edit apart, found by walking a relational trie level by level.

1. Words are counted with their dealt damage; each task sums its own before the shuffle.
2. Two tries, one of the words and one of the words reversed, lie in tables of edges. A node is the hash of the path to it.
   ``steps`` leads from a node over the next STEP code points to a node below; ``gaps`` does the same behind one code
   point that is passed over. Behind every word stands an end mark, so whole words end at nodes of their own.
3. A state (word, position, node, edits) starts where the word lies on its own path, with no edits. Its first level is the edit: one
   join with the gaps gives the nodes that are reached by another code point in place of the word's, or in front of it, and by the
   code points that follow. All further levels join the states with the steps on node and code points; a state
   whose path ends is gone. States that pass the end mark are at a neighbour.
4. Edits in the second half of a word start from the trie of words, those in the first half from the trie of reversed words, so no
   state starts near a root, where all words share a few nodes. A word with one more code point is found from the shorter one.
5. Every pair is confirmed on the two words. The neighbour with the largest count is a word's form if it is common enough, and
   forms are followed to the last by joins, at most as often as counts can grow tenfold.

After LEVELS levels the rest of a state is passed at once: its end node follows from its node and what is left of the word. So a
run of a million letters takes no more rounds than a word of fifty.

Defined cases: a null or empty text has no words; documents without a number use an empty number in the checksum; repeated documents
count each; equal counts among neighbours go to the word that comes first by code points; an empty table gives an empty
result. Very long texts and runs are read whole. Other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewgrove.llm.batches import LOWER, mixed, slices, utf8, words
from reviewgrove.session import stage

DAMAGED = 31
LEAST_LENGTH = 7
LEAST_COUNT = 2
FORM_FACTOR = 10
STEP = 2
LEVELS = 16
# Levels that are joined before the states are written and counted.
LEVELS_AT_ONCE = 4
END = "\n"
# Nodes that states can start from or reach, by depth.
FIRST_GAP = LEAST_LENGTH // 2
FIRST_STEP = FIRST_GAP + 1 + STEP
WORDS_AT_ONCE = 1 << 14
_FORWARD, _BACKWARD = 0, 1
_LETTER = np.array([0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A for b in range(256)])
_LEAD = 0xC3
_LONG = 64


def letters(data: np.ndarray) -> np.ndarray:
    """Bytes of ``[A-Za-z\\u00C0-\\u00FF]``: ASCII letters, and the two bytes of characters that start with the byte C3."""
    lead = data == _LEAD
    found = _LETTER[data] | lead
    found[1:] |= lead[:-1]
    return found


def crc_table() -> np.ndarray:
    """Remainders of single bytes for the checksum of zlib."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & np.uint32(1), (table >> np.uint32(1)) ^ np.uint32(0xEDB88320), table >> np.uint32(1))
    return table


def checksums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, begun: np.ndarray) -> np.ndarray:
    """crc32 of each span of ``data`` behind text whose crc32 is ``begun``."""
    table, sizes = crc_table(), ends - starts
    out = ~begun.astype(np.uint32)
    order = np.argsort(-sizes, kind="stable")
    live = int(np.searchsorted(-sizes[order], -_LONG, "left"))
    for i in order[:live]:
        out[i] = ~np.uint32(zlib.crc32(data[starts[i] : ends[i]].tobytes(), int(begun[i])))
    order = order[live:]
    for j in range(int(sizes[order[0]]) if len(order) else 0):
        order = order[: int(np.searchsorted(-sizes[order], -j, "left"))]
        now = out[order]
        out[order] = table[(now ^ data[starts[order] + j]) & np.uint32(0xFF)] ^ (now >> np.uint32(8))
    return ~out


def runs_of(texts: pa.Array, ids: list) -> tuple[list[str], np.ndarray]:
    """The different words of some documents after damage, and how often each occurs. A word can come twice."""
    found = words(texts, letters)
    code_points = np.concatenate(([0], np.cumsum((found.data & 0xC0) != 0x80)))
    lengths = code_points[found.ends] - code_points[found.starts]
    kept = np.flatnonzero(lengths >= LEAST_LENGTH)
    starts, ends, lengths, hashes, text = (a[kept] for a in (found.starts, found.ends, lengths, found.hashes, found.text))
    if not len(kept):
        return [], np.zeros(0, np.int64)
    lower = LOWER[found.data]
    begun = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], np.uint32)
    h = checksums(lower, starts, ends, begun[text])
    damaged = h % DAMAGED == 0
    whole = np.flatnonzero(~damaged)
    _, at, counts = np.unique(hashes[whole], return_index=True, return_counts=True)
    out = [lower[starts[i] : ends[i]].tobytes().decode() for i in whole[at]]
    n = counts.tolist()
    for i in np.flatnonzero(damaged & (lengths > LEAST_LENGTH)):
        word, k = lower[starts[i] : ends[i]].tobytes().decode(), int(h[i]) % int(lengths[i])
        out.append(word[:k] + word[k + 1 :])
        n.append(1)
    return out, np.array(n, np.int64)


def word_counts(df: DataFrame) -> DataFrame:
    """``word, n`` of the words that are long and frequent enough, from ``doc_id, text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            for first, last in slices(texts):
                found, n = runs_of(texts.slice(first, last - first), batch.column(0).slice(first, last - first).to_pylist())
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array(n)], names=["word", "n"])

    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counted = rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.filter(F.col("n") >= LEAST_COUNT)


class Paths:
    """Code points and nodes of a run of words, each with the end mark: ``codes[first[i]:first[i + 1]]`` is word i."""

    def __init__(self, found: pa.Array, side: int) -> None:
        data, offsets = utf8(pc.utf8_reverse(found) if side == _BACKWARD else found)
        joined = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32).astype(np.int64)
        sizes = pc.utf8_length(found).to_numpy(zero_copy_only=False).astype(np.int64)
        self.lengths = sizes
        self.first = np.concatenate(([0], np.cumsum(sizes + 1)))
        self.codes = np.full(int(self.first[-1]), ord(END), np.int64)
        is_mark = np.zeros(len(self.codes), bool)
        is_mark[self.first[1:] - 1] = True
        self.codes[~is_mark] = joined
        # nodes[first[i] + i + d] is the node at depth d of word i; there is one more of them than code points.
        self.nodes = np.empty(len(self.codes) + len(found), np.uint64)
        at, place = self.first[:-1], self.first[:-1] + np.arange(len(found))
        self.place = place
        now = np.full(len(found), side + 1, np.uint64)
        self.nodes[place] = now
        order = np.argsort(-sizes, kind="stable")
        for d in range(int(sizes.max(initial=-1)) + 1):
            order = order[: int(np.searchsorted(-sizes[order], -d, "right"))]
            now = below(self.nodes[place[order] + d], self.codes[at[order] + d])
            self.nodes[place[order] + d + 1] = now

    def code(self, word: np.ndarray, position: np.ndarray) -> np.ndarray:
        """Code points at positions; 0 behind the end mark."""
        inside = position <= self.lengths[word]
        return np.where(inside, self.codes[np.minimum(self.first[word] + position, len(self.codes) - 1)], 0)

    def node(self, word: np.ndarray, depth: np.ndarray) -> np.ndarray:
        return self.nodes[self.place[word] + np.minimum(depth, self.lengths[word] + 1)]

    def label(self, word: np.ndarray, position: np.ndarray) -> np.ndarray:
        """The STEP code points from ``position`` on, as one number."""
        out = np.zeros(len(word), np.int64)
        for k in range(STEP):
            out = (out << 21) | self.code(word, position + k)
        return out

    def end(self) -> np.ndarray:
        return self.nodes[self.place + self.lengths + 1]

    def places(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word and position for all positions from ``low`` to below ``high`` of each word."""
        sizes = np.maximum(high - low, 0)
        word = np.repeat(np.arange(len(sizes)), sizes)
        return word, np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(low, sizes)


def below(node: np.ndarray, code: np.ndarray) -> np.ndarray:
    return mixed(node * np.uint64(0x9E3779B97F4A7C15) + code.astype(np.uint64))


def signed(nodes: np.ndarray) -> pa.Array:
    return pa.array(nodes.view(np.int64))


def _tables(counts: DataFrame, schema: str, rows_of) -> DataFrame:
    """Rows that ``rows_of(paths, side)`` makes of the column ``word``, for both tries."""
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, WORDS_AT_ONCE):
                found = batch.column(0).slice(first, WORDS_AT_ONCE).cast(pa.large_string())
                for side in (_FORWARD, _BACKWARD):
                    for arrays in rows_of(Paths(found, side), side):
                        yield pa.RecordBatch.from_arrays(arrays, names=names)

    return counts.select("word").mapInArrow(run, schema)


def gap_rows(paths: Paths, _: int) -> Iterator[list[pa.Array]]:
    """From each node over one code point ``passed`` and the label behind it."""
    word, p = paths.places(np.full(len(paths.lengths), FIRST_GAP), paths.lengths)
    passed = paths.code(word, p)
    yield [signed(paths.node(word, p)), pa.array(paths.label(word, p + 1)), pa.array(passed), signed(paths.node(word, p + 1 + STEP))]


def step_rows(paths: Paths, _: int) -> Iterator[list[pa.Array]]:
    word, p = paths.places(np.full(len(paths.lengths), FIRST_STEP), paths.lengths + 1)
    yield [signed(paths.node(word, p)), pa.array(paths.label(word, p)), signed(paths.node(word, p + STEP))]


def start_rows(paths: Paths, side: int) -> Iterator[list[pa.Array]]:
    """The places of each word in the half that belongs to the side, for both edits: another code point, one more."""
    ends = paths.end()
    half = paths.lengths // 2 if side == _FORWARD else paths.lengths - paths.lengths // 2
    for longer in (0, 1):
        word, p = paths.places(half, paths.lengths + longer)
        label_at = p + 1 - longer
        yield [
            signed(paths.node(word, p)), pa.array(paths.label(word, label_at)), pa.array(paths.code(word, p)),
            signed(ends[word]), pa.array(np.minimum(label_at + STEP, paths.lengths[word] + 1).astype(np.int32)),
            pa.array(np.full(len(word), 2 * side + longer, np.int8)),
        ]


def ends_of(counts: DataFrame) -> DataFrame:
    """``word, n, forward, backward``: the words with their end nodes in both tries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, WORDS_AT_ONCE):
                part = batch.slice(first, WORDS_AT_ONCE)
                found = part.column(0).cast(pa.large_string())
                both = [signed(Paths(found, side).end()) for side in (_FORWARD, _BACKWARD)]
                yield pa.RecordBatch.from_arrays([*part.columns, *both], names=["word", "n", "forward", "backward"])

    return counts.select("word", "n").mapInArrow(run, "word string, n long, forward long, backward long")


def label_of(rest: Column) -> Column:
    """The first STEP code points of what is left of a word, as the number that ``Paths.label`` makes of them."""
    out = F.lit(0).cast("long")
    for k in range(STEP):
        out = F.shiftleft(out, 21).bitwiseOR(F.ascii(F.substring(rest, k + 1, 1)).cast("long"))
    return out


def first_states(known: DataFrame) -> DataFrame:
    """``own, kind, node, rest`` behind the edit: ``own`` is the end node of the word, ``rest`` what is left of it.

    ``kind`` is twice the side, plus one if the other word is longer.
    """
    edge = ["node", "label"]
    gaps = _tables(known, "node long, label long, passed long, child long", gap_rows)
    # One row per place of the trie; as many entries as there are letters at most.
    gaps = gaps.groupBy(*edge).agg(F.collect_set(F.struct("passed", "child")).alias("ways"))
    starts = _tables(known, "node long, label long, code long, own long, position int, kind byte", start_rows)
    met = starts.join(gaps, edge).select("code", "own", "position", "kind", F.explode("ways").alias("way"))
    met = met.filter(F.col("way.passed") != F.col("code")).select("own", "position", "kind", F.col("way.child").alias("node"))
    sides = [
        known.select(F.col(name).alias("own"), F.lit(side).alias("side"), spelt.alias("spelt"))
        for side, name, spelt in ((_FORWARD, "forward", F.col("word")), (_BACKWARD, "backward", F.reverse("word")))
    ]
    spelt = sides[0].unionByName(sides[1])
    rest = F.substring(F.concat("spelt", F.lit(END)), F.col("position") + 1, F.length("spelt") + 1)
    return met.join(spelt, "own").select("own", "kind", "node", rest.alias("rest"))


def walk(states: DataFrame, steps: DataFrame) -> DataFrame:
    """``own, kind, node`` of the states that reach an end, from ``own, kind, node, rest``."""
    names = ["own", "kind", "node", "rest"]
    done = []
    for level in range(0, LEVELS, LEVELS_AT_ONCE):
        states = stage(states, "states")
        done.append(states.filter("rest = ''").select("own", "kind", "node"))
        states = states.filter("rest <> ''")
        if not states.limit(1).count():
            return reduce(DataFrame.unionByName, done)
        for _ in range(LEVELS_AT_ONCE):
            ended, going = states.filter("rest = ''"), states.filter("rest <> ''").withColumn("label", label_of(F.col("rest")))
            rest = F.substring(F.col("rest"), F.lit(STEP + 1), F.length("rest"))
            moved = going.join(steps, ["node", "label"]).select("own", "kind", F.col("child").alias("node"), rest.alias("rest"))
            states = moved.unionByName(ended.select(*names))
    states = stage(states, "states")
    return reduce(DataFrame.unionByName, [*done, states.mapInArrow(_jump, "own long, kind byte, node long")])


def _jump(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The node that all of ``rest`` leads to, whether it is there or not."""
    for batch in batches:
        node = batch.column(2).to_numpy().view(np.uint64).copy()
        for i, rest in enumerate(batch.column(3).to_pylist()):
            for code in rest:
                node[i : i + 1] = below(node[i : i + 1], np.array([ord(code)]))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), signed(node)], names=["own", "kind", "node"])


def neighbours(counts: DataFrame) -> DataFrame:
    """``word, n, near, near_n``: all ordered pairs of words of ``counts`` (``word, n``) that are one edit apart."""
    known = stage(ends_of(counts), "words")
    steps = _tables(known, "node long, label long, child long", step_rows)
    steps = stage(steps.groupBy("node", "label").agg(F.max("child").alias("child")), "steps")
    found = stage(walk(first_states(known), steps), "reached")
    pairs = []
    for side, name in ((_FORWARD, "forward"), (_BACKWARD, "backward")):
        mine = found.filter(F.shiftright("kind", 1) == side)
        one = known.select(F.col("word").alias("a"), F.col("n").alias("a_n"), F.col(name).alias("own"))
        two = known.select(F.col("word").alias("b"), F.col("n").alias("b_n"), F.col(name).alias("node"))
        pairs.append(mine.join(one, "own").join(two, "node").select("a", "a_n", "b", "b_n", (F.col("kind") % 2 == 1).alias("longer")))
    each = pairs[0].unionByName(pairs[1]).filter(F.levenshtein("a", "b", 1) == 1)
    back = each.filter("longer").select(F.col("b").alias("word"), F.col("b_n").alias("n"), F.col("a").alias("near"), F.col("a_n").alias("near_n"))
    there = each.select(F.col("a").alias("word"), F.col("a_n").alias("n"), F.col("b").alias("near"), F.col("b_n").alias("near_n"))
    return there.unionByName(back).distinct()


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of the words that have a ``form``: every round goes on to the form of the form."""
    now = forms.select("word", F.col("form").alias("root"))
    after = forms.select(F.col("word").alias("root"), F.col("form").alias("next"))
    while True:
        now = stage(now.join(after, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if not now.filter("moved").limit(1).count():
            return now.select("word", "root")
        now = now.select("word", "root")


def variants(df: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of the words of ``doc_id, text``."""
    counts = stage(word_counts(df), "word-counts")
    best = F.min_by(F.struct("near", "near_n"), F.struct(-F.col("near_n"), "near"))
    near = neighbours(counts).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    enough = F.col("best.near_n") >= FORM_FACTOR * F.col("n")
    told = stage(
        counts.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(enough, F.col("best.near")).alias("form"), F.when(enough, F.col("best.near_n")).alias("form_n"),
        ),
        "forms",
    )
    led = roots(told.filter("form IS NOT NULL"))
    return told.join(led, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


SQL = r"""
WITH RECURSIVE table8 AS (
  SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS v
  FROM range(256) t(i)
), crc AS (
  SELECT list(v ORDER BY i) AS t FROM table8
), o AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents
), r AS (
  SELECT doc_id, run, count(*) AS c, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x FROM o WHERE length(run) >= 7 GROUP BY ALL
), h AS (
  SELECT run, c, xor(4294967295, list_reduce(
    list_transform(range(length(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT),
    lambda s, b: xor(t[(xor(s, b) & 255) + 1], s >> 8), 4294967295)) AS h
  FROM r, crc
), d AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, c FROM h
), w AS (
  SELECT word, sum(c)::BIGINT AS n FROM d WHERE length(word) >= 7 GROUP BY word HAVING sum(c) >= 2
), e AS (
  SELECT word, n, length(word) AS l, p, substr(word, 1, p - 1) || substr(word, p + 1) AS less FROM w, LATERAL unnest(range(1, length(word) + 1)) u(p)
), pairs AS (
  SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM e a JOIN e b ON a.less = b.less AND a.p = b.p AND a.l = b.l AND a.word <> b.word
  UNION SELECT w.word, w.n, e.word, e.n FROM w JOIN e ON e.less = w.word
  UNION SELECT e.word, e.n, w.word, w.n FROM w JOIN e ON e.less = w.word
), b AS (
  SELECT word, count(*) AS n_near, arg_min({'near': near, 'near_n': near_n}, {'m': -near_n, 'near': near}) AS best FROM pairs GROUP BY word
), f AS (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near,
    CASE WHEN best.near_n >= 10 * w.n THEN best.near END AS form, CASE WHEN best.near_n >= 10 * w.n THEN best.near_n END AS form_n
  FROM w LEFT JOIN b USING (word)
), s AS (
  SELECT word, word AS root FROM f WHERE form IS NULL
  UNION ALL SELECT f.word, s.root FROM f JOIN s ON f.form = s.word
)
SELECT f.word, form, root, n, n_near, form_n::BIGINT AS form_n FROM f JOIN s USING (word)
"""
