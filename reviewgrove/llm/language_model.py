"""Quality classifier: an interpolated modified Kneser-Ney model of trusted text gives every document a perplexity.

The model predicts the bytes of every word, and its end, from up to four symbols before them; these run across the ends of words up to
the start of the text, so the order of words counts. The n-grams of all trusted documents are
counted in Spark; discounts, continuation counts and interpolated probabilities come from joins of the count tables, order by
order. The tables are dealt into shards by the two symbols before the predicted one, so that every event is looked up in one shard.
An event is not joined as a row, since a text has as many as bytes: the shards, each of bounded size, are
broadcast to the tasks that read the texts, and every task looks up each different n-gram of a run of texts once.
A document is kept if its perplexity per byte is at most the threshold of its language: a high quantile of the trusted
documents held out of the counts, with a margin.

Defined cases: a null or empty text has no perplexity and goes; a language without enough held-out documents, or none, is judged
by the quantile of all; equal perplexities are judged alike, and one that equals the threshold is kept; very long texts are read whole, piece by
piece; without any trusted document every text with a word is kept; repeated rows are judged one by
one; an empty table gives an empty result. Other columns are carried.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from reviewgrove.llm.batches import VISIBLE, Words, beside, slices, words
from reviewgrove.session import bound_batches, stage

ORDER = 5
BITS = 9
PAIRS = 1 << (2 * BITS)
START, END = 256, 257
# What can be predicted: 256 bytes and the end of a word.
OUTCOMES = 257
# Rows of the model in one broadcast shard, 12 bytes each.
SHARD_ROWS = 4_000_000
# Ids of trusted documents that are broadcast at most; more of them meet the texts by a shuffle.
BROADCAST_IDS = 1 << 22
# Of the trusted documents, one in so many is held out for the thresholds, by the hash of its text.
HELD_OUT = 8
QUANTILE = 0.995
MARGIN = 1.3
LEAST_HELD_OUT = 20
STEPS = 1000
# Bytes of text that are worked on at a time; every byte is an event of several numbers.
SLICE_BYTES = 1 << 19
# Discounts where the numbers of n-grams with small counts give none.
FEW = [0.5, 1.0, 1.5]
_IDENTITY = np.arange(256, dtype=np.uint8)


def events(found: Words) -> tuple[np.ndarray, np.ndarray]:
    """Packed n-grams of the highest order that end at each byte of a word and at its end, and the number of events per text."""
    sizes = found.ends - found.starts + 1
    total = int(sizes.sum())
    firsts = np.cumsum(sizes) - sizes
    within = np.arange(total) - np.repeat(firsts, sizes)
    is_end = within == np.repeat(sizes - 1, sizes)
    at = np.minimum(np.repeat(found.starts, sizes) + within, max(len(found.data) - 1, 0))
    symbols = np.where(is_end, END, found.data[at]).astype(np.int64) if total else np.zeros(0, np.int64)
    begins = np.concatenate((firsts, [total]))[found.first]
    counts = np.diff(begins)
    since = np.arange(total) - np.repeat(begins[:-1], counts)
    grams = symbols.copy()
    for back in range(1, ORDER):
        before = np.full(total, START, np.int64)
        has = np.flatnonzero(since >= back)
        before[has] = symbols[has - back]
        grams |= before << (BITS * back)
    return grams, counts


def trusted(labels: DataFrame) -> DataFrame:
    """``doc_id`` of all documents with labels that call them good and not toxic, and none that does not.

    Up to BROADCAST_IDS of them are broadcast, so that no text is shuffled for its label.
    """
    good = labels.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    good = good.filter("doc_id IS NOT NULL AND quality = 1 AND coalesce(toxic, 0) = 0").select("doc_id")
    good = stage(good, "trusted-ids")
    return F.broadcast(good) if good.count() <= BROADCAST_IDS else good


def held_out(text: Column) -> Column:
    return F.pmod(F.xxhash64(text), F.lit(HELD_OUT)) == 0


def gram_counts(texts: DataFrame) -> DataFrame:
    """``gram, c`` of the highest order over the column ``text``. A task sums its n-grams before they are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.fill_null(batch.column(0), "")
            for first, last in slices(texts, SLICE_BYTES):
                found = words(texts.slice(first, last - first), VISIBLE, _IDENTITY)
                keys, counts = np.unique(events(found)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts.astype(np.int64))], names=["gram", "c"])

    bound_batches(texts.sparkSession)
    return texts.select("text").mapInArrow(run, "gram long, c long").groupBy("gram").agg(F.sum("c").alias("c"))


def discounts(counts: DataFrame) -> list[float]:
    """Discounts for counts of one, two, and three or more, from the numbers of n-grams with small counts."""
    row = counts.agg(*[F.count_if(F.col("c") == i).alias(f"n{i}") for i in range(1, 5)]).first()
    n1, n2, n3, n4 = row
    if not (n1 and n2 and n3 and n4):
        return FEW
    y = n1 / (n1 + 2 * n2)
    found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return found if all(0 < v <= k + 1 for k, v in enumerate(found)) else FEW


def fit(grams: DataFrame) -> DataFrame | None:
    """The model as a written table ``order, key, p``: log probabilities of n-grams (order k), and log weights of the lower
    order by context (order -k). None without n-grams. ``grams`` are the counts of the highest order."""
    tables = {ORDER: stage(grams, "counts")}
    if tables[ORDER].limit(1).count() == 0:
        return None
    for order in range(ORDER - 1, 0, -1):
        shorter = F.col("gram").bitwiseAND(F.lit((1 << (BITS * order)) - 1))
        # Continuation counts: in how many n-grams of one symbol more the n-gram is the end.
        types = tables[order + 1].groupBy(shorter.alias("gram")).agg(F.count(F.lit(1)).alias("c"))
        tables[order] = stage(types, "counts")
    parts, lower = [], None
    for order in range(1, ORDER + 1):
        d = discounts(tables[order])
        discount = F.when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).otherwise(d[2])
        rows = tables[order].select("gram", "c", F.shiftright("gram", BITS).alias("context"), discount.alias("d"))
        contexts = rows.groupBy("context").agg(F.sum("c").alias("total"), (F.sum("d") / F.sum("c")).alias("weight"))
        joined = rows.join(contexts, "context")
        if lower is None:
            below: Column = F.lit(1.0 / OUTCOMES)
        else:
            tail = F.col("gram").bitwiseAND(F.lit((1 << (BITS * (order - 1))) - 1))
            joined = joined.withColumn("tail", tail).join(lower, "tail")
            below = F.col("below")
        p = (F.col("c") - F.col("d")) / F.col("total") + F.col("weight") * below
        solved = stage(joined.select("gram", p.alias("p")), "probabilities")
        lower = solved.select(F.col("gram").alias("tail"), F.col("p").alias("below"))
        parts.append(solved.select(F.lit(order).alias("order"), F.col("gram").alias("key"), F.log("p").alias("p")))
        parts.append(contexts.select(F.lit(-order).alias("order"), F.col("context").alias("key"), F.log("weight").alias("p")))
    return stage(reduce(DataFrame.unionByName, parts), "language-model")


def shards(model: DataFrame) -> list[tuple[DataFrame, list[int]]]:
    """The model by the two symbols before the predicted one, in parts of about SHARD_ROWS, and the pairs of each part.

    Orders 1 and 2, a bounded number of rows, are in every part; pairs that the model has not seen belong to the first.
    """
    keyed = model.withColumn("before", F.when(F.col("order") < 0, F.col("key")).otherwise(F.shiftright("key", BITS)) % PAIRS)
    everywhere = F.abs("order") <= 2
    # At most one row per pair of symbols, some 66,000.
    sizes = keyed.filter(~everywhere).groupBy("before").agg(F.count(F.lit(1)).alias("n")).orderBy("before").collect()
    ends, size = [], 0
    for row in sizes:
        if size and size + row["n"] > SHARD_ROWS:
            ends.append(row["before"])
            size = 0
        size += row["n"]
    borders = [0, *ends, PAIRS]
    return [
        (keyed.filter(everywhere | F.col("before").between(first, last - 1)).drop("before"), list(range(first, last)))
        for first, last in zip(borders, borders[1:])
    ]


def arrays_of(shard: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    table = shard.toArrow()
    order, key, p = (table.column(name).to_numpy() for name in ("order", "key", "p"))
    out = {}
    for k in np.unique(order).tolist():
        rows = np.flatnonzero(order == k)
        rows = rows[np.argsort(key[rows], kind="stable")]
        out[k] = (key[rows], p[rows].astype(np.float32))
    return out


def look_up(table: tuple[np.ndarray, np.ndarray] | None, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of ``keys`` and whether they are there."""
    if table is None or not len(table[0]):
        return np.zeros(len(keys), np.float32), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(table[0], keys), len(table[0]) - 1)
    there = table[0][at] == keys
    return np.where(there, table[1][at], np.float32(0)), there


def log_probabilities(grams: np.ndarray, model: dict) -> np.ndarray:
    """Natural log probability of each event: the longest known n-gram, with the weights of the contexts left behind."""
    out = np.zeros(len(grams))
    todo = np.arange(len(grams))
    for order in range(ORDER, 0, -1):
        keys = grams[todo] & ((1 << (BITS * order)) - 1)
        value, there = look_up(model.get(order), keys)
        out[todo[there]] += value[there]
        todo, keys = todo[~there], keys[~there]
        # A context that was never seen passes everything on, which is a weight of 1.
        out[todo] += look_up(model.get(-order), keys >> BITS)[0]
    out[todo] += np.log(1.0 / OUTCOMES)
    return out


def score(texts: pa.Array, model: dict, before: np.ndarray) -> list[pa.Array]:
    """Sum of log probabilities and number of events of each text, over events behind the pairs of the shard."""
    grams, counts = events(words(texts, VISIBLE, _IDENTITY))
    text = np.repeat(np.arange(len(texts)), counts)
    here = before[(grams >> BITS) & (PAIRS - 1)]
    if not here.all():
        grams, text = grams[here], text[here]
    keys, place = np.unique(grams, return_inverse=True)
    total = np.bincount(text, weights=log_probabilities(keys, model)[place], minlength=len(texts))
    return [pa.array(total, pa.float64()), pa.array(np.bincount(text, minlength=len(texts)), pa.int64())]


OUTPUTS = [T.StructField("log_p", T.DoubleType()), T.StructField("n_events", T.LongType())]


@dataclass(frozen=True)
class Scorer:
    """The model in shared parts, each with the symbols before the predicted one that it decides on."""

    parts: list[tuple[Broadcast, np.ndarray]]

    @staticmethod
    def of(model: DataFrame) -> Scorer:
        parts = []
        for shard, symbols in shards(model):
            before = np.zeros(PAIRS, bool)
            before[symbols] = True
            parts.append((model.sparkSession.sparkContext.broadcast(arrays_of(shard)), before))
        return Scorer(parts)

    def scored(self, df: DataFrame, text: str | Column = "text", carry: Sequence[str] | None = None) -> DataFrame:
        """``df`` with ``log_p`` and ``n_events``. One pass over the texts per part, and mostly there is one part."""
        if len(self.parts) == 1:
            return _pass(df, self.parts[0], text, carry)
        kept = [name for name in (df.columns if carry is None else carry) if name not in ("log_p", "n_events")]
        rows = stage(df.withColumn("_row", F.monotonically_increasing_id()), "numbered")
        each = reduce(DataFrame.unionByName, [_pass(rows, part, text, ["_row"]) for part in self.parts])
        sums = each.groupBy("_row").agg(F.sum("log_p").alias("log_p"), F.sum("n_events").alias("n_events"))
        return rows.select("_row", *kept).join(sums, "_row").drop("_row")


def _pass(df: DataFrame, part: tuple[Broadcast, np.ndarray], text: str | Column, carry: Sequence[str] | None) -> DataFrame:
    shared, before = part

    def start():
        model = shared.value
        return lambda texts: score(texts, model, before)

    return beside(df, text, OUTPUTS, start, carry, SLICE_BYTES)


def perplexity() -> Column:
    """Per event; null without one. Rounded, so that the order of sums does not show."""
    return F.when(F.col("n_events") > 0, F.round(F.exp(-F.col("log_p") / F.col("n_events")), 6))


def thresholds(held: DataFrame) -> DataFrame:
    """``lang, threshold`` and one row with a null language for all others, from ``lang, perplexity``.

    Quantiles come from the number of documents per step of the log perplexity, a table of bounded length.
    """
    step = F.floor(F.log("perplexity") * STEPS)
    both = held.filter("perplexity IS NOT NULL AND lang IS NOT NULL").select("lang", step.alias("step"), F.lit(False).alias("any"))
    every = held.filter("perplexity IS NOT NULL").select(F.lit(None).cast("string").alias("lang"), step.alias("step"), F.lit(True).alias("any"))
    per_step = both.unionByName(every).groupBy("any", "lang", "step").agg(F.count(F.lit(1)).alias("n"))
    group = Window.partitionBy("any", "lang")
    upto = per_step.withColumn("upto", F.sum("n").over(group.orderBy("step"))).withColumn("total", F.sum("n").over(group))
    reached = upto.filter(F.col("upto") >= F.col("total") * QUANTILE).groupBy("any", "lang").agg(
        F.min("step").alias("step"), F.max("total").alias("total")
    )
    value = F.exp((F.col("step") + 1) / STEPS) * MARGIN
    return reached.filter(F.col("any") | (F.col("total") >= LEAST_HELD_OUT)).select("any", "lang", value.alias("threshold"))


def judged(df: DataFrame, labels: DataFrame, carry: Sequence[str] | None = None) -> DataFrame:
    """``df`` as one struct ``_row`` with ``perplexity``, ``threshold`` and ``kept``.

    The thresholds come from the held-out trusted documents alone, so they are known before the one pass over all texts, and
    nothing of that pass has to be written.
    """
    names = list(df.columns if carry is None else carry)
    good = trusted(labels)
    whole = F.coalesce(F.col("text").cast("string"), F.lit(""))
    known = df.select("doc_id", F.col("lang").cast("string").alias("lang"), whole.alias("text")).join(good, "doc_id", "left_semi")
    model = fit(gram_counts(known.filter(~held_out(F.col("text")))))
    rows = df.select(F.struct(*[F.col(f"`{name}`") for name in names]).alias("_row"), F.col("lang").cast("string").alias("_lang"), whole.alias("_text"))
    own_text = F.col("_row").getField("text") if "text" in names else F.col("_text")
    if model is None:
        value = F.lit(None).cast("double")
        return rows.select("_row", value.alias("perplexity"), value.alias("threshold"), F.col("_text").rlike(r"[^\x20\x09-\x0D]").alias("kept"))
    scorer = Scorer.of(model)
    held = scorer.scored(known.filter(held_out(F.col("text"))), "text", ["doc_id", "lang"])
    limits = stage(thresholds(held.select("lang", perplexity().alias("perplexity"))), "thresholds")
    # One row per language that is common enough, measured by the number of its documents.
    by_language = F.broadcast(limits.filter("NOT any").select(F.col("lang").alias("_lang"), F.col("threshold").alias("own")))
    overall = limits.filter("any").agg(F.max("threshold").alias("t")).first()["t"]
    found = scorer.scored(rows, own_text, ["_row", "_lang"]).select("_row", "_lang", perplexity().alias("perplexity"))
    limit = F.coalesce(F.col("own"), F.lit(overall).cast("double"))
    kept = F.col("perplexity").isNotNull() & F.coalesce(F.col("perplexity") <= limit, F.lit(True))
    return found.join(by_language, "_lang", "left").select("_row", "perplexity", limit.alias("threshold"), kept.alias("kept"))


def verdicts(df: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document its perplexity, the threshold of its language and the verdict."""
    found = judged(df.select("doc_id", "text", "lang"), labels, ["doc_id", "lang"])
    return found.select("_row.*", "perplexity", "threshold", "kept")


def keep_documents(df: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``df`` that are kept, with their own columns."""
    return judged(df, labels).filter("kept").select("_row.*")
