"""Term counts, vocabulary and TF-IDF as plain tables.

The tables are long: one row per text and distinct term. Nothing is ever collected per text or per
term; the only sides that are broadcast are vocabularies whose size was measured first.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reviewgrove.functions.tokens import term_runs
from reviewgrove.session import stage

MIN_DF = 10.0
# Largest number of terms of the fitted ML stage. The long form has no limit.
VOCAB_SIZE = 1 << 18
BROADCAST_LIMIT = 64 * 1024 * 1024
# Room for the numbers and the row header next to the term itself.
_BYTES_PER_ROW = 64


def term_counts(df: DataFrame, words: str | Column, keep: Sequence[str]) -> DataFrame:
    """One row per text and distinct term: the kept columns, ``term``, ``tf``. No shuffle."""
    words = F.col(words) if isinstance(words, str) else words
    return df.select(*keep, F.inline(term_runs(words)))


def each_word(df: DataFrame, words: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per word: the kept columns, ``pos``, ``term``.

    In front of a plain explode Spark puts a filter on the size of the array, which computes the array
    from the text once more. The outer form has no such filter; its rows for empty arrays are dropped.
    """
    return df.select(*keep, F.posexplode_outer(words).alias("pos", "term")).filter(F.col("term").isNotNull())


def distinct_words(df: DataFrame, words: str) -> DataFrame:
    """All different words of a corpus as ``term``; each task sends a word once."""
    return each_word(df, words).select("term").distinct()


def _bounds(min_df: float, max_df: float | None, n_docs: int) -> Column:
    """Document-frequency limits; a limit below one is a share of all texts."""
    low = min_df if min_df >= 1 else min_df * n_docs
    inside = F.col("df") >= low
    if max_df is not None:
        inside &= F.col("df") <= (max_df if max_df >= 1 else max_df * n_docs)
    return inside


def document_frequencies(cells: DataFrame) -> DataFrame:
    """``term, df, corpus_count`` from long term counts.

    Every task sums its own rows first, so a term that occurs in most texts sends one row per task.
    """
    return cells.groupBy("term").agg(
        F.count(F.lit(1)).alias("df"),
        F.sum("tf").alias("corpus_count"),
    )


def word_frequencies(df: DataFrame, words: str) -> DataFrame:
    """``document_frequencies`` of the texts straight from their words, without the counts per text.

    Every word goes into the sums of its task once as it occurs and once per text, which takes half the time of sorting each text.
    """
    both = df.select(F.posexplode(F.array(F.col(words), F.array_distinct(words))).alias("per_text", "words"))
    each = both.select("per_text", F.explode("words").alias("term")).filter(F.col("term").isNotNull())
    return each.groupBy("term").agg(
        F.sum("per_text").cast("bigint").alias("df"),
        F.sum(1 - F.col("per_text")).cast("bigint").alias("corpus_count"),
    )


def most_frequent(terms: DataFrame, size: int) -> DataFrame:
    """The ``size`` terms with the highest corpus count; equal counts in the order of the term.

    The lowest count that still gets in is found from the number of terms per count, which is a far
    smaller table than the terms, so no task has to hold or sort all candidates.
    """
    ahead = Window.orderBy(F.desc("corpus_count")).rowsBetween(Window.unboundedPreceding, -1)
    per_count = terms.groupBy("corpus_count").agg(F.count(F.lit(1)).alias("n"))
    last = (
        per_count.withColumn("ahead", F.coalesce(F.sum("n").over(ahead), F.lit(0)))
        .filter(F.col("ahead") < size)
        .orderBy("corpus_count")
        .first()
    )
    if last is None:
        return terms.limit(0)
    if last["ahead"] + last["n"] <= size:
        return terms.filter(F.col("corpus_count") >= last["corpus_count"])
    at_limit = terms.filter(F.col("corpus_count") == last["corpus_count"])
    return terms.filter(F.col("corpus_count") > last["corpus_count"]).unionByName(
        at_limit.orderBy("term").limit(size - last["ahead"])
    )


@dataclass(frozen=True)
class Vocabulary:
    """Written table ``term, df, corpus_count, idf`` and its measured size."""

    table: DataFrame
    n_docs: int
    n_terms: int
    n_bytes: int
    n_dropped: int = 0

    def side(self, *columns: str) -> DataFrame:
        """Join side: broadcast while it is small, else left to a shuffle join with skew handling."""
        picked = self.table.select(*columns)
        return F.broadcast(picked) if self.n_bytes <= BROADCAST_LIMIT else picked


def fit_vocabulary(
    cells: DataFrame,
    n_docs: int,
    min_df: float = MIN_DF,
    vocab_size: int | None = None,
    max_df: float | None = None,
) -> Vocabulary:
    """Terms that occur in at least ``min_df`` texts: all of them, or with ``vocab_size`` the most frequent.

    ``n_dropped`` of the result says how many terms the cut left out.
    """
    return cut_vocabulary(document_frequencies(cells), n_docs, min_df, vocab_size, max_df)


def cut_vocabulary(
    frequencies: DataFrame, n_docs: int, min_df: float = MIN_DF, vocab_size: int | None = None, max_df: float | None = None
) -> Vocabulary:
    """``fit_vocabulary`` from the ``term, df, corpus_count`` of all words."""
    terms = stage(frequencies.filter(_bounds(min_df, max_df, n_docs)), "terms")
    n_terms, n_bytes = _measure(terms)
    n_dropped = 0
    if vocab_size is not None and n_terms > vocab_size:
        n_dropped = n_terms - vocab_size
        terms = stage(most_frequent(terms, vocab_size), "terms")
        n_terms, n_bytes = _measure(terms)
    idf = F.log((F.lit(n_docs) + 1.0) / (F.col("df") + 1.0))
    return Vocabulary(terms.withColumn("idf", idf), n_docs, n_terms, n_bytes, n_dropped)


def _measure(terms: DataFrame) -> tuple[int, int]:
    row = terms.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(F.octet_length("term")), F.lit(0)).alias("chars"),
    ).first()
    return row["n"], row["chars"] + row["n"] * _BYTES_PER_ROW


def lowest_hot_count(vocabulary: Vocabulary, limit: int) -> int | None:
    """The lowest corpus count at which all terms from there upwards fit ``limit`` bytes together; None if not even the first do.

    Found from the bytes per count, a far shorter table than the terms.
    """
    size = F.sum(F.octet_length("term") + _BYTES_PER_ROW)
    per_count = vocabulary.table.groupBy("corpus_count").agg(size.alias("size"))
    upto = F.sum("size").over(Window.orderBy(F.desc("corpus_count")).rowsBetween(Window.unboundedPreceding, 0))
    return per_count.select("corpus_count", upto.alias("upto")).filter(F.col("upto") <= limit).agg(F.min("corpus_count")).first()[0]


def weigh(cells: DataFrame, vocabulary: Vocabulary, limit: int | None = None) -> DataFrame:
    """Add ``tfidf`` to long term counts and drop terms outside the vocabulary.

    A vocabulary of up to ``limit`` bytes (default: BROADCAST_LIMIT) is broadcast. Of a larger one the most frequent terms, as many as fit, are
    broadcast, and they hold most of the cells. Only the cells of the other terms are shuffled to meet theirs, so no
    term with very many cells goes through a shuffle.
    """
    limit = BROADCAST_LIMIT if limit is None else limit
    sides = vocabulary.table.select("term", "idf", "corpus_count")
    if vocabulary.n_bytes <= limit:
        joined = cells.join(F.broadcast(sides), "term")
    elif (least := lowest_hot_count(vocabulary, limit)) is None:
        joined = cells.join(sides, "term")
    else:
        hot = F.broadcast(sides.filter(F.col("corpus_count") >= least))
        rest = cells.join(hot.select("term"), "term", "left_anti")
        joined = cells.join(hot, "term").unionByName(rest.join(sides.filter(F.col("corpus_count") < least), "term"))
    return joined.select(
        *[c for c in cells.columns if c not in ("idf", "corpus_count")],
        (F.col("tf") * F.col("idf")).alias("tfidf"),
    )
