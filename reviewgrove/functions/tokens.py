"""Token arrays: split of a cleaned text, stop words, counts per text. All inside the JVM and without a shuffle."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column
from pyspark.sql import functions as F


def stop_words() -> list[str]:
    """The English list that ships with Spark. Needs a running session."""
    return StopWordsRemover.loadDefaultStopWords("english")


def tokens(clean: Column) -> Column:
    """Words of a cleaned text, in order and with repeats. An empty text gives an empty array."""
    return F.array_remove(F.split(clean, " "), "")


def drop_stop_words(words: Column, stops: Sequence[str]) -> Column:
    """Words that are not in ``stops``, in order and with repeats. ``words`` are in lower case."""
    return F.filter(words, lambda word: ~word.isin(list(stops)))


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` applied to ``value`` with ``value`` computed once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def term_runs(words: Column) -> Column:
    """Distinct words of an array with their counts: ``array<struct<term, tf>>``.

    The words are sorted inside the row and counted as runs. A group-by on (id, term) would give the
    same and shuffle every token of the corpus; this shuffles nothing.
    """

    def count_runs(ordered: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(0), F.size(ordered) - 1),
            lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)),
        )
        return _bind(starts, lambda begin: spans(ordered, begin))

    def spans(ordered: Column, starts: Column) -> Column:
        return F.transform(
            starts,
            lambda start, k: F.struct(
                F.get(ordered, start).alias("term"),
                (F.coalesce(F.get(starts, k + 1), F.size(ordered)) - start).alias("tf"),
            ),
        )

    return F.when(F.size(words) > 0, _bind(F.sort_array(words), count_runs))
