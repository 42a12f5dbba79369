"""Keep documents that read like trusted text, by base rules and a log-likelihood ratio of hashed n-grams.

Words and pairs of neighbouring words are hashed into a fixed number of buckets. Two multinomials over the buckets are
counted, one on all documents and one on all trusted ones that are not held out, and the score of a document is the mean over its n-grams of
log(trusted / raw). A document is kept if no base rule fails and its score reaches the threshold. That one lies a
margin below a low quantile of the scores of trusted documents held out of the counts.
Everything is built from DataFrame functions; the counts cover all rows.

Defined cases: a null or empty text has no words, fails the base rules and goes; repeated rows get the same verdict each; without any
trusted document only the base rules decide; an empty table gives an empty result. Columns other than the document
number and the text are not looked at; the stage carries them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reviewgrove.session import stage

BUCKETS = 1 << 18
SMOOTHING = 1.0
# Ids of trusted documents that are broadcast at most; more of them meet the texts by a shuffle.
BROADCAST_IDS = 1 << 22
# Of the trusted documents, one in so many is held out for the threshold, by the hash of its text.
HELD_OUT = 4
QUANTILE = 0.005
MARGIN = 0.1
STEPS = 1000
WINDOW = 8
LEAST_WORDS = 20
REPEAT_PERCENT = 30
_BLANK = r"[\x20\x09-\x0D]+"
_WORD = r"[^\x20\x09-\x0D]"
_SYMBOLS = "[#*$%&|<>]"


def bind(value: Column, body) -> Column:
    """``body`` of ``value``, with ``value`` computed once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def whole(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def words(text: Column) -> Column:
    return F.array_remove(F.split(whole(text), _BLANK), "")


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(whole(text), "\n", -1), lambda line: line.rlike(_WORD))
    return bind(lines, lambda kept: (F.size(kept) - F.size(F.array_distinct(kept))).cast("long"))


def joined(hashes: Column, step: int) -> Column:
    """Hash of each entry with the one ``step`` further on; shorter by ``step``."""
    upto = F.slice(hashes, 1, F.greatest(F.size(hashes) - step, F.lit(0)))
    return F.transform(upto, lambda h, i: F.xxhash64(h, F.get(hashes, i + step)))


def with_hashes(df: DataFrame, w: str = "_w") -> DataFrame:
    """``df`` with ``_h1``, the hashes of the words ``w``, and ``_h2``, those of pairs of neighbours."""
    single = df.withColumn("_h1", F.transform(w, lambda word: F.xxhash64(word)))
    return single.withColumn("_h2", joined(F.col("_h1"), 1))


def n_repeat_words(hashes: Column) -> Column:
    """Words inside windows that occur at least twice, by the hashes of all windows of 8 words.

    Most texts end at the comparison of the number of windows with that of different ones.
    """

    def covered(windows: Column) -> Column:
        placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return bind(placed, lambda ordered: spread(F.sort_array(F.transform(F.filter(ordered, again(ordered)), place))))

    def place(entry: Column) -> Column:
        return entry["i"]

    def again(ordered: Column):
        def test(entry: Column, k: Column) -> Column:
            before = F.get(ordered, k - 1)["h"]
            after = F.get(ordered, k + 1)["h"]
            return F.coalesce(before == entry["h"], F.lit(False)) | F.coalesce(after == entry["h"], F.lit(False))

        return test

    def spread(positions: Column) -> Column:
        return F.aggregate(
            positions,
            F.struct(F.lit(0).alias("n"), F.lit(0).alias("stop")),
            lambda done, i: F.struct(
                (done["n"] + i + WINDOW - F.greatest(i, done["stop"])).alias("n"), (i + WINDOW).alias("stop")
            ),
            lambda done: done["n"].cast("long"),
        )

    some = F.size(F.array_distinct(hashes)) < F.size(hashes)
    return F.when(some, covered(hashes)).otherwise(F.lit(0)).cast("long")


def base_columns(text: Column) -> dict[str, Column]:
    """From the text, its words ``_w`` and the hashes ``_h8`` of its windows."""
    return {
        "n_words": F.size("_w").cast("long"),
        "word_chars": F.length(F.array_join("_w", "")).cast("long"),
        "n_symbols": F.regexp_count(whole(text), F.lit(_SYMBOLS)).cast("long"),
        "n_dup_lines": n_dup_lines(text),
        "n_repeat_words": n_repeat_words(F.col("_h8")),
    }


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def bucket(value: Column) -> Column:
    return F.pmod(value, F.lit(BUCKETS)).cast("int")


def trusted_ids(labels: DataFrame) -> DataFrame:
    """``doc_id, trusted`` of all documents that have labels and only good ones.

    Up to BROADCAST_IDS of them are broadcast, so that no text is shuffled for its label.
    """
    good = labels.groupBy("doc_id").agg(F.min("quality").alias("quality")).filter("quality = 1 AND doc_id IS NOT NULL")
    good = stage(good.select("doc_id", F.lit(True).alias("trusted")), "trusted-ids")
    return F.broadcast(good) if good.count() <= BROADCAST_IDS else good


@dataclass(frozen=True)
class Ratio:
    """Log ratio by bucket, one row with an array, and the least score that is kept (None: no trusted text)."""

    weights: DataFrame
    threshold: float | None

    def scored(self, df: DataFrame) -> DataFrame:
        """``df`` with ``score``, the mean log ratio of its words and pairs (``_h1, _h2``); 0 without words."""
        with_ratio = df.select("*", self.weights.scalar().alias("_ratio"))

        def total(hashes: str) -> Column:
            return F.aggregate(hashes, F.lit(0.0), lambda s, h: s + F.get(F.col("_ratio"), bucket(h)))

        n = F.greatest(F.size("_h1") + F.size("_h2"), F.lit(1)).cast("double")
        return with_ratio.select(*df.columns, ((total("_h1") + total("_h2")) / n).alias("score"))

    def keeps(self, score: Column) -> Column:
        return F.lit(True) if self.threshold is None else score >= self.threshold


def fit(df: DataFrame, labels: DataFrame) -> Ratio:
    """Count both multinomials on all rows of ``doc_id, text`` and find the threshold."""
    spark = df.sparkSession
    texts = df.select("doc_id", F.col("text").cast("string").alias("text"))
    known = trusted_ids(labels)
    held = F.pmod(F.xxhash64(whole(F.col("text"))), F.lit(HELD_OUT)) == 0
    counted = texts.join(known, "doc_id", "left").select(
        words(F.col("text")).alias("_w"), (F.coalesce("trusted", F.lit(False)) & ~held).alias("good")
    )
    each = with_hashes(counted).select("good", F.explode_outer(F.concat("_h1", "_h2")).alias("value"))
    # Every task sums its own n-grams first, and there is one row per bucket, whatever the size of the corpus.
    sums = each.filter(F.col("value").isNotNull()).groupBy(bucket(F.col("value")).alias("bucket"))
    both = sums.agg(F.count(F.lit(1)).alias("raw"), F.count_if("good").alias("good"))
    every = spark.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    both = stage(every.join(both, "bucket", "left").na.fill(0), "buckets")
    total = both.agg(F.sum("raw").alias("raw"), F.sum("good").alias("good")).first()
    if not total["good"]:
        return Ratio(spark.range(1).select(F.array_repeat(F.lit(0.0), BUCKETS).alias("weights")), None)

    def smooth(name: str) -> Column:
        return F.log((F.col(name) + SMOOTHING) / (total[name] + SMOOTHING * BUCKETS))

    ratio = both.select("bucket", (smooth("good") - smooth("raw")).alias("ratio"))
    row = ratio.agg(F.array_sort(F.collect_list(F.struct("bucket", "ratio"))).alias("pairs"))
    weights = stage(row.select(F.col("pairs")["ratio"].alias("weights")), "weights")
    kept_out = texts.join(known, "doc_id").filter(held).select(words(F.col("text")).alias("_w"))
    return Ratio(weights, _threshold(Ratio(weights, None), with_hashes(kept_out)))


def _threshold(ratio: Ratio, held_out: DataFrame) -> float | None:
    """Margin below the quantile of held-out trusted scores, from the number of rows per score step."""
    score = ratio.scored(held_out.filter(F.size("_h1") >= LEAST_WORDS))
    per_step = score.groupBy(F.floor(F.col("score") * STEPS).alias("step")).agg(F.count(F.lit(1)).alias("n"))
    # The steps are a few thousand at most: the score lies between the logs of the smoothed shares.
    upto = per_step.select(
        "step",
        F.sum("n").over(Window.orderBy("step").rowsBetween(Window.unboundedPreceding, 0)).alias("upto"),
        F.sum("n").over(Window.partitionBy(F.lit(0))).alias("total"),
    )
    row = upto.filter(F.col("upto") > F.col("total") * QUANTILE).agg(F.min("step").alias("step")).first()
    return None if row["step"] is None else row["step"] / STEPS - MARGIN


def judged(df: DataFrame, labels: DataFrame, ratio: Ratio | None = None) -> DataFrame:
    """``df`` as one struct ``_row`` with the base columns, ``base_failed``, ``score`` and ``kept``."""
    ratio = ratio or fit(df, labels)
    text = F.col("_row")["text"]
    rows = df.select(F.struct(*[F.col(f"`{name}`") for name in df.columns]).alias("_row"))
    rows = with_hashes(rows.select("_row", words(text).alias("_w")))
    rows = rows.withColumn("_h8", bind(joined(F.col("_h2"), 2), lambda h4: joined(h4, 4)))
    measured = rows.select("_row", "_h1", "_h2", *[value.alias(name) for name, value in base_columns(text).items()])
    judgement = ratio.scored(measured).withColumn("base_failed", base_failed())
    return judgement.withColumn("kept", ~F.col("base_failed") & ratio.keeps(F.col("score")))


def verdicts(df: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document the counts, the score and the verdict."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"]
    return judged(df.select("doc_id", "text"), labels).select(F.col("_row")["doc_id"].alias("doc_id"), *names)


def keep_documents(df: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``df`` that are kept, with their own columns.

    A plain filter would be pushed down to the texts, and each use of the hashes would be computed once more there;
    the generator holds it back.
    """
    verdict = F.explode_outer(F.array("kept")).alias("_kept")
    return judged(df, labels).select("_row", verdict).filter("_kept").select("_row.*")
