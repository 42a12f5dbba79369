"""Mix sources to target weights: random keys, sorted ranges, distributed prefix sums, a cut at each source's budget.

1. The size of a document is its number of words. Sources are numbered by code point, null last, and weigh WEIGHTS, repeating.
2. All words of the corpus are dealt out by weight. No source gets more than MOST times its own words; what is above goes to
   the others by weight, until none is above. In the order of ``limit / weight`` the sources that stop at their limit
   come first, so prefix sums over that order find them without rounds.
3. Every document gets a random key from its number. Keys are range-sorted within each source; the words ahead of a
   document are the words of the ranges ahead plus those ahead of it in its own range.
4. A source's budget is its target, rounded down. Whole passes over the source are taken first, then the documents in key
   order, the one at the cut in part, so a source gives exactly its budget.

All steps are DataFrame functions. A source is spread over as many ranges as its rows need; only one row per source and range is
summed up over ranges.

Defined cases: a null text has size 0; a null source is a source of its own; a source without words has target 0; rows without a
number get their key from the text alone; equal rows are taken one by one, in any order, which is the same result; no
words at all give only zeros; an empty table gives an empty result. Very long texts count whole. Columns other than the number,
the text and the source are not looked at; ``mixed_texts`` carries them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reviewgrove.session import stage

WEIGHTS = (1, 2, 3)
MOST = 3
SEED = "mix"
_WORD = r"[^\x20\x09-\x0D]+"
_BLANK = r"[\x20\x09-\x0D]+"
_KEY_DIGITS = 16
SOURCE = ["no_source", "source"]


def size_of(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(_WORD)).cast("long")


def random_keys(seed: str = SEED) -> list[Column]:
    """Two columns that order documents at random, and the same in every run."""
    number = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(seed))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return [F.substring(F.md5(value), 1, _KEY_DIGITS).alias(name) for name, value in (("key", number), ("text_key", text))]


def ranges(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``df`` sorted over all tasks, written with the number ``part`` of each sorted range."""
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return stage(dealt.withColumn("part", F.spark_partition_id()), name)


def with_sums_ahead(df: DataFrame, group: Sequence[str], order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """``df``, as written by ``ranges``, with ``ahead_<value>``: the sum over the rows of the group that come before."""
    place = [*group, "part"]
    per_range = df.groupBy(*place).agg(*[F.sum(v).alias(v) for v in values])
    before = Window.partitionBy(*(group or [F.lit(0)])).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = per_range.select(*place, *[F.coalesce(F.sum(v).over(before), F.lit(0)).alias(f"base_{v}") for v in values])
    inside = Window.partitionBy(*place).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    own = df.select("*", *[F.coalesce(F.sum(v).over(inside), F.lit(0)).alias(f"own_{v}") for v in values])
    total = [(F.col(f"base_{v}") + F.col(f"own_{v}")).alias(f"ahead_{v}") for v in values]
    return own.join(base, place).select(*df.columns, *total)


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``no_source, source, source_size, target`` from ``no_source, source, size`` per document."""
    per_source = sizes.groupBy(*SOURCE).agg(F.sum("size").alias("source_size")).withColumn("one", F.lit(1))
    numbered = with_sums_ahead(ranges(per_source, SOURCE, "sources"), [], SOURCE, ["one"])
    choice = F.get(F.array(*[F.lit(w) for w in weights]), F.pmod(F.col("ahead_one"), F.lit(len(weights))).cast("int"))
    limited = numbered.select(*SOURCE, "source_size", choice.cast("long").alias("weight"), (most * F.col("source_size")).alias("limit"))
    # A whole number in the order of limit / weight.
    common = reduce(lambda a, b: a * b, set(weights), 1)
    steep = limited.withColumn("steepness", (F.col("limit").cast("decimal(30,0)") * common / F.col("weight")).cast("decimal(38,0)"))
    order = ["steepness", *SOURCE]
    ahead = stage(with_sums_ahead(ranges(steep, order, "sources"), [], order, ["limit", "weight"]), "limits")
    total = ahead.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("words"), F.coalesce(F.sum("weight"), F.lit(0)).alias("weight")).first()

    def exact(value: Column) -> Column:
        return value.cast("decimal(19,0)")

    left = F.lit(total["words"]) - F.col("ahead_limit")
    at_limit = exact(F.col("limit")) * exact(F.lit(total["weight"]) - F.col("ahead_weight")) <= exact(F.col("weight")) * exact(left)
    marked = ahead.select(*SOURCE, "source_size", "weight", "limit", at_limit.alias("at_limit"))
    fixed = marked.filter("at_limit").agg(F.coalesce(F.sum("limit"), F.lit(0)).alias("limit"), F.coalesce(F.sum("weight"), F.lit(0)).alias("weight")).first()
    rest, weight = total["words"] - fixed["limit"], max(total["weight"] - fixed["weight"], 1)
    share = (F.col("weight") * F.lit(rest)).cast("double") / F.lit(weight).cast("double")
    target = F.when(F.col("at_limit"), F.col("limit").cast("double")).otherwise(share)
    return marked.select(*SOURCE, "source_size", target.alias("target"))


def mix(
    df: DataFrame, carry: Sequence[str] = (), weights: Sequence[int] = WEIGHTS, most: int = MOST, seed: str = SEED
) -> DataFrame:
    """``size, source_size, target, taken`` per document of ``doc_id, text, source``, next to the columns ``carry``.

    Carried columns go through the sort with their row, so no join has to find them again.
    """
    source = F.col("source").cast("string")
    rows = df.select(
        F.struct(*[F.col(f"`{name}`") for name in carry]).alias("row") if carry else F.lit(0).alias("row"),
        source.isNull().alias("no_source"), F.coalesce(source, F.lit("")).alias("source"),
        size_of(F.col("text")).alias("size"), *random_keys(seed),
    )
    order = ["key", "text_key"]
    sorted_rows = ranges(rows, [*SOURCE, *order], "sorted")
    aims = stage(targets(sorted_rows.select(*SOURCE, "size"), weights, most), "targets")
    placed = with_sums_ahead(sorted_rows, SOURCE, order, ["size"]).join(aims, SOURCE)
    budget = F.expr("CAST(floor(target) AS BIGINT)")
    passes = F.when(F.col("source_size") > 0, F.expr("CAST(floor(target) AS BIGINT) DIV source_size")).otherwise(F.lit(0))
    rest = budget - passes * F.col("source_size") - F.col("ahead_size")
    taken = passes * F.col("size") + F.least(F.col("size"), F.greatest(rest, F.lit(0)))
    return placed.select(
        *[F.col("row").getField(name).alias(name) for name in carry], "size", "source_size", "target",
        taken.cast("long").alias("taken"),
    )


def mixed_texts(df: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST, seed: str = SEED) -> DataFrame:
    """The mix itself: the rows of ``df`` once per time they are taken, with ``epoch`` from 1 and ``n_taken`` words.

    A copy that is cut holds its first words, one space apart; all others hold the text as it is. Columns of ``df`` with
    one of the two names are replaced.
    """
    names = [name for name in df.columns if name not in ("epoch", "n_taken")]
    packed = df.select("doc_id", "text", "source", F.struct(*[F.col(f"`{name}`") for name in names]).alias("whole"))
    plan = mix(packed, ["whole"], weights, most, seed).filter("taken > 0")
    each = plan.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.ceil(F.col("taken") / F.col("size")).cast("int"))))
    part = F.least(F.col("size"), F.col("taken") - (F.col("epoch") - 1) * F.col("size")).cast("long")
    whole = F.col("whole").getField("text")
    words = F.slice(F.array_remove(F.split(whole, _BLANK), ""), F.lit(1), part.cast("int"))
    text = F.when(part == F.col("size"), whole).otherwise(F.array_join(words, " "))
    kept = [text.alias(name) if name == "text" else F.col("whole").getField(name).alias(name) for name in names]
    return each.select(*kept, "epoch", part.alias("n_taken"))


def mixture(df: DataFrame) -> DataFrame:
    """Per document its size, its source's size and target, and the words taken from it."""
    return mix(df, ["doc_id"])


SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    substr(md5(coalesce(doc_id::VARCHAR, '') || ':mix'), 1, 16) AS key, substr(md5(coalesce(text, '')), 1, 16) AS text_key
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT source, source_size, 3 * source_size AS cap,
    1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
  FROM s
), a AS (
  SELECT *, coalesce(sum(cap) OVER before, 0)::HUGEINT AS cap_ahead, coalesce(sum(weight) OVER before, 0)::HUGEINT AS weight_ahead,
    (SELECT sum(source_size) FROM s)::HUGEINT AS total, (SELECT sum(weight) FROM w)::HUGEINT AS weights
  FROM w
  WINDOW before AS (ORDER BY cap * 6 // weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), m AS (
  SELECT *, cap::HUGEINT * (weights - weight_ahead) <= weight * (total - cap_ahead) AS at_cap FROM a
), f AS (
  SELECT coalesce(sum(cap) FILTER (at_cap), 0)::HUGEINT AS cap, coalesce(sum(weight) FILTER (at_cap), 0)::HUGEINT AS weight FROM m
), t AS (
  SELECT m.source, m.source_size,
    CASE WHEN at_cap THEN m.cap::DOUBLE
      ELSE (m.weight * (total - f.cap))::DOUBLE / greatest(weights - f.weight, 1)::DOUBLE END AS target
  FROM m, f
), p AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, text_key
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS ahead
  FROM d
), j AS (
  SELECT p.doc_id, p.size, t.source_size, t.target, p.ahead, floor(t.target)::BIGINT AS budget,
    CASE WHEN t.source_size > 0 THEN floor(t.target)::BIGINT // t.source_size ELSE 0 END AS passes
  FROM p JOIN t ON p.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  (passes * size + least(size, greatest(budget - passes * source_size - ahead, 0)))::BIGINT AS taken
FROM j
"""
