"""Choice of terms by how strongly they depend on the label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Statistics are compared up to so many digits, since sums over partitions may differ in the last bits.
DIGITS = 9


def label_counts(rows: DataFrame, label: str = "label") -> DataFrame:
    """``label, n_label``: one row per label, from one row per text."""
    return rows.groupBy(label).agg(F.count(F.lit(1)).alias("n_label"))


def term_chi_square(cells: DataFrame, labels: DataFrame, label: str = "label") -> DataFrame:
    """``term, df, chi_square``: Pearson's statistic of "the text has the term" against the label.

    ``cells`` are long term counts with the label, one row per text and term; ``labels`` are the ``label_counts`` of all texts, which
    is as short as the list of labels. With N texts, N_l of label l and O_l of these with the term, the sum over the
    table of two rows is N^2 / (df (N - df)) * (sum of O_l^2 / N_l - df^2 / N). So labels that a term never meets
    need no rows, and the only shuffle is on counts per term and label that every task has summed up. A term of every text has 0.
    """
    per_label = cells.groupBy("term", label).agg(F.count(F.lit(1)).alias("o"))
    known = labels.filter(F.col(label).isNotNull())
    sizes = known.agg(F.map_from_entries(F.collect_list(F.struct(label, "n_label")))).scalar()
    n = known.agg(F.sum("n_label")).scalar()
    each = per_label.select("term", "o", (F.col("o") * F.col("o") / F.try_element_at(sizes, F.col(label))).alias("part"))
    sums = each.groupBy("term").agg(F.sum("o").alias("df"), F.sum("part").alias("parts")).withColumn("n", n)
    n, df = F.col("n").cast("double"), F.col("df").cast("double")
    value = n * n / (df * (n - df)) * (F.col("parts") - df * df / n)
    return sums.select("term", "df", F.round(F.when(F.col("df") < F.col("n"), value).otherwise(0.0), DIGITS).alias("chi_square"))


def term_impurity(cells: DataFrame, labels: DataFrame, label: str = "label") -> DataFrame:
    """``term, df, impurity``: the Gini impurity of the labels, summed over all texts, after a split by "the text has the term".

    ``cells`` and ``labels`` are those of ``term_chi_square``. With the same signs, N - (sum of O_l^2) / df - (sum of (N_l - O_l)^2) / (N - df),
    and labels that a term never meets need no rows. Terms of every text split nothing and are left out.
    """
    per_label = cells.groupBy("term", label).agg(F.count(F.lit(1)).alias("o"))
    known = labels.filter(F.col(label).isNotNull())
    sizes = known.agg(F.map_from_entries(F.collect_list(F.struct(label, "n_label")))).scalar()
    n = known.agg(F.sum("n_label")).scalar()
    squares = known.agg(F.sum(F.col("n_label") * F.col("n_label"))).scalar()
    own = per_label.select("term", "o", (F.col("o") * F.col("o")).alias("square"), (F.try_element_at(sizes, F.col(label)) * F.col("o")).alias("both"))
    sums = own.groupBy("term").agg(F.sum("o").alias("df"), F.sum("square").alias("square"), F.sum("both").alias("both"))
    sums = sums.withColumns({"n": n, "squares": squares}).filter("df < n")
    without = (F.col("squares") - 2 * F.col("both") + F.col("square")) / (F.col("n") - F.col("df"))
    return sums.select("term", "df", (F.col("n") - F.col("square") / F.col("df") - without).alias("impurity"))


def best_terms(statistics: DataFrame, size: int) -> DataFrame:
    """The ``size`` rows of ``term_chi_square`` with the largest statistic; equal ones in the order of the term.

    ``size`` is a bound on what a forest can hold, so the sort keeps no more than that per task.
    """
    return statistics.orderBy(F.desc("chi_square"), "term").limit(size)
