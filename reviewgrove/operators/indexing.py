"""Label and feature indexes as plain tables."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import VectorIndexer, VectorIndexerModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reviewgrove.operators.terms import BROADCAST_LIMIT
from reviewgrove.session import stage

MAX_CATEGORIES = 4
# Room for the code and the row header next to the label itself.
_BYTES_PER_ROW = 64


def label_index(df: DataFrame, label: str = "label") -> DataFrame:
    """``label, idx``: codes by falling frequency, equal ones by the label as text.

    The window runs in one task over one row per distinct label, which suits ratings and other short lists. The result is a table to
    stage when it is used more than once.
    """
    order = Window.orderBy(F.desc("n"), F.col(label).cast("string"))
    return (
        df.filter(F.col(label).isNotNull())
        .groupBy(label)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(label, (F.row_number().over(order) - 1).cast("double").alias("idx"))
    )


def label_unindex(df: DataFrame, index: DataFrame, code: str, name: str, label: str = "label") -> DataFrame:
    """Add the label for a code as text column ``name``, out of the table of ``label_index``."""
    codes = index.select(F.col("idx").alias(code), F.col(label).cast("string").alias(name))
    codes = stage(codes, "codes")
    size = codes.agg(F.coalesce(F.sum(F.octet_length(name) + _BYTES_PER_ROW), F.lit(0))).first()[0]
    small = size <= BROADCAST_LIMIT
    return df.join(F.broadcast(codes) if small else codes, code, "left")


def feature_categories(cells: DataFrame, n_docs: int | Column, max_categories: int = MAX_CATEGORIES) -> DataFrame:
    """``term, n_values, is_categorical``: a feature with few distinct values is categorical.

    The zero of the texts without the term counts as a value. A term of every text has weight zero
    everywhere and so a single value. Distinct counts are reduced to (term, tf) pairs before the
    shuffle, so a very common term stays small.
    """
    n_docs = F.lit(n_docs) if isinstance(n_docs, int) else n_docs
    counts = cells.groupBy("term").agg(
        F.count(F.lit(1)).alias("df"),
        F.count_distinct("tf").alias("n_tf"),
    )
    n_values = F.when(F.col("df") == n_docs, F.lit(1).cast("bigint")).otherwise(F.col("n_tf") + 1)
    return counts.select("term", n_values.alias("n_values"), (n_values <= max_categories).alias("is_categorical"))


def value_mapping(cells: DataFrame, n_docs: int | Column, max_categories: int = MAX_CATEGORIES) -> DataFrame:
    """``term, tf, code, n_values`` of every categorical feature, from the long counts of the texts it is learnt from.

    Values are coded in rising order, and the zero of the texts without the term has the first code. A term of every text
    has weight zero everywhere, so all its counts have the code of zero. There is one row per term and code, at most
    ``max_categories`` of them, so no list of values is ever gathered.
    """
    categorical = feature_categories(cells, n_docs, max_categories).filter("is_categorical").select("term", "n_values")
    values = cells.select("term", "tf").distinct().join(categorical, "term")
    is_constant = F.col("n_values") == 1
    code = F.when(is_constant, 0).otherwise(F.row_number().over(Window.partitionBy("term").orderBy("tf")))
    nonzero = values.select("term", "tf", code.cast("int").alias("code"), "n_values")
    zero = categorical.select("term", F.lit(0).alias("tf"), F.lit(0).alias("code"), "n_values")
    return nonzero.unionByName(zero)


def indexed_values(weights: DataFrame, mapping: DataFrame, columns: Sequence[str] = ("doc_id", "term")) -> DataFrame:
    """``columns, value`` out of long weights (``term, tf, tfidf``): the code where the feature is categorical, else the weight.

    A value that the mapping has not seen gets the code behind the last one. Cells that are not there are zeros and stay zeros.
    """
    known = mapping.groupBy("term").agg(F.max("n_values").alias("n_values"))
    codes = mapping.filter("tf > 0").select("term", "tf", "code")
    joined = weights.join(known, "term", "left").join(codes, ["term", "tf"], "left")
    unseen = F.when(F.col("n_values") == 1, 0).otherwise(F.col("n_values"))
    value = F.when(F.col("n_values").isNull(), F.col("tfidf")).otherwise(F.coalesce("code", unseen).cast("double"))
    return joined.select(*columns, value.alias("value"))


def vector_values(df: DataFrame, column: str, max_categories: int = MAX_CATEGORIES) -> DataFrame:
    """At most ``max_categories + 1`` vectors with the values that all vectors of ``df`` have in each feature.

    Of a feature with more values than that, as many are there as tell that it is not categorical. Spark's indexer looks at
    nothing but the values of a feature, so it learns from these vectors what it learns from all, and does not go through
    every feature of every row. The values come from one aggregate over the cells that are there. No more than the values of
    a fitted model reach the driver.
    """
    spark = df.sparkSession
    vector = F.unwrap_udt(column)
    parts = df.select(vector.getField("size").alias("size"), vector.getField("indices").alias("i"), vector.getField("values").alias("v"))
    n_rows = df.count()
    if n_rows == 0:
        raise ValueError("there are no vectors to learn an index from")
    size = parts.select(F.coalesce("size", F.size("v"))).first()[0]
    dense = F.when(F.size("v") > 0, F.sequence(F.lit(0), F.size("v") - 1))
    cells = parts.select(F.inline(F.arrays_zip(F.coalesce("i", dense).alias("i"), F.col("v").alias("v"))))
    each = cells.groupBy("i", "v").agg(F.count(F.lit(1)).alias("n"))
    # A feature with fewer cells than there are rows is zero in the others.
    zero = each.groupBy("i").agg(F.sum("n").alias("n")).filter(F.col("n") < n_rows).select("i", F.lit(0.0).alias("v"))
    values = each.select("i", "v").unionByName(zero).distinct()
    place = F.row_number().over(Window.partitionBy("i").orderBy("v")) - 1
    first = values.withColumn("k", place).filter(F.col("k") <= max_categories)
    table = first.orderBy("k", "i").toArrow()
    k, index, value = (table.column(name).to_numpy() for name in ("k", "i", "v"))
    # A feature with fewer values has its first one in the vectors that are left.
    whole = np.zeros(size)
    whole[index[k == 0]] = value[k == 0]
    rows = []
    for at in range(max_categories + 1):
        filled = whole.copy()
        filled[index[k == at]] = value[k == at]
        rows.append((Vectors.dense(filled),))
    return spark.createDataFrame(rows, [column])


def fit_indexer(
    df: DataFrame, column: str, output: str, max_categories: int = MAX_CATEGORIES, invalid: str = "error"
) -> VectorIndexerModel:
    """Spark's ``VectorIndexer``, fitted on ``vector_values``."""
    indexer = VectorIndexer(inputCol=column, outputCol=output, maxCategories=max_categories, handleInvalid=invalid)
    return indexer.fit(vector_values(df, column, max_categories))
