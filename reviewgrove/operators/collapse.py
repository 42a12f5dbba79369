"""One row out of many sparse ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def collapse_first(df: DataFrame) -> DataFrame:
    """One row with the first non-null value of every column, under the column's own name."""
    return df.agg(*[F.first(name, ignorenulls=True).alias(name) for name in df.columns])
