"""Train and test parts, and folds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRAIN = "train"
TEST = "test"


def _hash(key: Column, first: int) -> Column:
    """A number from eight hex digits of the md5 of the key, starting at digit ``first``."""
    digits = F.substring(F.md5(key.cast("string").cast("binary")), first, 8)
    return F.conv(digits, 16, 10).cast("bigint")


def part(key: Column, train_percent: int = 75) -> Column:
    """"train" or "test" from the key alone: the same for every layout, cluster and run."""
    return F.when(F.pmod(_hash(key, 1), F.lit(100)) < train_percent, TRAIN).otherwise(TEST)


def fold(key: Column, n_folds: int) -> Column:
    """Fold number from other digits of the same hash, so that folds do not follow the parts."""
    return F.pmod(_hash(key, 9), F.lit(n_folds)).cast("int")


def random_parts(df: DataFrame, weights: Sequence[float] = (0.75, 0.25), seed: int = 123) -> list[DataFrame]:
    """Spark's own random split. The same seed gives other parts when the rows are laid out otherwise."""
    return df.randomSplit(list(weights), seed=seed)
