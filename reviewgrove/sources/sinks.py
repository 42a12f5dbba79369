"""CSV and console sinks."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewgrove.session import delete_path, file_system

# Blanks at either end of a value are part of it, and quotes inside a value are doubled.
# A missing value is written as nothing, an empty text as a pair of quotes.
_CSV_OPTIONS = {
    "header": True,
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "quote": '"',
    "escape": '"',
}
# What an empty text is read as, so that the reader does not take it for a missing one.
_EMPTY = "\x00"


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**_CSV_OPTIONS, emptyValue='""').csv(path)


def publish_csv(df: DataFrame, path: str, write: Callable[[DataFrame, str], None] = write_csv) -> dict:
    """Replace the report at ``path`` as a whole: written aside, checked, swapped in. Returns its manifest.

    Until the new report is complete the old one stays as it is, and a run that fails leaves it there. The manifest,
    ``_manifest.json`` in the folder, names the columns and the number of rows. ``recover`` finishes or undoes a swap
    that was cut off. A rename is one step on a file system; on an object store it copies, which suits small reports.
    """
    spark = df.sparkSession
    recover(spark, path)
    aside, old = f"{path.rstrip('/')}._next", f"{path.rstrip('/')}._old"
    delete_path(spark, aside)
    try:
        write(df, aside)
        n_rows = read_csv(spark, aside, df.schema).count()
        manifest = {"columns": df.columns, "rows": n_rows}
        system, place = file_system(spark, f"{aside}/_manifest.json")
        out = system.create(place, True)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
    except BaseException:
        delete_path(spark, aside)
        raise
    _move(spark, path, old)
    _move(spark, aside, path)
    delete_path(spark, old)
    return manifest


def recover(spark: SparkSession, path: str) -> None:
    """Bring ``path`` back to one whole report after a swap that was cut off: the new one if it is complete, else the old one."""
    aside, old = f"{path.rstrip('/')}._next", f"{path.rstrip('/')}._old"
    system, place = file_system(spark, path)
    if not system.exists(place):
        complete = system.exists(file_system(spark, f"{aside}/_manifest.json")[1])
        _move(spark, aside if complete else old, path)
    delete_path(spark, old)


def _move(spark: SparkSession, source: str, target: str) -> None:
    system, place = file_system(spark, source)
    if system.exists(place) and not system.rename(place, file_system(spark, target)[1]):
        raise OSError(f"{source} could not be moved to {target}")


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    df = spark.read.schema(schema).options(**_CSV_OPTIONS, emptyValue=_EMPTY).csv(path)
    texts = [field.name for field in schema.fields if isinstance(field.dataType, T.StringType)]
    return df.withColumns({name: F.when(F.col(name) == _EMPTY, "").otherwise(F.col(name)) for name in texts})


def show(df: DataFrame, rows: int = 20) -> None:
    df.show(rows, truncate=False)
