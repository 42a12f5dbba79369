"""Python records as a typed DataFrame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def record_schema(records: Sequence[Mapping[str, Any]]) -> T.StructType:
    """One nullable field per key, in the order of first appearance."""
    found: dict[str, set[type]] = {}
    for record in records:
        for name, value in record.items():
            kinds = found.setdefault(name, set())
            if value is not None:
                kinds.add(type(value))
    return T.StructType([T.StructField(name, _field_type(name, kinds)) for name, kinds in found.items()])


def _field_type(name: str, kinds: set[type]) -> T.DataType:
    if kinds <= {str}:
        return T.StringType()
    if kinds == {bool}:
        return T.BooleanType()
    if kinds == {int}:
        return T.LongType()
    if kinds <= {int, float}:
        return T.DoubleType()
    raise TypeError(f"values of {name!r} have no common type: {sorted(k.__name__ for k in kinds)}")


def records_to_frame(
    spark: SparkSession,
    records: Sequence[Mapping[str, Any]],
    schema: T.StructType | None = None,
) -> DataFrame:
    """One row per record, null where a record lacks the key. Booleans and numbers keep their type.

    Meant for small driver-side records such as hyper-parameters, not for data.
    """
    schema = schema or record_schema(records)
    as_double = {f.name for f in schema.fields if isinstance(f.dataType, T.DoubleType)}
    rows = [
        tuple(
            float(r[n]) if n in as_double and r.get(n) is not None else r.get(n)
            for n in schema.names
        )
        for r in records
    ]
    return spark.createDataFrame(rows, schema)
