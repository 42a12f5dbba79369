"""Best hyper-parameters as one typed row."""

from __future__ import annotations

from typing import Any

from pyspark.ml.tuning import CrossValidatorModel
from pyspark.sql import DataFrame, SparkSession

from reviewgrove.operators.collapse import collapse_first
from reviewgrove.sources.records import records_to_frame


def _named(params: dict) -> dict[str, Any]:
    return {param.name: value for param, value in params.items()}


def best_point(search: CrossValidatorModel) -> int:
    """Position of the highest mean accuracy; the first one of equals."""
    return max(range(len(search.avgMetrics)), key=lambda i: (search.avgMetrics[i], -i))


def best_params(search: CrossValidatorModel) -> dict[str, Any]:
    return _named(search.getEstimatorParamMaps()[best_point(search)])


def report(spark: SparkSession, search: CrossValidatorModel) -> DataFrame:
    """One row, one typed column per tuned parameter."""
    records = [{name: value} for name, value in best_params(search).items()]
    return collapse_first(records_to_frame(spark, records))


def grid_scores(spark: SparkSession, search: CrossValidatorModel) -> DataFrame:
    """One row per grid point: its position, its parameters and its mean accuracy."""
    rows = [
        {"point": i, **_named(params), "accuracy": float(score)}
        for i, (params, score) in enumerate(zip(search.getEstimatorParamMaps(), search.avgMetrics))
    ]
    return records_to_frame(spark, rows)
