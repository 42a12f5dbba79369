"""Accuracy of predictions."""

from __future__ import annotations

from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def accuracy_evaluator(label: str = "label", prediction: str = "prediction") -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(labelCol=label, predictionCol=prediction, metricName="accuracy")


def accuracy(predictions: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row ``n_test, accuracy, test_error``; a single pass with partial sums."""
    hit = (F.col(prediction) == F.col(label)).cast("double")
    return predictions.agg(F.count(F.lit(1)).alias("n_test"), F.avg(hit).alias("accuracy")).withColumn(
        "test_error", 1.0 - F.col("accuracy")
    )
