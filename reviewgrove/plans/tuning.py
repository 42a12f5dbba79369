"""Random forest under a cross-validated grid search."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import IndexToString, StringIndexer
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewgrove.operators.indexing import fit_indexer
from reviewgrove.operators.scores import accuracy_evaluator
from reviewgrove.plans.features import LABEL, TFIDF
from reviewgrove.plans.search import FITTED, Ledger, LedgerValidator

PREDICTION = "prediction"
PREDICTED_LABEL = "predictedLabel"
INDEXED_LABEL = "indexedLabel"
INDEXED_FEATURES = "indexedFeatures"


@dataclass(frozen=True)
class Grid:
    """Values per forest parameter, and the number of folds they are tried on."""

    values: Mapping[str, Sequence[Any]]
    folds: int


# The grids in use. "as_written" cannot learn: an information gain of 10 or more does not
# exist, so every tree is a single leaf that names the most frequent label. "default" is the same grid
# with reachable gains.
GRIDS = {
    "default": Grid(
        {
            "bootstrap": [True],
            "maxDepth": [5, 15],
            "maxBins": [2, 6],
            "numTrees": [50, 100],
            "impurity": ["gini", "entropy"],
            "featureSubsetStrategy": ["auto"],
            "minInstancesPerNode": [10, 25],
            "minInfoGain": [0.0, 0.01],
        },
        folds=3,
    ),
    "as_written": Grid(
        {
            "bootstrap": [True],
            "maxDepth": [5, 15],
            "maxBins": [2, 6],
            "numTrees": [50, 100],
            "impurity": ["gini", "entropy"],
            "featureSubsetStrategy": ["auto"],
            "minInstancesPerNode": [10, 25],
            "minInfoGain": [10, 25],
        },
        folds=3,
    ),
    "indexed": Grid(
        {
            "maxDepth": [10, 20],
            "maxBins": [5, 10],
            "numTrees": [50, 100, 200],
            "impurity": ["gini", "entropy"],
        },
        folds=5,
    ),
    "exploratory": Grid(
        {
            "maxDepth": [10, 20, 30],
            "maxBins": [5, 10, 25],
            "numTrees": [50, 100, 200],
            "impurity": ["gini", "entropy"],
        },
        folds=5,
    ),
}


class MarkedForest(RandomForestClassifier):
    """A forest that is fitted on the rows marked in ``fitted``, if there is such a column, so that a search can score all rows of a fold."""

    def _fit(self, dataset: DataFrame) -> RandomForestClassificationModel:
        return super()._fit(dataset.filter(FITTED) if FITTED in dataset.columns else dataset)


def forest(label: str = LABEL, features: str = TFIDF, seed: int = 123, **params: Any) -> RandomForestClassifier:
    return MarkedForest(labelCol=label, featuresCol=features, seed=seed, **params)


def param_maps(estimator: RandomForestClassifier, values: Mapping[str, Sequence[Any]]) -> list[dict]:
    """All points of a grid, in the order in which equal scores are decided."""
    builder = ParamGridBuilder()
    for name, choices in values.items():
        builder.addGrid(estimator.getParam(name), list(choices))
    return builder.build()


def check_labels(df: DataFrame, label: str = LABEL) -> None:
    """Reject an input without rows or with missing labels before any training starts."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.count(label).alias("labelled")).first()
    if row["n"] == 0:
        raise ValueError("there are no rows to train on")
    if row["labelled"] < row["n"]:
        raise ValueError(f"{row['n'] - row['labelled']} of {row['n']} rows have no {label}")


def cross_validator(
    estimator: RandomForestClassifier,
    grid: Grid,
    fold_col: str | None = None,
    parallelism: int = 4,
    seed: int = 123,
    ledger: Ledger | None = None,
) -> CrossValidator:
    """Grid search by accuracy. With ``fold_col`` the folds come from the data and not from a random draw.

    ``parallelism`` models are trained at a time, so the short jobs of one forest do not leave the
    cluster idle. With a ``ledger`` finished models are kept there, and a second start fits only the others.
    """
    search = CrossValidator if ledger is None else LedgerValidator
    validator = search(
        estimator=estimator,
        estimatorParamMaps=param_maps(estimator, grid.values),
        evaluator=accuracy_evaluator(estimator.getLabelCol(), PREDICTION),
        numFolds=grid.folds,
        foldCol=fold_col or "",
        parallelism=parallelism,
        seed=seed,
    )
    if ledger is not None:
        validator.ledger = ledger
    return validator


def plain_stages(
    grid: Grid, fold_col: str | None = None, parallelism: int = 4, seed: int = 123, ledger: Ledger | None = None
) -> Pipeline:
    """Forest on the features and labels as they are."""
    return Pipeline(stages=[cross_validator(forest(seed=seed), grid, fold_col, parallelism, seed, ledger)])


def indexed_stages(
    train: DataFrame,
    grid: Grid,
    fold_col: str | None = None,
    parallelism: int = 4,
    seed: int = 123,
    ledger: Ledger | None = None,
) -> Pipeline:
    """Forest on indexed labels and features, with the prediction turned back into a label.

    The indexes are learnt from the training rows; labels and values that only the test rows have get
    a code of their own.
    """
    labels = StringIndexer(inputCol=LABEL, outputCol=INDEXED_LABEL, handleInvalid="keep").fit(train)
    features = fit_indexer(train, TFIDF, INDEXED_FEATURES, invalid="keep")
    search = cross_validator(forest(INDEXED_LABEL, INDEXED_FEATURES, seed), grid, fold_col, parallelism, seed, ledger)
    names = IndexToString(inputCol=PREDICTION, outputCol=PREDICTED_LABEL, labels=labels.labels)
    return Pipeline(stages=[labels, features, search, names])


def search_of(model: PipelineModel) -> CrossValidatorModel:
    """The grid search inside a fitted pipeline."""
    return next(stage for stage in model.stages if isinstance(stage, CrossValidatorModel))
