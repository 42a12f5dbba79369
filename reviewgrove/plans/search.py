"""Grid search that keeps what it has finished: a ledger of scores and fold models, and predictions of rows no model has seen."""

from __future__ import annotations

import hashlib
import json
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewgrove.session import held

# Marks the rows a forest is fitted on, where not all are.
FITTED = "fitted"
_SCORES = "run string, point int, fold int, score double"


class Ledger:
    """Finished (point, fold) pairs of searches, in a folder that outlives the session.

    A model is written before the row that names it, so every row has its model. Every row has a folder of its own, since
    models that end at the same time must not share one to write to. Rows of other data, other parameters or another seed
    have another ``run`` and are not taken.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        # An empty first part, so that the table can always be read.
        spark.createDataFrame([], _SCORES).write.mode("overwrite").parquet(f"{self._table}/none")

    @property
    def _table(self) -> str:
        return f"{self.path}/scores"

    def rows(self) -> DataFrame:
        return self.spark.read.schema(_SCORES).option("recursiveFileLookup", True).parquet(self._table)

    def finished(self, run: str) -> dict[tuple[int, int], float]:
        """Scores by (point, fold); at most one row per model of the grid."""
        rows = self.rows().filter(F.col("run") == run).groupBy("point", "fold").agg(F.max("score").alias("score"))
        return {(row["point"], row["fold"]): row["score"] for row in rows.collect()}

    def model_path(self, run: str, point: int, fold: int) -> str:
        return f"{self.path}/models/{run}/{point}-{fold}"

    def model(self, run: str, point: int, fold: int) -> RandomForestClassificationModel:
        return RandomForestClassificationModel.load(self.model_path(run, point, fold))

    def record(self, run: str, point: int, fold: int, score: float, model: RandomForestClassificationModel) -> None:
        model.write().overwrite().save(self.model_path(run, point, fold))
        row = self.spark.createDataFrame([(run, point, fold, float(score))], _SCORES).coalesce(1)
        row.write.mode("overwrite").parquet(f"{self._table}/{run}-{point}-{fold}")


class LedgerValidator(CrossValidator):
    """Cross-validation over given folds that writes every finished model to a ledger and skips those it finds there.

    Folds come from ``foldCol``, so that a second start tries the same rows. The model it gives is that of CrossValidator,
    with ``run``, the name of the search in the ledger.
    """

    ledger: Ledger

    def fit_one(self, train: DataFrame, point: dict) -> RandomForestClassificationModel:
        return self.getEstimator().fit(train, point)

    def _fit(self, dataset: DataFrame) -> CrossValidatorModel:
        points, column = self.getEstimatorParamMaps(), self.getFoldCol()
        if not column:
            raise ValueError("a search with a ledger needs a column of folds")
        run = run_key(dataset, self.getEstimator(), points, column, self.getNumFolds())
        done = self.ledger.finished(run)
        todo = [(p, f) for f in range(self.getNumFolds()) for p in range(len(points)) if (p, f) not in done]

        @inheritable_thread_target(self.ledger.spark)
        def work(pair: tuple[int, int]) -> tuple[tuple[int, int], float]:
            point, fold = pair
            model = self.fit_one(dataset.filter(F.col(column) != fold), points[point])
            score = self.getEvaluator().evaluate(model.transform(dataset.filter(F.col(column) == fold)))
            self.ledger.record(run, point, fold, score, model)
            return pair, score

        with held(dataset) as dataset, ThreadPool(max(1, min(self.getParallelism(), len(todo)))) as pool:
            done.update(pool.imap_unordered(work, todo))
            means = [sum(done[p, f] for f in range(self.getNumFolds())) / self.getNumFolds() for p in range(len(points))]
            best = max(range(len(points)), key=lambda p: (means[p], -p))
            model = self.fit_one(dataset, points[best])
        found = self._copyValues(CrossValidatorModel(bestModel=model, avgMetrics=means))
        found.run = run
        return found


def run_key(dataset: DataFrame, estimator: RandomForestClassifier, points: list[dict], column: str, folds: int) -> str:
    """Tells searches apart: the labels, features, folds and marks of the rows, all points and the parameters of the forest.

    One pass over the training rows; the checksum does not depend on their order.
    """
    names = [column, estimator.getLabelCol(), estimator.getFeaturesCol()]
    names += [name for name in (FITTED,) if name in dataset.columns]
    mark = dataset.select(F.xxhash64(*[F.col(n).cast("string") if n == names[2] else F.col(n) for n in names]).alias("h"))
    rows = mark.agg(F.count(F.lit(1)), F.bit_xor("h"), F.sum(F.pmod("h", F.lit(1 << 31)))).first()
    own = {param.name: value for param, value in estimator.extractParamMap().items()}
    asked = [{param.name: value for param, value in point.items()} for point in points]
    text = json.dumps([list(rows), own, asked, folds], sort_keys=True, default=str)
    return hashlib.sha256(text.encode()).hexdigest()[:24]


def out_of_fold(train: DataFrame, ledger: Ledger, run: str, points: list[int], folds: int, column: str = "fold") -> DataFrame:
    """``train`` with ``point`` and ``prediction``: every row scored by the fold model that has not seen it, for every point."""
    parts = [
        ledger.model(run, point, fold).transform(train.filter(F.col(column) == fold)).withColumn("point", F.lit(point))
        for point in points
        for fold in range(folds)
    ]
    return reduce(DataFrame.unionByName, parts).select(*train.columns, "point", "prediction")


def fold_shares(scored: DataFrame, label: str, column: str = "fold") -> DataFrame:
    """``point, fold, n_rows, share``: hits of the out-of-fold predictions, summed up per task before the shuffle."""
    hit = (F.col("prediction") == F.col(label)).cast("double")
    return scored.groupBy("point", F.col(column).alias("fold")).agg(F.count(F.lit(1)).alias("n_rows"), F.avg(hit).alias("share"))
