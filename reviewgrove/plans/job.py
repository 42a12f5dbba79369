"""The whole job: read, clean, weigh, tune, score, report."""

from __future__ import annotations

from dataclasses import dataclass, replace

import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorSlicer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewgrove.operators.choice import best_terms, label_counts, term_chi_square
from reviewgrove.operators.scores import accuracy
from reviewgrove.operators.split import TEST, TRAIN, fold, part
from reviewgrove.operators.terms import MIN_DF, VOCAB_SIZE, term_counts
from reviewgrove.operators.vectors import TfIdf, vocabulary_of
from reviewgrove.plans import tuning
from reviewgrove.plans.features import ID, LABEL, TFIDF, WORDS_STEMMED, review_words, weight_stage
from reviewgrove.plans.report import grid_scores, report
from reviewgrove.plans.search import FITTED, Ledger
from reviewgrove.session import Staged, held, owning, stage
from reviewgrove.sources.reviews import read_reviews, read_reviews_checked, spread
from reviewgrove.sources.sinks import publish_csv, show

FOLD = "fold"
PART = "part"
# Spark holds a row of the forest as one integer per feature, in memory and then on disk. Models are trained at the same
# time only as far as their rows take this together; one model may take more.
MODELS_BYTES = 8 << 30
_PARTS = 1 << 30


def bound(df: DataFrame, limit: int | None = None) -> Column:
    """Whether a row is one of about ``limit`` by the hash of their id, without a sort; true for all rows if there are no more, or no limit."""
    if limit is None or (total := df.count()) <= limit:
        return F.lit(True)
    return F.pmod(F.xxhash64(ID), F.lit(_PARTS)) < _PARTS * limit // total


def bounded_rows(df: DataFrame, limit: int | None = None) -> DataFrame:
    return df.filter(bound(df, limit))


def models_at_a_time(n_rows: int, n_terms: int, parallelism: int) -> int:
    """At most ``parallelism``, and no more than ``MODELS_BYTES`` hold; the models do not depend on it."""
    return max(1, min(parallelism, MODELS_BYTES // max(4 * n_rows * n_terms, 1)))


def best_positions(model: PipelineModel, train: DataFrame, limit: int) -> list[int]:
    """Vector positions of the ``limit`` terms of ``model`` that depend most on the label; of all if there are no more.

    The statistic comes from one aggregate over the training words; only the chosen terms reach the driver.
    """
    vocabulary = vocabulary_of(model)
    if len(vocabulary) <= limit:
        return list(range(len(vocabulary)))
    cells = term_counts(train, WORDS_STEMMED, keep=[LABEL])
    statistics = term_chi_square(cells, label_counts(train, LABEL), LABEL)
    known = statistics.filter(F.col("df") >= 1)
    position = {term: i for i, term in enumerate(vocabulary)}
    # Terms outside the vocabulary were too rare for it, so they are left out before the best are taken.
    terms = train.sparkSession.createDataFrame(pd.DataFrame({"term": vocabulary}))
    chosen = best_terms(known.join(terms, "term", "left_semi"), limit)
    return sorted(position[row["term"]] for row in chosen.select("term").collect())


def bounded_features(model: PipelineModel, train: DataFrame, limit: int | None = None) -> PipelineModel:
    """``model`` with its ``best_positions`` for the forest; as it is if it has no more terms, or without a limit."""
    if limit is None or len(vocabulary_of(model)) <= limit:
        return model
    indices = best_positions(model, train, limit)
    wide = f"{TFIDF}_all"
    weights = model.stages[-1].copy({model.stages[-1].outputCol: wide})
    return PipelineModel([*model.stages[:-1], weights, VectorSlicer(inputCol=wide, outputCol=TFIDF, indices=indices)])


@dataclass(frozen=True)
class JobResult:
    """What the job found out. ``predictions`` and ``accuracy`` are lazy; the other tables are small.

    ``n_terms`` is the size of the vocabulary, ``n_dropped`` the number of terms that ``vocab_size`` cut off, and
    ``n_left_out`` those of the vocabulary that the forest was not given, none unless ``forest_features`` asks for it. The result
    owns its staged tables: ``close`` deletes them, and so does leaving it as a context. Lazy tables have to be read before.
    ``train`` are the rows of the grid search, ``words`` those of ``split_words``, and with a ledger ``run`` is the name of the search in it.
    """

    report: DataFrame
    scores: DataFrame
    accuracy: DataFrame
    predictions: DataFrame
    features_model: PipelineModel
    model: PipelineModel
    n_terms: int
    n_dropped: int
    n_left_out: int
    train: DataFrame
    words: DataFrame
    run: str | None
    staged: Staged
    n_bad_lines: int = 0

    def close(self) -> None:
        self.staged.close()

    def __enter__(self) -> JobResult:
        return self

    def __exit__(self, *_) -> None:
        self.close()


def split_words(reviews: DataFrame, folds: int, is_test: bool = False) -> DataFrame:
    """Stemmed words with part and fold, written once to the shared folder, one directory per part.

    This is the only pass over the raw text and the only one through Python. Everything later reads
    the written table, and the parts are picked by directory.
    """
    words = review_words(reviews, is_test)
    return stage(
        words.withColumns({PART: part(F.col(ID)), FOLD: fold(F.col(ID), folds)}),
        "words",
        partition_by=[PART],
    )


def learn(
    reviews: DataFrame,
    with_indexers: bool = False,
    is_test: bool = False,
    grid: tuning.Grid | None = None,
    min_df: float = MIN_DF,
    vocab_size: int = VOCAB_SIZE,
    max_df: float | None = None,
    fit_on_all: bool = False,
    parallelism: int = 4,
    seed: int = 123,
    forest_rows: int | None = None,
    forest_features: int | None = None,
    ledger: str | None = None,
) -> JobResult:
    """Tune and score a forest on review records (``reviewText``, ``overall`` and, if there is one, ``doc_id``).

    Vocabulary and weights come from the training part; ``fit_on_all`` takes all rows instead, which
    lets the test part influence its own features. The forest is fitted on all training rows and all terms of the
    vocabulary. Only a caller that asks for it gets a forest of about ``forest_rows`` rows, or of the ``forest_features``
    terms that depend most on the label; also then the search scores all rows of a fold, and all test rows are scored.
    At most ``parallelism`` models are trained at a time, fewer where their rows are large.
    ``ledger`` names a folder for finished models; a second start with the same data and grid goes on from there.
    """
    with owning(reviews.sparkSession) as staged:
        return _learn(
            reviews, with_indexers, is_test, grid or tuning.GRIDS["indexed" if with_indexers else "default"],
            weight_stage(min_df, vocab_size, max_df=max_df), fit_on_all, parallelism, seed, forest_rows, forest_features, ledger, staged,
        )


def _learn(
    reviews: DataFrame, with_indexers: bool, is_test: bool, grid: tuning.Grid, weights: TfIdf, fit_on_all: bool, parallelism: int,
    seed: int, forest_rows: int | None, forest_features: int | None, ledger: str | None, staged: Staged,
) -> JobResult:
    spark = reviews.sparkSession
    words = split_words(reviews, grid.folds, is_test)
    tuning.check_labels(words)
    fit_rows = words if fit_on_all else words.filter(F.col(PART) == TRAIN)
    features_model = weights.fit(fit_rows)
    narrow = bounded_features(features_model, words.filter(F.col(PART) == TRAIN), forest_features)
    n_terms = len(vocabulary_of(features_model))
    kept = Ledger(spark, ledger) if ledger is not None else None
    features = narrow.transform(words).select(ID, LABEL, FOLD, PART, TFIDF)
    train = features.filter(F.col(PART) == TRAIN).drop(PART)
    n_given = n_terms if forest_features is None else min(n_terms, forest_features)
    with held(train.withColumn(FITTED, bound(train, forest_rows))) as train:
        parallelism = models_at_a_time(train.filter(FITTED).count(), n_given, parallelism)
        if with_indexers:
            stages = tuning.indexed_stages(train, grid, FOLD, parallelism, seed, kept)
        else:
            stages = tuning.plain_stages(grid, FOLD, parallelism, seed, kept)
        model = stages.fit(train)
    search = tuning.search_of(model)
    predictions = model.transform(features.filter(F.col(PART) == TEST).drop(PART))
    actual = tuning.INDEXED_LABEL if with_indexers else LABEL
    return JobResult(
        report=report(spark, search),
        scores=grid_scores(spark, search),
        accuracy=accuracy(predictions, actual, tuning.PREDICTION),
        predictions=predictions,
        features_model=features_model,
        model=model,
        n_terms=n_terms,
        n_dropped=features_model.n_dropped,
        n_left_out=n_terms - n_given,
        train=train,
        words=words,
        run=search.run if kept is not None else None,
        staged=staged,
    )


def run(
    spark: SparkSession,
    input_path: str,
    output_path: str | None,
    with_indexers: bool = False,
    is_test: bool = False,
    is_local: bool = False,
    input_format: str = "json",
    base_path: str | None = None,
    infer: bool = False,
    bad_lines: str | None = None,
    **options,
) -> JobResult:
    """Read reviews, learn, and report the best parameters. ``options`` are those of ``learn``.

    On a cluster the report goes to ``output_path`` as CSV with a header, locally to the console. The old report stays until the
    new one is complete. ``bad_lines`` names a folder for lines of a JSON input that are no records; without it they are
    rows of nulls, and the job stops at their missing labels.
    """
    with owning(spark) as scanned:
        if bad_lines is not None and input_format == "json":
            scan = read_reviews_checked(spark, input_path, bad_lines)
            reviews, n_bad = scan.good, scan.n_bad()
        else:
            reviews, n_bad = read_reviews(spark, input_path, input_format, base_path, infer), 0
    if not is_test:
        # Without an id no column is fit to deal rows by: many texts are null or equal.
        reviews = spread(reviews, ID if ID in reviews.columns else None)
    try:
        result = learn(reviews, with_indexers=with_indexers, is_test=is_test, **options)
    finally:
        # The words of the reviews are staged by now.
        scanned.close()
    if is_local:
        show(result.report)
    else:
        publish_csv(result.report, output_path)
    show(result.accuracy)
    return replace(result, n_bad_lines=n_bad)
