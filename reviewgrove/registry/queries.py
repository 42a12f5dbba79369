"""One query per operator. Each takes the session and the folder of the tables and reads whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Binarizer, IndexToString, StringIndexer, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reviewgrove.functions import cleaning, fields
from reviewgrove.functions.stemming import stem, stem_all
from reviewgrove.operators import indexing, split
from reviewgrove.operators.choice import best_terms, label_counts, term_chi_square, term_impurity
from reviewgrove.operators.collapse import collapse_first
from reviewgrove.operators.scores import accuracy, accuracy_evaluator
from reviewgrove.operators.terms import (
    Vocabulary,
    distinct_words,
    each_word,
    fit_vocabulary,
    term_counts,
    weigh,
)
from reviewgrove.operators.vectors import TfIdf, vocabulary_of
from reviewgrove.plans import job, tuning
from reviewgrove.plans.features import (
    ID,
    LABEL,
    TEXT,
    TFIDF,
    WORDS,
    WORDS_CLEANED,
    WORDS_STEMMED,
    builtin_feature_stages,
    feature_stages,
    first_rows,
    text_stages,
    weight_stage,
    words_of,
)
from reviewgrove.plans.search import Ledger, fold_shares, out_of_fold
from reviewgrove.registry.tables import RECORD_SCHEMA, documents, labels, overall, reviews, side_columns, side_values
from reviewgrove.session import fresh_path, stage
from reviewgrove.sources.records import records_to_frame
from reviewgrove.sources.reviews import (
    in_partitions_of,
    json_copy,
    read_reviews_checked,
    read_reviews_parquet,
    write_partitioned,
)
from reviewgrove.sources.sinks import publish_csv, read_csv, write_csv

Query = Callable[[SparkSession, str], DataFrame]
REGISTERED: dict[str, Query] = {}
CLEAN = "clean"
DIGITS = 9
# Small settings that keep a registered training run short; they are settings, not row limits.
# Terms among which a single split is chosen.
STUMP_TERMS = 64
SMALL_GRID = tuning.Grid({"maxDepth": [3, 5], "numTrees": [5], "impurity": ["gini"]}, folds=2)


def query(function: Query) -> Query:
    REGISTERED[function.__name__] = function
    return function


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, reviewText`` of all documents, cleaned."""
    text = cleaning.fill_missing(cleaning.clean_text(F.col("text")))
    return documents(spark, sf_dir, "text").select(ID, text.alias(TEXT))


def words(spark: SparkSession, sf_dir: str, stops: bool = True, stemmed: bool = False) -> DataFrame:
    """``doc_id, words`` of all documents."""
    df = words_of(documents(spark, sf_dir, "text"), "text", stops)
    return df.withColumn(WORDS, stem_all(F.col(WORDS))) if stemmed else df


def labelled_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, label, words`` of the labelled documents."""
    rated = reviews(spark, sf_dir)
    return words_of(rated.select(ID, fields.label(F.col("overall")).alias(LABEL), TEXT))


def counted(spark: SparkSession, sf_dir: str, stemmed: bool = False) -> DataFrame:
    """Long term counts of all documents without stop words, written once."""
    return stage(term_counts(words(spark, sf_dir, stemmed=stemmed), WORDS, keep=[ID]), "cells")


def labelled_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long term counts of the labelled documents, written once."""
    return stage(term_counts(labelled_words(spark, sf_dir), WORDS, keep=[ID, LABEL]), "cells")


def n_documents(spark: SparkSession, sf_dir: str) -> int:
    return documents(spark, sf_dir).count()


def n_labelled(spark: SparkSession, sf_dir: str) -> int:
    return documents(spark, sf_dir).join(labels(spark, sf_dir), ID, "left_semi").count()


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, DIGITS) for name in names})


# Sources and sinks


@query
def json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = reviews(spark, sf_dir, labelled=False)
    return json_copy(rows, "json", RECORD_SCHEMA).select(ID, TEXT, "overall")


@query
def json_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = reviews(spark, sf_dir, labelled=False)
    return json_copy(rows, "json", None).select(ID, TEXT, "overall")


@query
def parquet_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "by-lang")
    write_partitioned(documents(spark, sf_dir, "text", "lang"), path, "lang")
    return read_reviews_parquet(spark, path).groupBy("lang").agg(F.count(F.lit(1)).alias("n"))


@query
def parquet_one_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "by-lang")
    write_partitioned(documents(spark, sf_dir, "text", "lang"), path, "lang")
    df = read_reviews_parquet(spark, f"{path}/lang=de/*.parquet", base_path=path)
    return df.select(ID, "lang", F.length("text").alias("n_chars"))


@query
def records_to_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = documents(spark, sf_dir, "lang", "n_chars").join(labels(spark, sf_dir), ID)
    per_label = rated.groupBy(fields.label(overall()).alias(LABEL)).agg(
        F.count(F.lit(1)).alias("n"),
        F.bool_or(F.col("toxic") == 1).alias("has_toxic"),
        F.round(F.avg("n_chars"), DIGITS).alias("mean_chars"),
        F.max("lang").alias("last_lang"),
    )
    return records_to_frame(spark, [row.asDict() for row in per_label.collect()])


@query
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = reviews(spark, sf_dir, labelled=False).select(
        ID, fields.label(F.col("overall")).alias(LABEL), cleaning.clean_text(F.col(TEXT)).alias(CLEAN)
    )
    path = fresh_path(spark, "csv")
    write_csv(rows, path)
    return read_csv(spark, path, rows.schema)


@query
def json_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good records out of JSON lines of which every seventh is cut off and every eleventh has a text for its rating."""
    record = F.to_json(F.struct(ID, F.col("text").alias(TEXT), F.lit(1.5).alias("overall")))
    line = (
        F.when(F.col(ID) % 7 == 0, F.substring(record, F.lit(1), F.length(record) - 3))
        .when(F.col(ID) % 11 == 0, F.replace(record, F.lit('"overall":1.5'), F.lit('"overall":"good"')))
        .otherwise(record)
    )
    path = fresh_path(spark, "damaged")
    documents(spark, sf_dir, "text").select(line.alias("value")).write.text(path)
    scan = read_reviews_checked(spark, path, schema=RECORD_SCHEMA)
    return scan.good.select(ID, TEXT, "overall", F.lit(scan.n_bad()).cast("long").alias("n_bad"))


@query
def parquet_pruned_by_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts in the languages that hold fewer documents than an even share: the join names the directories to scan."""
    path = fresh_path(spark, "by-lang")
    texts = documents(spark, sf_dir, "text", "lang")
    write_partitioned(texts, path, "lang")
    side = stage(texts.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "languages")
    even = side.agg(F.avg("n")).scalar()
    rare = in_partitions_of(read_reviews_parquet(spark, path), side.filter(F.col("n") < even), "lang")
    return rare.select(ID, "lang", F.length("text").alias("n_chars"))


@query
def csv_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report that replaces another one as a whole, read back."""
    rows = documents(spark, sf_dir, "lang", "n_chars").groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.max("n_chars").alias("longest"))
    path = fresh_path(spark, "report")
    publish_csv(rows.limit(1), path)
    publish_csv(rows, path)
    return read_csv(spark, path, rows.schema)


# Projections, filters, limits


@query
def label_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels(spark, sf_dir).select(ID, fields.label(overall()).alias(LABEL))


@query
def label_truncated(spark: SparkSession, sf_dir: str) -> DataFrame:
    rating = (overall() + (F.col(ID) % 10) / 10) * F.when(F.col(ID) % 2 == 0, 1).otherwise(-1)
    return labels(spark, sf_dir).select(ID, fields.label(rating).alias(LABEL))


@query
def drop_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet")
    wide = texts.join(labels(spark, sf_dir).select(ID, overall().alias("overall")), ID)
    return fields.drop_unused(wide.select(ID, F.col("text").alias(TEXT), "overall", *side_values()))


@query
def null_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col(ID) % 7 != 0, F.col("text"))
    df = documents(spark, sf_dir, "text")
    return df.select(ID, cleaning.fill_missing(cleaning.clean_text(text)).alias(CLEAN))


@query
def first_100(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = first_rows(documents(spark, sf_dir, "text"))
    return df.select(ID, cleaning.clean_text(F.col("text")).alias(CLEAN))


@query
def feature_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = labelled_counts(spark, sf_dir)
    weights = weigh(cells, fit_vocabulary(cells, n_labelled(spark, sf_dir)))
    return rounded(weights.select(ID, LABEL, "term", TFIDF), TFIDF)


@query
def vote_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return side_columns(spark, sf_dir).select(ID, fields.vote_number(F.col("vote")).alias("value"))


@query
def asin_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return side_columns(spark, sf_dir).select(ID, fields.asin_number(F.col("asin")).alias("value"))


@query
def style_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return side_columns(spark, sf_dir).select(ID, fields.style_format(F.col("style")).alias("value"))


@query
def epoch_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return side_columns(spark, sf_dir).select(ID, fields.epoch_time(F.col("unixReviewTime")).alias("value"))


@query
def review_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return side_columns(spark, sf_dir).select(ID, fields.review_time(F.col("reviewTime")).alias("value"))


# Cleaning, step by step on the whole text, and as a whole


def _after(steps: int) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        text = F.col("text")
        for step in cleaning.STEPS[:steps]:
            text = step(text)
        return documents(spark, sf_dir, "text").select(ID, text.alias("value"))

    return run


for position, name in enumerate(
    ("strip_email", "strip_breaks", "strip_digits", "strip_single_letters", "collapse_non_word", "lower_case"), 1
):
    REGISTERED[name] = _after(position)


@query
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir, "text").select(ID, cleaning.clean_text(F.col("text")).alias(CLEAN))


# Tokens, counts, weights


@query
def tokenise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return each_word(words(spark, sf_dir, stops=False), WORDS, keep=[ID])


@query
def tokenise_ml(spark: SparkSession, sf_dir: str) -> DataFrame:
    return each_word(text_stages()[0].transform(cleaned(spark, sf_dir)), WORDS, keep=[ID])


@query
def remove_stop_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return each_word(words(spark, sf_dir), WORDS, keep=[ID])


@query
def remove_stop_words_ml(spark: SparkSession, sf_dir: str) -> DataFrame:
    stages = PipelineModel(text_stages(stem=False))
    return each_word(stages.transform(cleaned(spark, sf_dir)), WORDS_CLEANED, keep=[ID])


@query
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return term_counts(words(spark, sf_dir, stops=False), WORDS, keep=[ID])


@query
def token_counts_no_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return term_counts(words(spark, sf_dir), WORDS, keep=[ID])


@query
def stem_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_words(words(spark, sf_dir), WORDS).withColumn("stem", stem(F.col("term")))


@query
def stem_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return each_word(words(spark, sf_dir, stemmed=True), WORDS, keep=[ID])


@query
def stem_documents_ml(spark: SparkSession, sf_dir: str) -> DataFrame:
    return each_word(PipelineModel(text_stages()).transform(cleaned(spark, sf_dir)), WORDS_STEMMED, keep=[ID])


def _vocabulary(spark: SparkSession, sf_dir: str, **limits) -> Vocabulary:
    cells = term_counts(words(spark, sf_dir), WORDS, keep=[])
    return fit_vocabulary(cells, n_documents(spark, sf_dir), **limits)


@query
def vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _vocabulary(spark, sf_dir).table.drop("idf")


@query
def vocabulary_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _vocabulary(spark, sf_dir, vocab_size=300).table.drop("idf")


@query
def vocabulary_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _vocabulary(spark, sf_dir, min_df=0.02, max_df=0.5).table.drop("idf")


@query
def idf_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_vocabulary(spark, sf_dir).table.select("term", "df", "idf"), "idf")


def _weights(spark: SparkSession, sf_dir: str, stemmed: bool) -> DataFrame:
    cells = counted(spark, sf_dir, stemmed)
    return rounded(weigh(cells, fit_vocabulary(cells, n_documents(spark, sf_dir))), TFIDF)


@query
def tfidf_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _weights(spark, sf_dir, stemmed=False)


@query
def tfidf_stemmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _weights(spark, sf_dir, stemmed=True)


def _long(df: DataFrame, positions: DataFrame) -> DataFrame:
    """Vectors back to ``doc_id, term, tf, tfidf``; ``positions`` names the term of each index."""
    cells = df.select(
        ID,
        F.inline(
            F.arrays_zip(
                F.unwrap_udt(TFIDF).getField("indices").alias("indices"),
                F.unwrap_udt("term_freq").getField("values").alias("tf"),
                F.unwrap_udt(TFIDF).getField("values").alias(TFIDF),
            )
        ),
    )
    return rounded(cells.join(positions, "indices").select(ID, "term", F.col("tf").cast("int").alias("tf"), TFIDF), TFIDF)


@query
def tfidf_ml(spark: SparkSession, sf_dir: str) -> DataFrame:
    *words_only, counts, weights = builtin_feature_stages(stem=False).getStages()
    # Both of Spark's stages read the words when they are fitted, so these are made once.
    rows = stage(PipelineModel(words_only).transform(cleaned(spark, sf_dir)).select(ID, WORDS_CLEANED), "words")
    model = Pipeline(stages=[counts, weights]).fit(rows)
    # Spark's own stage keeps its terms on the driver only, so they fit a broadcast; no cell is shuffled for its term.
    positions = spark.createDataFrame(pd.DataFrame({"term": vocabulary_of(model)}).rename_axis("indices").reset_index())
    return _long(model.transform(rows), F.broadcast(positions))


def _vector_weights(spark: SparkSession, sf_dir: str, stem: bool) -> DataFrame:
    rows = stage(words(spark, sf_dir, stemmed=stem), "words")
    model = TfIdf(inputCol=WORDS, outputCol=TFIDF).fit(rows)
    return _long(model.transform(rows), model.positions)


@query
def tfidf_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _vector_weights(spark, sf_dir, stem=False)


@query
def tfidf_stemmed_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _vector_weights(spark, sf_dir, stem=True)


@query
def fitted_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All feature stages as one estimator, fitted and applied."""
    texts = stage(cleaned(spark, sf_dir), "texts")
    model = feature_stages().fit(texts)
    return _long(model.transform(texts), model.stages[-1].positions)


# Split and indexes


@query
def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select(ID, split.part(F.col(ID)).alias("part"))


@query
def random_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per id the number of parts it is in, and whether the first part has about three quarters of all ids."""
    train, test = split.random_parts(documents(spark, sf_dir))
    both = train.withColumn("first", F.lit(1)).unionByName(test.withColumn("first", F.lit(0)))
    per_id = both.groupBy(ID).agg(F.count(F.lit(1)).alias("n_parts"), F.max("first").alias("first"))
    share = per_id.agg(F.abs(F.avg("first") - 0.75).alias("off")).select(F.col("off") < 0.1).scalar()
    return per_id.select(ID, "n_parts", share.alias("share_as_asked"))


@query
def fold_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select(ID, split.fold(F.col(ID), 3).alias("fold"))


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels(spark, sf_dir).select(ID, fields.label(overall()).alias(LABEL))


@query
def label_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return indexing.label_index(_labelled(spark, sf_dir))


@query
def label_index_ml(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _labelled(spark, sf_dir)
    model = StringIndexer(inputCol=LABEL, outputCol="idx").fit(rows)
    return model.transform(rows).select(LABEL, "idx").distinct()


@query
def label_unindex(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _labelled(spark, sf_dir)
    index = stage(indexing.label_index(rows), "label-index")
    coded = rows.join(index, LABEL).select(ID, F.col("idx").alias("prediction"))
    return indexing.label_unindex(coded, index, "prediction", "predictedLabel").select(ID, "predictedLabel")


@query
def label_unindex_ml(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _labelled(spark, sf_dir)
    model = StringIndexer(inputCol=LABEL, outputCol="prediction").fit(rows)
    names = IndexToString(inputCol="prediction", outputCol="predictedLabel", labels=model.labels)
    return names.transform(model.transform(rows)).select(ID, "predictedLabel")


@query
def feature_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = labelled_counts(spark, sf_dir)
    n_docs = n_labelled(spark, sf_dir)
    frequent = fit_vocabulary(cells, n_docs).side("term")
    return indexing.feature_categories(cells.join(frequent, "term", "left_semi"), n_docs)


@query
def feature_categories_ml(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stage(labelled_words(spark, sf_dir), "words")
    model = TfIdf(inputCol=WORDS, outputCol=TFIDF).fit(rows)
    maps = indexing.fit_indexer(model.transform(rows), TFIDF, "indexed").categoryMaps
    found = [(term, i in maps) for i, term in enumerate(vocabulary_of(model))]
    return spark.createDataFrame(found, "term string, is_categorical boolean")


@query
def feature_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The codes of all values of the categorical features with more than one."""
    cells = labelled_counts(spark, sf_dir)
    n_docs = n_labelled(spark, sf_dir)
    frequent = fit_vocabulary(cells, n_docs).side("term")
    return indexing.value_mapping(cells.join(frequent, "term", "left_semi"), n_docs).filter("n_values > 1").drop("n_values")


@query
def feature_values_ml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from the maps of Spark's indexer, fitted on counts."""
    rows = stage(labelled_words(spark, sf_dir), "words")
    model = TfIdf(inputCol=WORDS, outputCol=TFIDF).fit(rows)
    maps = indexing.fit_indexer(model.transform(rows), "term_freq", "indexed").categoryMaps
    # Counts of a term of every text differ where its weights are all zero.
    codes = [(i, int(value), code) for i, values in maps.items() if 0.0 in values for value, code in values.items()]
    return spark.createDataFrame(codes, "indices int, tf int, code int").join(model.positions, "indices").select("term", "tf", "code")


@query
def indexed_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of the test part, coded by what the training part has: codes of known and unseen values, weights of the others."""
    cells = labelled_counts(spark, sf_dir).withColumn("part", split.part(F.col(ID)))
    train, test = (cells.filter(F.col("part") == part).drop("part") for part in (split.TRAIN, split.TEST))
    rated = documents(spark, sf_dir).join(labels(spark, sf_dir), ID, "left_semi")
    n_train = rated.filter(split.part(F.col(ID)) == split.TRAIN).count()
    known = fit_vocabulary(train, n_train, min_df=5)
    mapping = stage(indexing.value_mapping(train.join(known.side("term"), "term", "left_semi"), n_train), "value-mapping")
    return rounded(indexing.indexed_values(weigh(test, known), mapping), "value")


def _chi_square(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = reviews(spark, sf_dir).select(fields.label(F.col("overall")).alias(LABEL))
    return term_chi_square(labelled_counts(spark, sf_dir), label_counts(rated))


@query
def term_dependence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chi-square of every term against the label."""
    return _chi_square(spark, sf_dir)


@query
def terms_by_dependence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 300 terms that depend most on the label."""
    return best_terms(_chi_square(spark, sf_dir), 300)


@query
def tfidf_by_heat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights with the vocabulary split: the terms that fit 16 KiB by broadcast, all others by a shuffle."""
    cells = counted(spark, sf_dir)
    return rounded(weigh(cells, fit_vocabulary(cells, n_documents(spark, sf_dir)), limit=1 << 14), TFIDF)


# Learning, tuning, report


@query
def forest_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = job.split_words(reviews(spark, sf_dir), folds=2)
    train, test = (rows.filter(F.col(job.PART) == part) for part in (split.TRAIN, split.TEST))
    weights = weight_stage().fit(train)
    model = tuning.forest(numTrees=5, maxDepth=5).fit(weights.transform(train))
    return _checked(stage(model.transform(weights.transform(test)).select(LABEL, "prediction"), "predictions"))


def _checked(predictions: DataFrame, label: str = LABEL) -> DataFrame:
    """``n_test``, and whether the accuracy is the share of hits as Spark's evaluator counts them."""
    measured = accuracy_evaluator(label).evaluate(predictions)
    return accuracy(predictions, label).select(
        "n_test", (F.abs(F.col("accuracy") - measured) < 1e-9).alias("is_hit_share")
    )


@query
def forest_stump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A forest of one tree with one split on the presence of terms: share of the most frequent label where each test row ends.

    Which term splits best, and the shares on its two sides, follow from counts.
    """
    rows = job.split_words(reviews(spark, sf_dir), folds=2)
    train, test = (rows.filter(F.col(job.PART) == part) for part in (split.TRAIN, split.TEST))
    weights = weight_stage().fit(train)
    cells = term_counts(train, WORDS_STEMMED, keep=[LABEL])
    splits = term_impurity(cells, label_counts(train)).join(weights.positions, "term")
    # One split is asked for, so the forest chooses among the best by the counts of all rows, and not all terms are cells of a row.
    best = splits.orderBy(F.round("impurity", DIGITS), "indices").limit(STUMP_TERMS).select("indices").collect()
    few = VectorSlicer(inputCol="term_freq", outputCol="few", indices=sorted(row["indices"] for row in best) or [0])
    present = Binarizer(inputCol="few", outputCol="present", threshold=0.5)
    features = PipelineModel([*weights.stages, few, present])
    model = tuning.forest(features="present", numTrees=1, maxDepth=1, bootstrap=False).fit(features.transform(train))
    scored = model.transform(features.transform(test))
    share = F.array_max(vector_to_array("probability"))
    return rounded(scored.select(ID, "prediction", share.alias("share")), "share")


@query
def learnt_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job, on all terms, for a label that is a rule on two planted words: one split cannot tell it, two can, and the tree
    asks for two terms only, those that depend most on the label."""
    one, two = F.col(ID) % 3 > 0, F.col(ID) % 5 > 1
    planted = F.concat_ws(" ", "text", F.when(one, "plantedone"), F.when(two, "plantedtwo"))
    rows = documents(spark, sf_dir, "text").select(ID, planted.alias(TEXT), F.when(one & two, 2.0).otherwise(1.0).alias("overall"))
    grid = tuning.Grid({"maxDepth": [1, 2], "numTrees": [1], "featureSubsetStrategy": ["all"]}, folds=2)
    result = job.learn(rows, grid=grid)
    strongest = job.best_positions(result.features_model, result.words.filter(F.col(job.PART) == split.TRAIN), 2)
    asked = tuning.search_of(result.model).bestModel.featureImportances.indices.tolist()
    chosen = F.lit(sorted(asked) == strongest).alias("two_terms")
    best = result.report.select("maxDepth", "numTrees", "featureSubsetStrategy").first()
    values = [F.lit(value).alias(name) for name, value in best.asDict().items()]
    return result.accuracy.select(*[v.cast("long") if n < 2 else v for n, v in enumerate(values)], "n_test", "accuracy", chosen)


@query
def out_of_fold_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per point and fold: rows scored by the model that has not seen them, whether their hits are the fold's score, and
    whether the mean over the folds is the score of the point."""
    ledger = fresh_path(spark, "ledger")
    result = _search(spark, sf_dir, ledger=ledger)
    search = tuning.search_of(result.model)
    kept, run = Ledger(spark, ledger), result.run
    scored = stage(out_of_fold(result.train, kept, run, [0, 1], SMALL_GRID.folds, job.FOLD).select(LABEL, job.FOLD, "point", "prediction"), "scored")
    shares = fold_shares(scored, LABEL, job.FOLD)
    rows = kept.rows().filter(F.col("run") == run).select("point", "fold", "score")
    means = spark.createDataFrame(list(enumerate(map(float, search.avgMetrics))), "point int, mean double")
    mean = F.avg("score").over(Window.partitionBy("point"))
    return shares.join(rows, ["point", "fold"]).join(means, "point").select(
        "point", "fold", "n_rows", (F.abs(F.col("share") - F.col("score")) < 1e-9).alias("is_score"),
        (F.abs(mean - F.col("mean")) < 1e-9).alias("is_mean"),
    )


@query
def majority_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _labelled(spark, sf_dir)
    most = indexing.label_index(rows).filter("idx = 0").select(F.col(LABEL).alias("prediction"))
    return accuracy(rows.withColumn("prediction", most.scalar())).select(
        F.col("n_test").alias("n"), F.round("accuracy", DIGITS).alias("accuracy")
    )


@query
def rule_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratings = _labelled(spark, sf_dir).join(documents(spark, sf_dir, "n_chars"), ID)
    predictions = ratings.select(
        F.col(LABEL).cast("double").alias(LABEL),
        (F.lit(3) + F.col("n_chars") % 2).cast("double").alias("prediction"),
    )
    measured = accuracy_evaluator().evaluate(predictions)
    return rounded(
        accuracy(predictions).withColumn("evaluator_accuracy", F.lit(measured)),
        "accuracy",
        "test_error",
        "evaluator_accuracy",
    )


def _search(spark: SparkSession, sf_dir: str, **options) -> job.JobResult:
    return job.learn(reviews(spark, sf_dir), grid=SMALL_GRID, **options)


@query
def cross_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All points of the grid, each with a share as its score."""
    inside = F.col("accuracy").between(0, 1).alias("is_share")
    return _search(spark, sf_dir).scores.select("point", "maxDepth", "numTrees", "impurity", inside)


@query
def best_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the report names the best of the scores, the first one of equals, and all parameters of the grid."""
    result = _search(spark, sf_dir)
    names = list(SMALL_GRID.values)
    first = result.scores.orderBy(F.desc("accuracy"), "point").limit(1).select(*names)
    same = result.report.select(*names).exceptAll(first).count() == 0
    return result.report.select(F.lit(same).alias("is_best"), F.lit(sorted(result.report.columns) == sorted(names)).alias("is_complete"))


@query
def indexed_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    predictions = _search(spark, sf_dir, with_indexers=True).predictions
    return _checked(stage(predictions.select(tuning.INDEXED_LABEL, "prediction"), "predictions"), tuning.INDEXED_LABEL)


@query
def job_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job from JSON without ids to the CSV report, read back: whether it has every parameter of the grid, and how many."""
    path, out = fresh_path(spark, "reviews"), fresh_path(spark, "report")
    reviews(spark, sf_dir).drop(ID).write.json(path)
    job.run(spark, path, out, grid=SMALL_GRID)
    names = spark.read.option("header", True).csv(out).columns
    return spark.range(1).select(
        F.lit(sorted(names) == sorted(SMALL_GRID.values)).alias("is_complete"), F.lit(len(names)).cast("long").alias("n_parameters")
    )


@query
def collapse_first_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Named parameters, one row each and null elsewhere, as one row."""
    texts = documents(spark, sf_dir, "lang", "n_chars")
    names = {
        "n_documents": F.count(F.lit(1)),
        "longest": F.max("n_chars"),
        "last_lang": F.max("lang"),
        "has_french": F.bool_or(F.col("lang") == "fr"),
        "mean_chars": F.round(F.avg("n_chars"), DIGITS),
    }
    single = [texts.agg(value.alias(name)) for name, value in names.items()]
    sparse = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), single)
    return collapse_first(sparse.select(*names))
