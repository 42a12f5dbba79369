"""From review records to TF-IDF features."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import IDF, CountVectorizer, RegexTokenizer, StopWordsRemover
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewgrove.functions import fields
from reviewgrove.functions.cleaning import clean_text, clean_words, fill_missing
from reviewgrove.functions.stemming import EXTENDED, stem_all
from reviewgrove.functions.tokens import drop_stop_words, stop_words
from reviewgrove.operators.stemmer import Stemmer
from reviewgrove.operators.terms import MIN_DF, VOCAB_SIZE
from reviewgrove.operators.vectors import COUNTS_COL, TfIdf
from reviewgrove.sources.reviews import with_review_id

ID = "doc_id"
TEXT = "reviewText"
LABEL = "label"
WORDS = "words"
WORDS_CLEANED = "words_cleaned"
WORDS_STEMMED = "words_stemmed"
TFIDF = "tfidf"
TEST_ROWS = 100


def first_rows(df: DataFrame, rows: int = TEST_ROWS, key: str = ID) -> DataFrame:
    """The rows with the lowest ids: a small trial input that is the same in every run."""
    return df.orderBy(key).limit(rows)


def _identified(reviews: DataFrame, is_test: bool) -> DataFrame:
    """Review records with an id, added where they have none."""
    df = with_review_id(reviews, ID)
    return first_rows(df) if is_test else df


def prepare(reviews: DataFrame, is_test: bool = False) -> DataFrame:
    """``doc_id, reviewText, label`` with the text cleaned, from review records.

    The trial limit comes before the cleaning, which works row by row, so no other rows are cleaned.
    """
    return _identified(reviews, is_test).select(
        ID,
        fill_missing(clean_text(F.col(TEXT))).alias(TEXT),
        fields.label(F.col("overall")).alias(LABEL),
    )


def words_of(df: DataFrame, text: str = TEXT, stops: bool = True) -> DataFrame:
    """Replace a text, not cleaned yet, by its ``words``, without the stop words unless told otherwise."""
    words = clean_words(fill_missing(F.col(text)))
    kept = drop_stop_words(words, stop_words()) if stops else words
    return df.select(*[name for name in df.columns if name != text], kept.alias(WORDS))


def review_words(reviews: DataFrame, is_test: bool = False) -> DataFrame:
    """``doc_id, label, words_stemmed`` from review records, with column functions only.

    The words are those of ``text_stages`` on the table of ``prepare``. Splitting and stop words stay in
    the JVM; only the stemming goes through Python.
    """
    df = _identified(reviews, is_test).select(ID, fields.label(F.col("overall")).alias(LABEL), TEXT)
    return words_of(df).select(ID, LABEL, stem_all(F.col(WORDS)).alias(WORDS_STEMMED))


def text_stages(stem: bool = True, mode: str = EXTENDED) -> list:
    """Stages that need no fitting: tokenise, drop stop words, stem."""
    stages = [
        RegexTokenizer(inputCol=TEXT, outputCol=WORDS, pattern=r"\W"),
        StopWordsRemover(inputCol=WORDS, outputCol=WORDS_CLEANED),
    ]
    if stem:
        stages.append(Stemmer(inputCol=WORDS_CLEANED, outputCol=WORDS_STEMMED, mode=mode))
    return stages


def weight_stage(
    min_df: float = MIN_DF, vocab_size: int = VOCAB_SIZE, stem: bool = True, max_df: float | None = None
) -> TfIdf:
    """The stage that learns vocabulary and weights."""
    stage = TfIdf(inputCol=WORDS_STEMMED if stem else WORDS_CLEANED, outputCol=TFIDF, minDF=min_df, vocabSize=vocab_size)
    return stage if max_df is None else stage.setParams(maxDF=max_df)


def feature_stages(
    min_df: float = MIN_DF, vocab_size: int = VOCAB_SIZE, stem: bool = True, max_df: float | None = None
) -> Pipeline:
    """Text to TF-IDF as one estimator."""
    return Pipeline(stages=[*text_stages(stem), weight_stage(min_df, vocab_size, stem, max_df)])


def builtin_feature_stages(min_df: float = MIN_DF, vocab_size: int = VOCAB_SIZE, stem: bool = True) -> Pipeline:
    """The same with Spark's CountVectorizer and IDF, whose fit merges all candidate terms on the driver."""
    last = WORDS_STEMMED if stem else WORDS_CLEANED
    counts = CountVectorizer(inputCol=last, outputCol=COUNTS_COL, minDF=min_df, vocabSize=vocab_size)
    return Pipeline(stages=[*text_stages(stem), counts, IDF(inputCol=COUNTS_COL, outputCol=TFIDF)])
