"""TF-IDF vectors as a stage for ML pipelines."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reviewgrove.operators.terms import BROADCAST_LIMIT, MIN_DF, VOCAB_SIZE, cut_vocabulary, word_frequencies

COUNTS_COL = "term_freq"
# Bytes of terms that the fitted stage may hold on the driver and on every executor.
MODEL_BYTES = 1 << 30
_SEPARATOR = "\x01"


class EmptyVocabularyError(ValueError):
    """No term is frequent enough to become a feature."""


class TfIdf(Estimator, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Token arrays to TF-IDF vectors; gives what CountVectorizer followed by IDF gives.

    Counting runs as one distributed aggregation over the texts. Only the final terms, at most
    ``vocabSize`` of them, reach the driver, where CountVectorizer would merge all candidates.
    Equal counts are ordered by the term, so the vector positions do not depend on the layout. The fitted model has
    ``n_dropped``, the number of terms that ``vocabSize`` left out, and the table ``positions`` (``indices, term``).
    """

    minDF = Param(Params._dummy(), "minDF", "least number (or share) of texts", TypeConverters.toFloat)
    maxDF = Param(Params._dummy(), "maxDF", "largest number (or share) of texts", TypeConverters.toFloat)
    vocabSize = Param(Params._dummy(), "vocabSize", "largest number of terms", TypeConverters.toInt)
    modelBytes = Param(Params._dummy(), "modelBytes", "largest size of all terms", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, minDF=MIN_DF, maxDF=None, vocabSize=VOCAB_SIZE, modelBytes=MODEL_BYTES):
        super().__init__()
        self._setDefault(minDF=MIN_DF, vocabSize=VOCAB_SIZE, modelBytes=MODEL_BYTES)
        self.setParams(**self._input_kwargs)

    @keyword_only
    def setParams(self, *, inputCol=None, outputCol=None, minDF=MIN_DF, maxDF=None, vocabSize=VOCAB_SIZE, modelBytes=MODEL_BYTES):
        return self._set(**self._input_kwargs)

    def setInputCol(self, value: str) -> TfIdf:
        return self._set(inputCol=value)

    def setOutputCol(self, value: str) -> TfIdf:
        return self._set(outputCol=value)

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        vocabulary = cut_vocabulary(
            word_frequencies(dataset, self.getInputCol()),
            n_docs=dataset.count(),
            min_df=self.getOrDefault(self.minDF),
            vocab_size=self.getOrDefault(self.vocabSize),
            max_df=self.getOrDefault(self.maxDF) if self.isDefined(self.maxDF) else None,
        )
        if vocabulary.n_terms == 0:
            raise EmptyVocabularyError(
                f"none of the terms in {vocabulary.n_docs} texts occurs in "
                f"{self.getOrDefault(self.minDF):g} of them; use more texts or a smaller minDF"
            )
        if vocabulary.n_bytes > self.getOrDefault(self.modelBytes):
            raise ValueError(f"{vocabulary.n_terms} terms take {vocabulary.n_bytes} bytes; lower vocabSize or raise modelBytes")
        terms = vocabulary.table.orderBy(F.desc("corpus_count"), "term").select("term", "idf").toPandas()
        counts = counting_model(terms["term"].tolist(), self.getInputCol(), COUNTS_COL)
        weights = ElementwiseProduct(
            scalingVec=Vectors.dense(terms["idf"].to_numpy()),
            inputCol=COUNTS_COL,
            outputCol=self.getOutputCol(),
        )
        model = PipelineModel([counts, weights])
        model.n_dropped = vocabulary.n_dropped
        # At most vocabSize rows, numbered as the list above.
        place = F.row_number().over(Window.orderBy(F.desc("corpus_count"), "term")) - 1
        positions = vocabulary.table.select(place.alias("indices"), "term")
        model.positions = F.broadcast(positions) if vocabulary.n_bytes <= BROADCAST_LIMIT else positions
        return model


def counting_model(terms: list[str], input_col: str, output_col: str) -> CountVectorizerModel:
    """Model that counts ``terms``, each at its position in the list.

    ``CountVectorizerModel.from_vocabulary`` copies term by term to the JVM, which takes the better part
    of a minute for a full vocabulary. Here the terms go over as one string.
    """
    if any(_SEPARATOR in term or not term for term in terms):
        return CountVectorizerModel.from_vocabulary(terms, inputCol=input_col, outputCol=output_col)
    jvm = SparkSession.active()._jvm
    array = jvm.java.util.regex.Pattern.compile(_SEPARATOR).split(_SEPARATOR.join(terms))
    model = CountVectorizerModel(jvm.org.apache.spark.ml.feature.CountVectorizerModel(array))
    model._set(vocabSize=len(terms))
    return model.setInputCol(input_col).setOutputCol(output_col)


def vocabulary_of(model: PipelineModel) -> list[str]:
    """Terms of a fitted pipeline, by vector position."""
    for stage in model.stages:
        if isinstance(stage, PipelineModel):
            return vocabulary_of(stage)
        if isinstance(stage, CountVectorizerModel):
            return stage.vocabulary
    raise ValueError("no stage of the model holds a vocabulary")
