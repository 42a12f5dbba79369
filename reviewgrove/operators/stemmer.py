"""Stemming as a stage for ML pipelines."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewgrove.functions.stemming import EXTENDED, stem_all


class Stemmer(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Stems every word of an ``array<string>`` column; keeps order and repeats. Can be saved."""

    mode = Param(Params._dummy(), "mode", '"extended" or "paper"', TypeConverters.toString)

    @keyword_only
    def __init__(self, inputCol=None, outputCol=None, mode=EXTENDED):
        super().__init__()
        self._setDefault(mode=EXTENDED)
        self.setParams(**self._input_kwargs)

    @keyword_only
    def setParams(self, inputCol=None, outputCol=None, mode=EXTENDED):
        return self._set(**self._input_kwargs)

    def setInputCol(self, value: str) -> Stemmer:
        return self._set(inputCol=value)

    def setOutputCol(self, value: str) -> Stemmer:
        return self._set(outputCol=value)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        words = F.col(self.getInputCol())
        return dataset.withColumn(self.getOutputCol(), stem_all(words, self.getOrDefault(self.mode)))
