"""Stemming: published examples, list handling, the ML stage."""

from __future__ import annotations

import pyarrow as pa
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from reviewgrove.functions.stemming import EXTENDED, PAPER, Stems, measure, stem, stem_lists, stem_word
from reviewgrove.operators.stemmer import Stemmer

# The examples of the paper; where a later step changes the word again, the final stem is given.
PAPER_PAIRS = {
    "caresses": "caress", "ponies": "poni", "ties": "ti", "caress": "caress", "cats": "cat",
    "feed": "feed", "agreed": "agre", "plastered": "plaster", "bled": "bled", "motoring": "motor", "sing": "sing",
    "conflated": "conflat", "troubled": "troubl", "sized": "size", "hopping": "hop", "tanned": "tan",
    "falling": "fall", "hissing": "hiss", "fizzed": "fizz", "failing": "fail", "filing": "file",
    "happy": "happi", "sky": "sky",
    "relational": "relat", "conditional": "condit", "rational": "ration", "valenci": "valenc", "hesitanci": "hesit",
    "digitizer": "digit", "conformabli": "conform", "radicalli": "radic", "differentli": "differ", "vileli": "vile",
    "analogousli": "analog", "vietnamization": "vietnam", "predication": "predic", "operator": "oper",
    "feudalism": "feudal", "decisiveness": "decis", "hopefulness": "hope", "callousness": "callous",
    "formaliti": "formal", "sensitiviti": "sensit", "sensibiliti": "sensibl",
    "triplicate": "triplic", "formative": "form", "formalize": "formal", "electriciti": "electr",
    "electrical": "electr", "hopeful": "hope", "goodness": "good",
    "revival": "reviv", "allowance": "allow", "inference": "infer", "airliner": "airlin", "gyroscopic": "gyroscop",
    "adjustable": "adjust", "defensible": "defens", "irritant": "irrit", "replacement": "replac",
    "adjustment": "adjust", "dependent": "depend", "adoption": "adopt", "homologou": "homolog",
    "communism": "commun", "activate": "activ", "angulariti": "angular", "homologous": "homolog",
    "effective": "effect", "bowdlerize": "bowdler",
    "probate": "probat", "rate": "rate", "cease": "ceas", "controll": "control", "roll": "roll",
    "generalizations": "gener", "oscillators": "oscil",
}
EXTENDED_PAIRS = {
    "caresses": "caress", "flies": "fli", "dies": "die", "mules": "mule", "denied": "deni", "died": "die",
    "agreed": "agre", "owned": "own", "humbled": "humbl", "sized": "size", "meeting": "meet", "stating": "state",
    "siezing": "siez", "itemization": "item", "sensational": "sensat", "traditional": "tradit",
    "reference": "refer", "colonizer": "colon", "plotted": "plot",
    "skies": "sky", "dying": "die", "news": "news", "is": "is", "enjoy": "enjoy", "say": "say", "happy": "happi",
    "geology": "geolog", "ties": "tie", "spied": "spi", "": "",
}


@pytest.mark.parametrize("word, expected", PAPER_PAIRS.items())
def test_paper(word, expected):
    assert stem_word(word, PAPER) == expected


@pytest.mark.parametrize("word, expected", EXTENDED_PAIRS.items())
def test_extended(word, expected):
    assert stem_word(word) == expected


@pytest.mark.parametrize(
    "count, words", [(0, "tr ee tree y by"), (1, "trouble oats trees ivy"), (2, "troubles private oaten orrery")]
)
def test_measure(count, words):
    assert [measure(word) for word in words.split()] == [count] * len(words.split())


def test_lists_keep_order_repeats_empty_and_null():
    lists = pa.array([["cats", "cat", "cats"], [], None, ["dogs", None], ["meeting"]], pa.list_(pa.string()))
    expected = [["cat", "cat", "cat"], [], None, ["dog", None], ["meet"]]
    assert stem_lists(lists, Stems()).to_pylist() == expected
    assert stem_lists(lists.slice(1, 3), Stems()).to_pylist() == expected[1:4]


def test_cache_is_bounded():
    stems = Stems(limit=3)
    assert [stems[w] for w in ("cats", "dogs", "owls", "ants", "cats")] == ["cat", "dog", "owl", "ant", "cat"]
    assert len(stems) <= 3


def test_unknown_mode(spark):
    with pytest.raises(ValueError, match="mode"):
        stem(F.lit("cats"), "other")


def test_stage_and_its_copy_on_disk(spark, tmp_path):
    df = spark.createDataFrame([(["dies", "cats", "cats"],), ([],), (None,)], "w array<string>")
    for mode, first in (("extended", "die"), ("paper", "di")):
        model = PipelineModel([Stemmer(inputCol="w", outputCol="s", mode=mode)])
        model.write().overwrite().save(str(tmp_path / mode))
        for stage in (model, PipelineModel.load(str(tmp_path / mode))):
            assert [r.s for r in stage.transform(df).collect()] == [[first, "cat", "cat"], [], None]


def test_setters(spark):
    stage = Stemmer().setInputCol("w").setOutputCol("s")
    assert (stage.getInputCol(), stage.getOutputCol()) == ("w", "s")
    row = stage.transform(spark.createDataFrame([(["owls"],)], "w array<string>")).first()
    assert row.s == ["owl"]


def test_no_mode_gives_an_empty_stem():
    for mode in (EXTENDED, PAPER):
        assert all(stem_word(word, mode) for word in ("s", "ing", "ed", "es", "y", "e", "ies", "a"))
