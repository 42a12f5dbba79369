"""Porter stemming of words, and Arrow UDFs that stem whole batches.

``stem_word`` follows the algorithm of Porter (1980). The mode "paper" is that algorithm as published.
The mode "extended" is the default and adds the departures that are in common use in Python text work:
a few irregular words, no change to words of one or two letters, short words in -ies and -ied, y after
a consonant only, -bli, -fulli, -logi and a second pass after -alli, and two-letter stems such as "at"
count as short. The departures are written from their public description and were checked against
published examples, not against another implementation.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# The functions travel to the Python workers with the job, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PAPER = "paper"
EXTENDED = "extended"
MODES = (PAPER, EXTENDED)
# Words of a batch that are stemmed at a time.
SLICE_WORDS = 1 << 18

# Irregular words of the extended mode.
IRREGULAR = {
    "sky": "sky",
    "skies": "sky",
    "dying": "die",
    "lying": "lie",
    "tying": "tie",
    "news": "news",
    "innings": "inning",
    "inning": "inning",
    "outings": "outing",
    "outing": "outing",
    "cannings": "canning",
    "canning": "canning",
    "howe": "howe",
    "proceed": "proceed",
    "exceed": "exceed",
    "succeed": "succeed",
}

# Suffixes and replacements of steps 2, 3 and 4 in the paper.
STEP_2 = {
    "ational": "ate",
    "tional": "tion",
    "enci": "ence",
    "anci": "ance",
    "izer": "ize",
    "abli": "able",
    "alli": "al",
    "entli": "ent",
    "eli": "e",
    "ousli": "ous",
    "ization": "ize",
    "ation": "ate",
    "ator": "ate",
    "alism": "al",
    "iveness": "ive",
    "fulness": "ful",
    "ousness": "ous",
    "aliti": "al",
    "iviti": "ive",
    "biliti": "ble",
}
STEP_3 = {
    "icate": "ic",
    "ative": "",
    "alize": "al",
    "iciti": "ic",
    "ical": "ic",
    "ful": "",
    "ness": "",
}
STEP_4 = (
    "al",
    "ance",
    "ence",
    "er",
    "ic",
    "able",
    "ible",
    "ant",
    "ement",
    "ment",
    "ent",
    "ion",
    "ou",
    "ism",
    "ate",
    "iti",
    "ous",
    "ive",
    "ize",
)
# What the extended mode changes in step 2.
STEP_2_EXTENDED = {**{k: v for k, v in STEP_2.items() if k != "abli"}, "bli": "ble", "fulli": "ful", "logi": "log"}


def _ending(suffixes: Iterable[str]) -> re.Pattern:
    """Finds the longest of ``suffixes`` that ends a word."""
    return re.compile(f"(?:{'|'.join(suffixes)})$")


_ENDING_2 = {PAPER: _ending(STEP_2), EXTENDED: _ending(STEP_2_EXTENDED)}
_RULES_2 = {PAPER: STEP_2, EXTENDED: STEP_2_EXTENDED}
_ENDING_3 = _ending(STEP_3)
_ENDING_4 = _ending(STEP_4)


def sound(word: str) -> str:
    """The word as "c" and "v": y is a vowel after a consonant."""
    kinds = ""
    for letter in word:
        vowel = letter in "aeiou" or (letter == "y" and kinds[-1:] == "c")
        kinds += "v" if vowel else "c"
    return kinds


def measure(part: str) -> int:
    """Number of vowel-consonant changes."""
    return sound(part).count("vc")


def _is_short(part: str, mode: str) -> bool:
    """Ends consonant, vowel, consonant, where the last is not w, x or y."""
    kinds = sound(part)
    if mode == EXTENDED and kinds == "vc":
        return True
    return kinds.endswith("cvc") and part[-1] not in "wxy"


def _plural(word: str, mode: str) -> str:
    if word.endswith("ies") and mode == EXTENDED and len(word) == 4:
        return word[:-1]
    if word.endswith(("sses", "ies")):
        return word[:-2]
    if word.endswith("s") and not word.endswith("ss"):
        return word[:-1]
    return word


def _past(word: str, mode: str) -> str:
    if mode == EXTENDED and word.endswith("ied"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("eed"):
        return word[:-1] if measure(word[:-3]) > 0 else word
    for suffix in ("ed", "ing"):
        part = word.removesuffix(suffix)
        if part != word and "v" in sound(part):
            return _mend(part, mode)
    return word


def _mend(part: str, mode: str) -> str:
    """Repair what is left after -ed or -ing."""
    if part.endswith(("at", "bl", "iz")):
        return part + "e"
    if part[-2:-1] == part[-1] and sound(part)[-1] == "c":
        return part if part[-1] in "lsz" else part[:-1]
    if measure(part) == 1 and _is_short(part, mode):
        return part + "e"
    return part


def _final_y(word: str, mode: str) -> str:
    kinds = sound(word[:-1])
    turns = len(kinds) > 1 and kinds[-1] == "c" if mode == EXTENDED else "v" in kinds
    return word[:-1] + "i" if word.endswith("y") and turns else word


def _double_suffix(word: str, mode: str) -> str:
    found = _ENDING_2[mode].search(word)
    if found is None:
        return word
    suffix, part = found[0], word[: found.start()]
    counted = part + "l" if mode == EXTENDED and suffix == "logi" else part
    if measure(counted) == 0:
        return word
    shorter = part + _RULES_2[mode][suffix]
    return _double_suffix(shorter, mode) if mode == EXTENDED and suffix == "alli" else shorter


def _third(word: str) -> str:
    found = _ENDING_3.search(word)
    if found is None or measure(word[: found.start()]) == 0:
        return word
    return word[: found.start()] + STEP_3[found[0]]


def _fourth(word: str) -> str:
    found = _ENDING_4.search(word)
    if found is None:
        return word
    part = word[: found.start()]
    if measure(part) < 2 or (found[0] == "ion" and part[-1:] not in ("s", "t")):
        return word
    return part


def _tidy(word: str, mode: str) -> str:
    if word.endswith("e"):
        part = word[:-1]
        count = measure(part)
        if count > 1 or (count == 1 and not _is_short(part, mode)):
            word = part
    if word.endswith("ll") and measure(word[:-1]) > 1:
        word = word[:-1]
    return word


def stem_word(word: str, mode: str = EXTENDED) -> str:
    """Stem of one word. A word that would lose all its letters, as "s" in the mode ``paper``, is its own stem."""
    whole = word = word.lower()
    if mode == EXTENDED:
        if word in IRREGULAR:
            return IRREGULAR[word]
        if len(word) <= 2:
            return word
    word = _plural(word, mode)
    word = _past(word, mode)
    word = _final_y(word, mode)
    word = _double_suffix(word, mode)
    word = _third(word)
    word = _fourth(word)
    return _tidy(word, mode) or whole


class Stems(dict):
    """Stems by word, made on first use. Starts over when it holds ``limit`` words."""

    def __init__(self, mode: str = EXTENDED, limit: int = 1 << 18) -> None:
        super().__init__()
        self.mode = mode
        self.limit = limit

    def __missing__(self, word: str) -> str:
        if len(self) >= self.limit:
            self.clear()
        found = self[word] = stem_word(word, self.mode)
        return found


def stem_words(words: pa.Array, stems: Stems) -> pa.Array:
    """Stems of a batch of words, looked up once per distinct word of the batch."""
    coded = words.dictionary_encode()
    found = [None if word is None else stems[word] for word in coded.dictionary.to_pylist()]
    return pa.array(found, pa.string()).take(coded.indices)


def stem_lists(lists: pa.Array, stems: Stems) -> pa.Array:
    """Stems of a batch of word lists: same lists, order, repeats and nulls."""
    words = stem_words(lists.flatten(), stems)
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
    offsets = pa.array(np.concatenate(([0], np.cumsum(lengths))), pa.int32())
    return pa.ListArray.from_arrays(offsets, words, mask=lists.is_null())


def runs(lists: pa.Array, most: int = SLICE_WORDS) -> Iterator[pa.Array]:
    """The lists in runs of about ``most`` words, so that a worker holds the codes and stems of few at a time."""
    ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < len(lists):
        begin = ends[first - 1] if first else 0
        last = max(int(np.searchsorted(ends, begin + most, "right")), first + 1)
        yield lists.slice(first, last - first)
        first = last


def _check(mode: str) -> None:
    if mode not in MODES:
        raise ValueError(f"mode is one of {MODES}, not {mode!r}")


def stem(word: Column, mode: str = EXTENDED) -> Column:
    """Stem of a string column."""
    _check(mode)

    @F.arrow_udf("string")
    def stem_strings(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        stems = Stems(mode)
        for words in batches:
            yield stem_words(words, stems)

    return stem_strings(word)


def stem_all(words: Column, mode: str = EXTENDED) -> Column:
    """Stems of an array<string> column."""
    _check(mode)

    @F.arrow_udf("array<string>")
    def stem_arrays(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        stems = Stems(mode)
        for lists in batches:
            for some in runs(lists):
                yield stem_lists(some, stems)

    return stem_arrays(words)
