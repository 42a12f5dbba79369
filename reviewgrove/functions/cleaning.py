"""Text cleaning, one function per step, and ``clean_text`` for all of them.

A pattern such as ``\\S*\\d+\\S*`` is tried again from every character of a long run without a digit, which
takes quadratic time: minutes for one line of 80,000 letters. The steps use patterns that match the same
text, but start only where a match can start and never give characters back, so that the time grows with
the length of the text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns of the cleaning steps, in the order of use. Each match becomes one space.
EMAIL = r"\S+@\S+\s"
BREAK = r"\n|\t"
DIGIT_TOKEN = r"\S*\d+\S*"
SINGLE_LETTER = r"\s\W*\w\W*\s"
NON_WORD = r"\W+"
# Fixed value: the text that stands for a missing review.
MISSING = "null"

# What the steps use instead. The first group is what stands in front of the match and stays.
# A token starts after a white space, at the start of the text, or where the last match ended.
_EMAIL_TOKEN = r"(\G|\s)\S[^\s@]*+@\S++\s"
_DIGIT_TOKEN = r"(^|\s)[^\s\d]*+\d\S*+"
# From the last character of a word: marks, then the first white space of the gap, and so on.
_SINGLE_LETTER = r"((?:^|\w)[^\w\s]*+)\s\W*+\w\W*\s"
# A gap, with a one-letter word and the gap behind it if there is one. Every gap becomes a space here,
# so this fits only where NON_WORD follows.
_GAP_WITH_SINGLE_LETTER = r"\s\W*+(?:\w\W*\s)?+"
_DIGIT = r"\d"


def strip_email(text: Column) -> Column:
    """Drop e-mail addresses that a white space follows. One at the very end of the text stays."""
    return F.when(F.contains(text, F.lit("@")), F.regexp_replace(text, _EMAIL_TOKEN, "$1 ")).otherwise(text)


def strip_breaks(text: Column) -> Column:
    """Line breaks and tabs become spaces."""
    return F.translate(text, "\n\t", "  ")


def strip_digit_tokens(text: Column) -> Column:
    """Drop tokens that hold a digit."""
    return F.when(text.rlike(_DIGIT), F.regexp_replace(text, _DIGIT_TOKEN, "$1 ")).otherwise(text)


def strip_single_letters(text: Column) -> Column:
    """Drop one-letter words with white space on both sides.

    A match takes both gaps, so of several in a row every second one stays.
    """
    return F.regexp_replace(text, _SINGLE_LETTER, "$1 ")


def collapse_non_word(text: Column) -> Column:
    """Runs of anything but ASCII letters, digits and underscore become one space."""
    return F.regexp_replace(text, NON_WORD, " ")


STEPS = (strip_email, strip_breaks, strip_digit_tokens, strip_single_letters, collapse_non_word, F.lower)


def _strip_tokens(text: Column) -> Column:
    """The first three steps, but for breaks, which the last pattern takes with every other gap."""
    no_email = strip_email(text)
    return F.when(text.rlike(_DIGIT), strip_digit_tokens(no_email)).otherwise(no_email)


def _strip_single_letters_and_gaps(text: Column) -> Column:
    return F.regexp_replace(_strip_tokens(text), _GAP_WITH_SINGLE_LETTER, " ")


def clean_text(text: Column) -> Column:
    """All steps in order. One-letter words are found together with the gaps around them."""
    return F.lower(collapse_non_word(_strip_single_letters_and_gaps(text)))


def clean_words(text: Column) -> Column:
    """The words of ``clean_text(text)`` as an array, split at the gaps without building the clean text."""
    return F.array_remove(F.split(F.lower(_strip_single_letters_and_gaps(text)), NON_WORD), "")


def fill_missing(text: Column) -> Column:
    """A missing text becomes the word for it. Done after cleaning, so it is a token like any other."""
    return F.coalesce(text, F.lit(MISSING))
