"""Label and side columns of a review."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The columns that training does not use.
UNUSED_COLUMNS = (
    "asin",
    "image",
    "reviewTime",
    "reviewerID",
    "reviewerName",
    "unixReviewTime",
    "overall",
    "style",
    "summary",
    "verified",
    "vote",
)
# The text for "no votes", the field of the style struct, the date pattern.
NO_VOTE = "none"
STYLE_FIELD = "Format:"
REVIEW_TIME_PATTERN = "MM d, yyyy"


def label(overall: Column) -> Column:
    """Rating as an integer, cut toward zero; also from text such as "5.0". Null where it is no number."""
    return overall.try_cast("double").try_cast("int")


def drop_unused(df: DataFrame) -> DataFrame:
    """Drop the columns that training does not use. Missing ones are no error."""
    return df.drop(*UNUSED_COLUMNS)


def vote_number(vote: Column) -> Column:
    """Votes as a number; null for "none" and for text that is no number."""
    return F.when(vote != NO_VOTE, vote).try_cast("double")


def asin_number(asin: Column) -> Column:
    """Product code as a number where it is one."""
    return asin.try_cast("double")


def style_format(style: Column) -> Column:
    """The format out of the style struct."""
    return style.getField(STYLE_FIELD)


def review_time(text: Column) -> Column:
    """Midnight of the written date; null for other text. Clock time, so no time zone enters."""
    return F.try_to_timestamp(text, F.lit(REVIEW_TIME_PATTERN)).cast("timestamp_ntz")


def epoch_time(seconds: Column) -> Column:
    """Epoch seconds as ``yyyy-MM-dd HH:mm:ss`` text in UTC, whatever the zone of the session."""
    origin = F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    return (origin + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))).cast("string")
