"""Turning delivered text into typed values. Bad text becomes null, it never fails the job."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# What counts as a number (the marker of a missing value, a lone dot, does not) and the only
# accepted date layout.
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
DATE_LENGTH = 10
DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}$"


def parse_value(text: Column) -> Column:
    """Number behind a value text; the missing marker and unreadable text give null.

    The cast alone would also read a type suffix (``5d``) and ``NaN`` or ``Infinity``, which are no observations
    and would spread through every mean.
    """
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def parse_date(text: Column) -> Column:
    """Date behind a ``yyyy-MM-dd`` text, null when it is not one.

    The cast alone would also read shorter layouts. Guarding it is over twice as fast as parsing
    with a format.
    """
    shaped = (F.length(text) == DATE_LENGTH) & text.rlike(DATE_PATTERN)
    return F.when(shaped, text.try_cast("date"))


def with_parsed_date(df: DataFrame, column: str = "date") -> DataFrame:
    """Parse a date column in place unless it already holds dates."""
    if isinstance(df.schema[column].dataType, StringType):
        return df.withColumn(column, parse_date(F.col(column)))
    return df


def is_blank(text: Column) -> Column:
    """Null or empty text."""
    return text.isNull() | (text == "")


def is_iso_date(text: Column) -> Column:
    """True when the text has the shape of a date; null has not."""
    return F.coalesce(text.rlike(DATE_PATTERN), F.lit(False))


def as_date(value: str | datetime.date | None) -> datetime.date | None:
    """Caller's date argument, checked on the driver so that a typo fails before any job starts."""
    return datetime.date.fromisoformat(value) if isinstance(value, str) else value
