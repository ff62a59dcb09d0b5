"""Reading series out of an observations table."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revtide.functions.parsing import as_date

Day = str | datetime.date


def series_filter(df: DataFrame, series_id: str | Sequence[str] | DataFrame) -> DataFrame:
    """Rows of one series, of a list of series, or of the series in a frame.

    A list becomes a set in the filter and reaches the scan; a frame with a column ``series_id``, for
    more series than one would write down, is a semi join.
    """
    if isinstance(series_id, str):
        return df.filter(F.col("series_id") == series_id)
    if isinstance(series_id, DataFrame):
        return df.join(series_id.select("series_id"), "series_id", "left_semi")
    return df.filter(F.col("series_id").isin(list(series_id)))


def date_range(df: DataFrame, start: Day | None = None, end: Day | None = None) -> DataFrame:
    """Rows with start <= date <= end; either end may be open."""
    if start:
        df = df.filter(F.col("date") >= F.lit(as_date(start)))
    if end:
        df = df.filter(F.col("date") <= F.lit(as_date(end)))
    return df


def release_filter(
    df: DataFrame, release_id: int, columns: Sequence[str] = ("series_id", "date", "value")
) -> DataFrame:
    """Chosen columns of the rows of one release."""
    return df.filter(F.col("release_id") == release_id).select(*columns)


def year_month_filter(
    df: DataFrame, year: int, months: Sequence[int],
    columns: Sequence[str] = ("series_id", "date", "value"),
) -> DataFrame:
    """Chosen columns of the rows of some months; prunes directories of a (year, month) layout."""
    picked = (F.col("year") == year) & F.col("month").isin(list(months))
    return df.filter(picked).select(*columns)


def get_series(
    df: DataFrame,
    series_id: str | Sequence[str],
    start: Day | None = None,
    end: Day | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Observations of one or more series by date.

    Sorting comes before projecting, so ``columns`` need not contain the date.
    """
    found = date_range(series_filter(df, series_id), start, end).orderBy("date", "series_id")
    return found.select(*columns) if columns else found


def list_series(df: DataFrame, pattern: str | None = None, limit: int = 100) -> DataFrame:
    """First ``limit`` distinct series ids, sorted; ``pattern`` is a regex in upper case."""
    ids = df.select("series_id")
    if pattern:
        ids = ids.filter(F.col("series_id").rlike(pattern.upper()))
    return ids.distinct().orderBy("series_id").limit(limit)


def search_series(df: DataFrame, pattern: str) -> DataFrame:
    """Series ids that match a pattern, at most 100."""
    return list_series(df, pattern)


def latest_n(df: DataFrame, series_id: str, n: int = 1) -> DataFrame:
    """The newest ``n`` observations of a series."""
    order: list[Column] = [F.desc("date")]
    order += [F.desc(c) for c in ("vintage_date", "release_id") if c in df.columns]
    return series_filter(df, series_id).orderBy(*order).limit(n)


def count_by_series(df: DataFrame, limit: int = 50) -> DataFrame:
    """Series with the most observations."""
    counts = df.groupBy("series_id").agg(F.count("*").alias("count"))
    return counts.orderBy(F.desc("count"), "series_id").limit(limit)


def distinct_series(df: DataFrame) -> DataFrame:
    """All series ids, once each."""
    return df.select("series_id").distinct()


def total_count(df: DataFrame) -> DataFrame:
    """Number of rows, as a one-row frame."""
    return df.agg(F.count("*").alias("total_rows"))


def benchmark_counts(
    df: DataFrame, series_id: str, release_id: int, year: int, months: Sequence[int]
) -> DataFrame:
    """Row counts of the four reference reads: one series, one release, some months, everything."""
    reads = {
        "single_series": series_filter(df, series_id),
        "release": release_filter(df, release_id),
        "time_range": year_month_filter(df, year, months),
        "full_count": df,
    }
    counts = [
        total_count(part).select(F.lit(name).alias("query"), "total_rows")
        for name, part in reads.items()
    ]
    first, *others = counts
    for other in others:
        first = first.unionAll(other)
    return first
