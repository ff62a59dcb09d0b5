"""Coverage, time distribution, release and value statistics.

Distinct counts are planned by Spark as a grouping by the counted column first, which combines
before every shuffle; no series or release is gathered into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

VOLATILE_MIN_OBS = 100


def series_coverage(df: DataFrame) -> DataFrame:
    """First and last date, number of observations and of releases per series."""
    return df.groupBy("series_id").agg(
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.count("*").alias("observation_count"),
        F.count_distinct("release_id").alias("release_count"),
    )


def top_covered_series(coverage: DataFrame, n: int = 10) -> DataFrame:
    """Series with the most observations."""
    return coverage.orderBy(F.desc("observation_count"), "series_id").limit(n)


def temporal_distribution(df: DataFrame) -> DataFrame:
    """Observations and series per (year, month), in order. Needs the two columns."""
    return df.groupBy("year", "month").agg(
        F.count("*").alias("observation_count"),
        F.count_distinct("series_id").alias("unique_series"),
    ).orderBy("year", "month")


def recent_months(distribution: DataFrame, since: int = 2020, n: int = 12) -> DataFrame:
    """The last ``n`` months that have data, from year ``since`` on."""
    recent = distribution.filter(F.col("year") >= since)
    return recent.orderBy(F.desc("year"), F.desc("month")).limit(n)


def release_statistics(df: DataFrame) -> DataFrame:
    """Series, observations and date span per release, most series first."""
    return df.groupBy("release_id").agg(
        F.count_distinct("series_id").alias("series_count"),
        F.count("*").alias("observation_count"),
        F.min("date").alias("earliest_data"),
        F.max("date").alias("latest_data"),
    ).orderBy(F.desc("series_count"), "release_id")


def top_releases(statistics: DataFrame, n: int = 5) -> DataFrame:
    """Releases with the most series."""
    return statistics.orderBy(F.desc("series_count"), "release_id").limit(n)


def value_statistics(df: DataFrame) -> DataFrame:
    """Descriptive statistics of the numeric values per series; ``n_obs`` counts null values too."""
    return df.groupBy("series_id").agg(
        F.count("*").alias("n_obs"),
        F.avg("value").alias("mean_value"),
        F.stddev_samp("value").alias("stddev_value"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
    )


def volatile_series(
    statistics: DataFrame, min_obs: int = VOLATILE_MIN_OBS, n: int = 10
) -> DataFrame:
    """Series with the highest standard deviation relative to their mean."""
    usable = statistics.filter(
        F.col("stddev_value").isNotNull()
        & (F.col("mean_value") != 0)
        & (F.col("n_obs") > min_obs)
    )
    cv = F.try_divide("stddev_value", "mean_value")
    return usable.withColumn("cv", cv).orderBy(F.desc("cv"), "series_id").limit(n)


def statistics_states(df: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """What the statistics of a table need to know of each partition, per series and release.

    States of different partitions add up: counts and extremes as they are, means and sums of squared deviations
    (``m2``) pairwise. Series and release are the key, so distinct counts stay exact.
    """
    return df.groupBy(*partitions, *[c for c in ("series_id", "release_id") if c not in partitions]).agg(
        F.count("*").alias("rows"), F.count("value").alias("values"), F.avg("value").alias("mean"),
        (F.var_pop("value") * F.count("value")).alias("m2"), F.min("value").alias("least"),
        F.max("value").alias("greatest"), F.min("date").alias("first_date"), F.max("date").alias("last_date"),
    )


def coverage_of_states(states: DataFrame) -> DataFrame:
    """``series_coverage`` of the rows behind the states."""
    return states.groupBy("series_id").agg(
        F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date"),
        F.sum("rows").alias("observation_count"), F.count_distinct("release_id").alias("release_count"),
    )


def release_statistics_of_states(states: DataFrame) -> DataFrame:
    """``release_statistics`` of the rows behind the states."""
    return states.groupBy("release_id").agg(
        F.count_distinct("series_id").alias("series_count"), F.sum("rows").alias("observation_count"),
        F.min("first_date").alias("earliest_data"), F.max("last_date").alias("latest_data"),
    ).orderBy(F.desc("series_count"), "release_id")


def value_statistics_of_states(states: DataFrame) -> DataFrame:
    """``value_statistics`` of the rows behind the states, up to rounding.

    Squared deviations from the common mean are those within each state plus those of the states' means,
    which loses no digits where values are large against their spread. A series has a state per partition and
    release, so its window is small.
    """
    series = Window.partitionBy("series_id")
    count = F.sum("values").over(series)
    # One state's mean is subtracted first, so that the common mean is as exact as the states'.
    base = F.max("mean").over(series)
    offset = F.try_divide(F.sum(F.col("values") * (F.col("mean") - base)).over(series), count)
    away = F.col("mean") - base - offset
    known = states.withColumns({
        "_mean": base + offset, "_spread": F.col("m2") + F.col("values") * away * away,
    })
    summed = known.groupBy("series_id").agg(
        F.sum("rows").alias("n_obs"), F.max("_mean").alias("mean_value"),
        F.sum("_spread").alias("_spread"), F.sum("values").alias("_values"),
        F.min("least").alias("min_value"), F.max("greatest").alias("max_value"),
    )
    deviation = F.when(F.col("_values") > 1, F.sqrt(F.col("_spread") / (F.col("_values") - 1)))
    return summed.select(
        "series_id", "n_obs", "mean_value", deviation.alias("stddev_value"), "min_value", "max_value"
    )
