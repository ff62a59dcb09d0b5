"""Reading a change log: newest values, values as known on a day, revisions of one point."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revtide.functions.parsing import as_date

KEY = ["release_id", "series_id", "date"]


def release_state(
    log: DataFrame, release_id: int | None = None, before: datetime.date | None = None
) -> DataFrame:
    """Current value of every (release, series, date), without deleted points.

    The newest row is picked first and dropped afterwards if it is a delete; the other order would
    bring an old value back. All aggregate buffers have a fixed width, so Spark hashes and combines
    them before the shuffle and no key can grow hot.
    """
    if release_id is not None:
        log = log.filter(F.col("release_id") == release_id)
    if before is not None:
        log = log.filter(F.col("vintage_date") < F.lit(before))
    newest = log.groupBy(*KEY).agg(
        F.max_by("value", "vintage_date").alias("value"),
        F.max("vintage_date").alias("vintage_date"),
        F.max_by(F.col("_change_type") == "delete", "vintage_date").alias("_deleted"),
    )
    return newest.filter(~F.col("_deleted")).drop("_deleted")


def latest_vintage(log: DataFrame) -> DataFrame:
    """Newest vintage and value per (series, date).

    A series can belong to several releases: a point deleted in one is still known if another
    release has it. The newest vintage wins, then the lowest release.
    """
    recency = _recency(F.col("vintage_date"), F.col("release_id"))
    return release_state(log).groupBy("series_id", "date").agg(
        F.max("vintage_date").alias("vintage_date"),
        F.max_by("value", recency).alias("value"),
        F.max_by("release_id", recency).alias("release_id"),
    )


def vintage_as_of(log: DataFrame, day: str | datetime.date) -> DataFrame:
    """What ``latest_vintage`` would have returned on that day."""
    return latest_vintage(log.filter(F.col("vintage_date") <= F.lit(as_date(day))))


def revision_history(
    log: DataFrame, series_id: str, date: str | datetime.date, with_previous: bool = False
) -> DataFrame:
    """Every vintage of one point in order, deletes included."""
    point = log.filter(
        (F.col("series_id") == series_id) & (F.col("date") == F.lit(as_date(date)))
    )
    if with_previous:
        window = Window.partitionBy(*KEY).orderBy("vintage_date")
        point = point.withColumn("previous_value", F.lag("value").over(window))
    return point.orderBy("vintage_date", "release_id")


def _recency(vintage: Column, release: Column) -> Column:
    """One sortable long: vintage ascending, then release descending. Releases are 32-bit ints."""
    return F.unix_date(vintage).cast("bigint") * F.lit(1 << 32) - release
