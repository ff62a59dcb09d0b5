"""Merging into the change log: one vintage at a time or whatever a batch touched.

The log is partitioned by vintage and release, or by vintage and bucket of the release once there are many. A merge
replaces the (release, vintage) slices it derives and touches no other directories, so repeating it changes nothing. A delivery is read once, into a stored table
of its points, and counted by the job that stores it. Each merge derives its rows once, in the job that writes them,
and counts them afterwards in the log. What was merged is on the release calendar, so that a late merge finds the
vintage it ends at.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revtide.functions.parsing import as_date
from revtide.operators.changes import (
    change_counts,
    change_log,
    delivery,
    detect_changes,
    following_changes,
    merge_scope,
    touched_calendar,
    within_calendar,
)
from revtide.operators.layout import compact
from revtide.operators.ledger import conform
from revtide.operators.observations import dedup_vintage_key
from revtide.operators.vintages import KEY
from revtide.plans.calendar import (
    SLICE,
    calendar_path,
    ensure_calendar,
    extend_calendar,
    following_vintages,
    read_calendar,
)
from revtide.schemas import BUCKET, SERIES_OBSERVATIONS
from revtide.sources.mutation import with_neighbours
from revtide.sources.tables import (
    BY_BUCKET,
    ensure_table,
    in_layout,
    overwrite_touched,
    read_table,
    release_bucket,
    remove,
    slice_layout,
)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The change log."""
    return read_table(spark, path, SERIES_OBSERVATIONS).select(*SERIES_OBSERVATIONS.names)


def _log_of(spark: SparkSession, path: str, scope: DataFrame) -> DataFrame:
    """The change log, at least the rows of the releases in scope; of a log in buckets only theirs are read."""
    rows = read_table(spark, path, SERIES_OBSERVATIONS)
    if BUCKET in rows.columns:
        buckets = [r[0] for r in scope.select(release_bucket()).distinct().collect()]
        rows = rows.filter(F.col(BUCKET).isin(buckets))
    return rows.select(*SERIES_OBSERVATIONS.names)


def merge_vintage(
    spark: SparkSession,
    new: DataFrame,
    vintage_date: str | datetime.date,
    log_path: str,
    etl_run_id: str,
    release_id: int | None = None,
    api_version: str = "v2", calendar: str | None = None,
) -> dict[str, int]:
    """Merge one vintage of one or more releases into the log; returns the change counts.

    Vintages may come in any order and again with other content: where the ``calendar`` (a path, by default
    beside the log) goes on after this vintage, the next one of each release is derived again, also if
    it had changed nothing. Rows without release, series or date are left out and counted as ``rejected``, rows of
    a point besides the one that counts as ``duplicates``. Releases without any other row are left alone.
    """
    ensure_table(spark, log_path, "series_observations")
    calendar = calendar or calendar_path(log_path)
    day = as_date(vintage_date)
    log = read_log(spark, log_path)
    ensure_calendar(spark, calendar, log)
    points, total = delivery(new, release_id)
    scope = merge_scope(points)
    if scope.isEmpty():
        return {**change_counts(log.limit(0)).first().asDict(), **total}
    partitions = slice_layout(spark, log_path, scope, SERIES_OBSERVATIONS)
    log = _log_of(spark, log_path, scope)
    changes = detect_changes(log, points, day, scope=scope)
    slices = scope.withColumn("vintage_date", F.lit(day))
    on_day = replaced = F.col("vintage_date") == F.lit(day)
    following = following_vintages(read_calendar(spark, calendar), scope, day)
    extend_calendar(slices, calendar, etl_run_id, day)
    if not following.isEmpty():
        changes = changes.unionByName(following_changes(log, points, following))
        slices = slices.unionByName(following.withColumnRenamed("following", "vintage_date"))
        replaced = F.col("vintage_date") >= F.lit(day)
    stamp = _replace_slices(spark, changes, slices, replaced, log_path, partitions, etl_run_id, api_version)
    written = _log_of(spark, log_path, scope).filter(on_day & (F.col("last_updated") == stamp)).join(
        scope, "release_id", "left_semi"
    )
    return {**change_counts(written).first().asDict(), **total}


def merge_touched(
    snapshots: DataFrame, touched: DataFrame, log_path: str, etl_run_id: str,
    api_version: str = "v2", calendar: str | None = None,
) -> None:
    """Bring the log up to date for the touched (release, vintage) pairs, in whatever order.

    The snapshots hold every vintage in full, so they name the vintages to derive; these go on the log's calendar.
    """
    spark = snapshots.sparkSession
    merged_path = calendar or calendar_path(log_path)
    calendar = touched_calendar(snapshots, touched)
    since, first_new = calendar.agg(
        F.min("vintage_date"), F.min(F.when(F.col("is_new"), F.col("vintage_date")))
    ).first()
    if first_new is None:
        return
    ensure_table(spark, log_path, "series_observations")
    rows = within_calendar(snapshots, calendar, since)
    changes = change_log(dedup_vintage_key(rows, [*KEY, "vintage_date"]), calendar)
    slices = calendar.filter("is_new").select(*SLICE)
    ensure_calendar(spark, merged_path, read_log(spark, log_path))
    extend_calendar(slices, merged_path, etl_run_id, first_new)
    recent = F.col("vintage_date") >= F.lit(first_new)
    partitions = slice_layout(spark, log_path, slices, SERIES_OBSERVATIONS)
    _replace_slices(spark, changes, slices, recent, log_path, partitions, etl_run_id, api_version)


def _replace_slices(
    spark: SparkSession, changes: DataFrame, slices: DataFrame, pruning: Column, path: str,
    partitions: list[str], etl_run_id: str, api_version: str,
) -> Column:
    """Replace slices by change rows; ``pruning`` holds for all their vintages. Other rows of shared directories stay.

    Returns the time stamp of the new rows, as a column to compare with.
    """
    stamp = F.lit(datetime.datetime.now().astimezone())
    stamped = changes.withColumns({
        "realtime_start": F.col("vintage_date"),
        "realtime_end": F.col("vintage_date"),
        "last_updated": stamp,
        "_etl_run_id": F.lit(etl_run_id),
        "_source_api_version": F.lit(api_version),
    })
    rows = conform(stamped, SERIES_OBSERVATIONS)
    if partitions == BY_BUCKET:
        rows = with_neighbours(rows, path, slices, SERIES_OBSERVATIONS)
    laid_out = compact(rows, partitions).sortWithinPartitions(*partitions, "release_id", "series_id", "date")
    overwrite_touched(laid_out, path, partitions)
    _remove_left_over(spark, slices, pruning, path, partitions, stamp)
    return stamp


def _remove_left_over(
    spark: SparkSession, slices: DataFrame, pruning: Column, path: str, partitions: list[str], stamp: Column
) -> None:
    """Remove the directories whose slices should have no row any more.

    Overwriting by touched partition cannot empty one. A replaced slice with rows of another time
    stamp gives it away. It takes a correction that took back every change of a release's vintage; only
    directory names reach the driver, one at a time.
    """
    old = read_log(spark, path).filter(pruning & (F.col("last_updated") != stamp))
    left = in_layout(old.join(slices, SLICE, "left_semi"), partitions).select(*partitions).distinct()
    for values in left.toLocalIterator():
        remove(spark, "/".join([path, *(f"{name}={value}" for name, value in zip(partitions, values))]))
