"""The release calendar: which vintages of which releases have been merged into the change log.

The log holds changes only, so a vintage that changed nothing is not in it. A merge before such a vintage must
know it all the same: what the merge brings ends there. The calendar has a row for every merged (release, vintage).
It is extended before the log is written. A merge that fails in between is on the calendar without
rows; until it is repeated, its vintage counts as one that changed nothing.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revtide.operators.layout import compact
from revtide.schemas import RELEASE_CALENDAR
from revtide.session import stored
from revtide.sources.tables import append, ensure_table, read_table

SLICE = ["release_id", "vintage_date"]


def calendar_path(log_path: str) -> str:
    """Where the calendar of a log is, unless a caller says otherwise."""
    return f"{log_path.rstrip('/')}_calendar"


def read_calendar(spark: SparkSession, path: str) -> DataFrame:
    """(release_id, vintage_date) of every merged vintage, each once."""
    return read_table(spark, path, RELEASE_CALENDAR).select(*SLICE).distinct()


def ensure_calendar(spark: SparkSession, path: str, log: DataFrame) -> None:
    """Create the calendar unless it is there; one of an older log starts with the vintages that the log names."""
    if ensure_table(spark, path, "release_calendar"):
        extend_calendar(log.select(*SLICE).distinct(), path, None)


def extend_calendar(
    pairs: DataFrame, path: str, etl_run_id: str | None, since: datetime.date | None = None
) -> None:
    """Add the pairs that are not on the calendar yet; ``since`` is their first vintage, if it is known."""
    known = read_calendar(pairs.sparkSession, path)
    if since is not None:
        known = known.filter(F.col("vintage_date") >= F.lit(since))
    missing = pairs.select(*SLICE).distinct().join(known, SLICE, "left_anti")
    stamped = missing.withColumns({
        "processed_at": F.current_timestamp(), "_etl_run_id": F.lit(etl_run_id).cast("string"),
    })
    append(compact(stamped, ["vintage_date"]), path, "release_calendar")


def following_vintages(calendar: DataFrame, scope: DataFrame, day: datetime.date) -> DataFrame:
    """(release_id, following): the next merged vintage of each release of the scope, stored.

    The calendar is partitioned by vintage, so a merge in order finds none and reads no data.
    """
    later = calendar.filter(F.col("vintage_date") > F.lit(day)).join(scope, "release_id", "left_semi")
    return stored(later.groupBy("release_id").agg(F.min("vintage_date").alias("following")), "following")
