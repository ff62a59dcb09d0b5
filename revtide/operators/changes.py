"""Detecting inserts, updates and deletes between vintages of a release.

A point is (release, series, date). Presence decides insert and delete, never the value, because
null is a value that can be stored. Unchanged points produce no row.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from revtide.functions.parsing import as_date, parse_value, with_parsed_date
from revtide.operators.observations import dedup_vintage_key
from revtide.operators.vintages import KEY, release_state
from revtide.session import observed, stored

CHANGE_COLUMNS = [*KEY, "vintage_date", "value", "value_str", "_change_type"]
CHANGE_TYPES = ["insert", "update", "delete"]


def detect_changes(
    log: DataFrame,
    new: DataFrame,
    vintage_date: str | datetime.date,
    release_id: int | None = None,
    scope: DataFrame | None = None,
) -> DataFrame:
    """Change rows that bring the log to the state of ``new``, one vintage of one or more releases.

    The log is read as it was before ``vintage_date``, so repeating a merge gives the same rows. The
    releases with rows in ``new`` are the scope (``scope`` if they are known); a release with no new
    rows at all is left alone, also if ``release_id`` names it. Text is parsed; rows that cannot be
    keyed take no part. Both join sides have one row per point, so the join cannot be skewed.
    """
    day = as_date(vintage_date)
    new = keyed_rows(new, release_id)
    scope = merge_scope(new) if scope is None else scope
    theirs = log.join(scope, "release_id", "left_semi")
    current = release_state(theirs, release_id, before=day)
    return _difference(current, _delivered_state(new)).withColumn(
        "vintage_date", F.lit(day)
    ).select(*CHANGE_COLUMNS)


def following_changes(
    log: DataFrame, new: DataFrame, following: DataFrame, release_id: int | None = None
) -> DataFrame:
    """Change rows of the vintages that follow a late or repeated one, derived again from it.

    What a release holds at its following vintage is in the log as it was before the merge, whether that
    vintage has rows there or changed nothing. Vintages after that one stay as they are.
    """
    new = keyed_rows(new, release_id).join(following, "release_id", "left_semi")
    known = with_value_text(log).join(following, "release_id").filter("vintage_date <= following")
    texts = known.select(*KEY, "vintage_date", "value_str")
    target = release_state(known).join(texts, [*KEY, "vintage_date"]).drop("vintage_date")
    changes = _difference(_delivered_state(new), target).join(following, "release_id")
    return changes.withColumnRenamed("following", "vintage_date").select(*CHANGE_COLUMNS)


def delivery(new: DataFrame, release_id: int | None = None) -> tuple[DataFrame, dict[str, int]]:
    """One row per point of a delivery, typed and stored, and what the delivery held.

    The counts are observed by the job that stores the rows, so ``new`` is read once: ``total_processed``
    rows and, if there are any, those ``rejected`` for want of a release, a series or a date, and ``duplicates``.
    """
    whole, kept = Observation(), Observation()
    typed = typed_rows(new, release_id)
    has_key = F.col("release_id").isNotNull() & F.col("series_id").isNotNull() & F.col("date").isNotNull()
    typed = typed.observe(whole, F.count("*").alias("rows"), F.count_if(has_key).alias("keyed"))
    state = _delivered_state(typed.filter(has_key))
    rows = stored(state.observe(kept, F.count("*").alias("points")), "delivery")
    seen, points = observed(whole), observed(kept)["points"]
    left_out = {"rejected": seen["rows"] - seen["keyed"], "duplicates": seen["keyed"] - points}
    return rows, {"total_processed": seen["rows"], **{name: n for name, n in left_out.items() if n}}


def typed_rows(new: DataFrame, release_id: int | None = None) -> DataFrame:
    """Rows of a delivery with dates and numbers; bad text becomes null and is kept as ``value_str``."""
    if release_id is not None:
        new = new.withColumn("release_id", F.lit(release_id).cast("int"))
    if isinstance(new.schema["value"].dataType, StringType):
        new = new.withColumns({"value_str": F.col("value"), "value": parse_value(F.col("value"))})
    return with_parsed_date(new)


def keyed_rows(new: DataFrame, release_id: int | None = None) -> DataFrame:
    """The typed rows that have a release, a series and a date."""
    return typed_rows(new, release_id).dropna(subset=KEY)


def merge_scope(new: DataFrame) -> DataFrame:
    """The releases in the new rows, stored."""
    return stored(new.select("release_id").distinct(), "scope")


def vintage_calendar(snapshots: DataFrame) -> DataFrame:
    """Vintages of each release and the one that follows. Small: one row per release and vintage."""
    window = Window.partitionBy("release_id").orderBy("vintage_date")
    days = snapshots.select("release_id", "vintage_date").distinct()
    return days.withColumn("next_vintage", F.lead("vintage_date").over(window))


def change_log(snapshots: DataFrame, calendar: DataFrame | None = None) -> DataFrame:
    """The whole change log of many vintages in one job, without a loop over vintages.

    A point that is missing from the release's next vintage is deleted there; one that was missing
    from the previous vintage is inserted. ``snapshots`` holds one row per point and vintage, so a
    window never holds more rows than the release has vintages. A ``calendar`` restricts the job to
    its releases and vintages; with a column ``is_new`` only changes at new vintages come out.
    """
    if calendar is None:
        calendar = stored(vintage_calendar(snapshots), "calendar")
    if "is_new" not in calendar.columns:
        calendar = calendar.withColumn("is_new", F.lit(True))
    known = with_value_text(snapshots).select(*KEY, "vintage_date", "value", "value_str").join(
        calendar, ["release_id", "vintage_date"]
    )
    window = Window.partitionBy(*KEY).orderBy("vintage_date")
    steps = known.withColumns({
        "_expected": F.lag("next_vintage").over(window),
        "_previous": F.lag("value").over(window),
        "_following": F.lead("vintage_date").over(window),
    })
    appeared = ~F.col("_expected").eqNullSafe(F.col("vintage_date"))
    revised = ~F.col("_previous").eqNullSafe(F.col("value"))
    vanished = F.col("next_vintage").isNotNull() & ~F.col("_following").eqNullSafe(
        F.col("next_vintage")
    )
    own = F.when(F.col("is_new") & appeared, _row("vintage_date", "insert")).when(
        F.col("is_new") & revised, _row("vintage_date", "update")
    )
    gone = F.when(vanished, _row("next_vintage", "delete"))
    return steps.select(
        *KEY, F.inline(F.array_compact(F.array(own, gone)))
    ).select(*CHANGE_COLUMNS)


def touched_calendar(snapshots: DataFrame, touched: DataFrame) -> DataFrame:
    """Vintages of the touched releases from their earliest touched one on, and the one before.

    Stored. ``touched`` names (release_id, vintage_date) pairs in any order and with repeats.
    """
    earliest = touched.groupBy("release_id").agg(F.min("vintage_date").alias("_first"))
    first = stored(earliest, "touched")
    theirs = snapshots.join(first.select("release_id"), "release_id", "left_semi")
    calendar = vintage_calendar(theirs).join(first, "release_id")
    is_new = F.col("vintage_date") >= F.col("_first")
    leads_in = F.col("next_vintage") >= F.col("_first")
    calendar = calendar.filter(is_new | leads_in).withColumn("is_new", is_new).drop("_first")
    return stored(calendar, "calendar")


def within_calendar(
    snapshots: DataFrame, calendar: DataFrame, since: datetime.date
) -> DataFrame:
    """Snapshot rows of the calendar's releases and vintages.

    ``since`` is the calendar's first vintage; older directories are not read.
    """
    recent = snapshots.filter(F.col("vintage_date") >= F.lit(since))
    slices = calendar.select("release_id", "vintage_date")
    return recent.join(slices, ["release_id", "vintage_date"], "left_semi")


def extend_log(snapshots: DataFrame, touched: DataFrame) -> DataFrame:
    """Change rows of the touched releases from their earliest touched vintage on.

    The snapshot before that vintage is the starting point, and later vintages are derived again,
    so late or repeated vintages give the same log as one run in order.
    """
    return change_log(snapshots, touched_calendar(snapshots, touched))


def change_counts(changes: DataFrame) -> DataFrame:
    """One row: inserted, updated, deleted and all change rows, from a single pass."""
    counted = {"insert": "inserted", "update": "updated", "delete": "deleted"}
    return changes.agg(
        *(F.count_if(F.col("_change_type") == kind).alias(name) for kind, name in counted.items()),
        F.count("*").alias("total_changes"),
    )


def unprocessed_releases(raw: DataFrame, table: DataFrame) -> DataFrame:
    """(release, vintage) pairs that were landed but are not in the table yet."""
    pair = ["release_id", "vintage_date"]
    landed = raw.select(*pair).distinct()
    return landed.join(table.select(*pair).distinct(), pair, "left_anti")


def with_value_text(df: DataFrame) -> DataFrame:
    """The delivered text, or a null column for tables that never kept it."""
    if "value_str" in df.columns:
        return df
    return df.withColumn("value_str", F.lit(None).cast("string"))


def _delivered_state(new: DataFrame) -> DataFrame:
    """One row per point of a delivery."""
    return dedup_vintage_key(with_value_text(new), KEY).select(*KEY, "value", "value_str")


def _difference(old: DataFrame, new: DataFrame) -> DataFrame:
    """Change rows, without their vintage, that lead from one state of the points to another."""
    joined = new.select(
        *KEY, F.col("value").alias("new_value"), "value_str", F.lit(True).alias("_in_new"),
    ).join(
        old.select(*KEY, F.col("value").alias("old_value"), F.lit(True).alias("_in_old")),
        KEY, "full_outer",
    )
    change = (
        F.when(F.col("_in_old").isNull(), "insert")
        .when(F.col("_in_new").isNull(), "delete")
        .when(~F.col("new_value").eqNullSafe(F.col("old_value")), "update")
    )
    return joined.withColumns({"_change_type": change, "value": F.col("new_value")}).filter(
        F.col("_change_type").isNotNull()
    )


def _row(vintage: str, kind: str) -> Column:
    kept = kind != "delete"
    return F.struct(
        F.col(vintage).alias("vintage_date"),
        (F.col("value") if kept else F.lit(None).cast("double")).alias("value"),
        (F.col("value_str") if kept else F.lit(None).cast("string")).alias("value_str"),
        F.lit(kind).alias("_change_type"),
    )
