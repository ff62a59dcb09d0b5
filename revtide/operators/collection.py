"""Outcome of a collection run: totals, score, report, recommendations, manifest, batches.

``attempts`` has one row per try: release_id, attempt (higher is later), status ('success' or
'failed'), observations, series, api_calls, qc_valid, qc_warnings, qc_errors, error.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revtide.functions.parsing import as_date

# Fixed values of the score and of the thresholds.
SUCCESS_WEIGHT = 70
QC_WEIGHT = 30
SCORE_BANDS = [(95, "excellent"), (90, "good"), (80, "fair")]
LOWEST_BAND = "poor"
REPORT_LIST_LIMIT = 20
DEFAULT_RELEASES = range(9, 1106)


def final_release_outcome(attempts: DataFrame) -> DataFrame:
    """The last attempt of each release and how many there were."""
    rest = [c for c in attempts.columns if c != "release_id"]
    last = attempts.groupBy("release_id").agg(
        F.max_by(F.struct(*rest), "attempt").alias("_last"), F.count("*").alias("attempts")
    )
    return last.select("release_id", "_last.*", "attempts")


def run_totals(outcomes: DataFrame) -> DataFrame:
    """One row of totals for a run, from the final outcome of each release."""
    good = F.col("status") == "success"
    bad = ~good
    passed = good & F.coalesce(F.col("qc_valid"), F.lit(True))
    retried = F.col("attempts") > 1
    return outcomes.agg(
        F.count("*").alias("total_releases"),
        F.count_if(good).alias("successful"),
        F.count_if(bad).alias("failed"),
        _sum_where(good, "observations").alias("total_observations"),
        _sum_where(good, "series").alias("total_series"),
        _sum_where(F.lit(True), "api_calls").alias("api_calls"),
        F.count_if(passed).alias("qc_passed"),
        F.count_if(good & ~passed).alias("qc_failed"),
        _sum_where(good, "qc_warnings").alias("qc_warnings"),
        _sum_where(good, "qc_errors").alias("qc_errors"),
        _sum_where(F.lit(True), F.col("attempts") - 1).alias("retries_attempted"),
        F.count_if(retried & good).alias("retries_succeeded"),
    )


def quality_score(totals: DataFrame, kept: Sequence[str] = ()) -> DataFrame:
    """Score from 0 to 100 and its band, after the columns ``kept``. A run without releases scores 100, its
    rates are null.
    """
    success = F.try_divide("successful", "total_releases")
    passed = F.try_divide("qc_passed", "successful")
    score = F.when(F.col("total_releases") == 0, F.lit(100.0)).otherwise(
        success * SUCCESS_WEIGHT + F.coalesce(passed, F.lit(0.0)) * QC_WEIGHT
    )
    band = F.lit(LOWEST_BAND)
    for floor, name in reversed(SCORE_BANDS):
        band = F.when(F.col("quality_score") >= floor, name).otherwise(band)
    scored = totals.withColumns({
        "success_rate": success * 100, "qc_pass_rate": passed * 100, "quality_score": score,
    }).withColumn("band", band)
    return scored.select(*kept, "success_rate", "qc_pass_rate", "quality_score", "band")


def recommendations(totals: DataFrame) -> DataFrame:
    """What to look at, one row per recommendation: code, measured number, text."""
    return totals.select(F.inline(_advice()))


def _advice() -> Column:
    """The recommendations of a row of totals, as an array."""
    failure = F.try_divide(F.col("failed") * 100, F.col("failed") + F.col("successful"))
    passed = F.try_divide(F.col("qc_passed") * 100, F.col("successful"))
    warnings = F.col("qc_warnings").cast("double")

    def advice(code: str, number: Column, text: str) -> Column:
        return F.struct(
            F.lit(code).alias("code"), number.alias("measured"), F.lit(text).alias("advice")
        )

    found = F.array_compact(F.array(
        F.when(failure > 10, advice(
            "high_failure_rate", failure, "Many releases failed: check source errors and limits."
        )).when(failure > 5, advice(
            "moderate_failure_rate", failure, "Some releases failed: allow more attempts."
        )),
        F.when(passed < 90, advice(
            "low_qc_pass_rate", passed, "Many releases failed quality control: read the report."
        )),
        F.when((F.col("successful") > 0) & (F.col("qc_warnings") > F.col("successful") * 2), advice(
            "many_qc_warnings", warnings, "Many quality warnings: look for a common cause."
        )),
    ))
    fine = F.array(advice("excellent", F.lit(None).cast("double"), "Nothing to improve."))
    return F.when(F.size(found) > 0, found).otherwise(fine)


def qc_report(outcomes: DataFrame, vintage_date: str | datetime.date) -> DataFrame:
    """The report of a run as one row, with its score and recommendations; its lists hold at most twenty
    releases each, invalid ones with their metrics.
    """
    totals = run_totals(outcomes)
    good = F.col("status") == "success"
    bad = outcomes.filter(~good).orderBy("release_id").limit(REPORT_LIST_LIMIT)
    invalid = outcomes.filter(good & ~F.col("qc_valid")).orderBy("release_id").limit(
        REPORT_LIST_LIMIT
    )
    stacked = totals.unionByName(
        bad.select(F.struct("release_id", "error").alias("_bad")), True
    ).unionByName(
        invalid.select(
            F.struct("release_id", "observations", "series", "qc_errors", "qc_warnings").alias("_invalid")
        ), True,
    )
    merged = stacked.agg(
        *(F.max(c).alias(c) for c in totals.columns),
        F.array_sort(F.collect_list("_bad")).alias("failed_releases"),
        F.array_sort(F.collect_list("_invalid")).alias("qc_issues"),
    )
    return quality_score(merged, merged.columns).select(
        F.lit(as_date(vintage_date)).alias("vintage_date"),
        *totals.columns, "success_rate", "qc_pass_rate", "quality_score", "band",
        _advice().alias("recommendations"),
        (F.try_divide("retries_succeeded", "retries_attempted") * 100).alias("retry_success_rate"),
        F.floor(F.try_divide("total_observations", "successful")).alias("avg_obs_per_release"),
        "failed_releases", "qc_issues",
    )


def run_manifest(outcomes: DataFrame, vintage_date: str | datetime.date) -> DataFrame:
    """Manifest entries: one row of run totals, then one row per release under its final status.

    Written as JSON lines, so a run of any number of releases never becomes one huge document.
    """
    totals = run_totals(outcomes).select(
        F.lit("totals").alias("entry"), F.col("total_releases").alias("releases"),
        "successful", "failed", F.col("total_observations").alias("observations"),
        F.col("total_series").alias("series"), "api_calls", "qc_passed", "qc_failed", "qc_warnings",
        "qc_errors", "retries_attempted", "retries_succeeded",
    )
    lines = outcomes.select(
        F.when(F.col("status") == "success", "success").otherwise("failed").alias("entry"),
        "release_id", F.col("observations").cast("bigint"), F.col("series").cast("bigint"),
        F.col("api_calls").cast("bigint"), "error",
    )
    both = totals.unionByName(lines, True)
    return both.withColumn("vintage_date", F.lit(as_date(vintage_date)))


def release_summary(
    observations: DataFrame, etl_run_id: str, releases: DataFrame | None = None
) -> DataFrame:
    """Release metadata rows that a run writes back: counts, last vintage, status.

    ``releases`` (release_id, vintage_date) adds releases that delivered nothing.
    """
    found = observations.select("release_id", "vintage_date", "series_id", F.lit(1).alias("_rows"))
    if releases is not None:
        found = found.unionByName(releases.select("release_id", "vintage_date", F.lit(0).alias("_rows")), True)
    return found.groupBy("release_id").agg(
        F.count_distinct("series_id").alias("series_count"),
        F.sum("_rows").alias("observations_count"),
        F.max("vintage_date").alias("last_updated_by_source"),
    ).withColumns({
        "release_name": F.concat(F.lit("Release "), F.col("release_id").cast("string")),
        "last_collected": F.current_timestamp(),
        "collection_status": F.lit("success"),
        "_etl_run_id": F.lit(etl_run_id),
    })


def feed_batches(releases: DataFrame, batch_size: int = 5, start_from: int = 0) -> DataFrame:
    """Number releases in order of their id and split them into batches, resuming at an index.

    The position is counted in two steps over 65,536-id ranges: both the ids inside a range and the
    list of ranges are bounded, because an id is a 32-bit int. No window spans the whole list.
    """
    ids = releases.select("release_id").distinct().withColumn(
        "_range", F.shiftright("release_id", 16)
    )
    sizes = ids.groupBy("_range").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_at"))
    inside = Window.partitionBy("_range").orderBy("release_id")
    placed = ids.withColumn("_inside", F.row_number().over(inside) - 1).join(
        F.broadcast(offsets), "_range"
    )
    index = F.col("_at") + F.col("_inside")
    numbered = placed.select("release_id", index.alias("release_index"))
    resumed = numbered.filter(F.col("release_index") >= start_from)
    number = F.floor((F.col("release_index") - start_from) / batch_size) + 1
    return resumed.withColumn("batch_number", number.cast("bigint"))


def _sum_where(condition: Column, column: str | Column) -> Column:
    value = F.col(column) if isinstance(column, str) else column
    return F.coalesce(F.sum(F.when(condition, value)), F.lit(0)).cast("bigint")
