"""Landing payload pages with their quality control, and closing a run with its report."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from revtide.operators.collection import final_release_outcome, qc_report, run_manifest
from revtide.operators.quality import release_quality
from revtide.session import observed
from revtide.sources.raw import (
    judged_payload_pages,
    land_raw,
    payload_observations,
    payload_series_metadata,
    read_payload_pages,
)
from revtide.sources.tables import save_json


def land_payload(spark: SparkSession, pages_path: str, raw_path: str) -> DataFrame:
    """Land all observations of the pages and return the quality of each release.

    Rows are landed whatever the verdict is; the gate stands in front of the curated table.
    """
    return land_payload_counted(spark, pages_path, raw_path)[0]


def land_payload_counted(
    spark: SparkSession, pages_path: str, raw_path: str, skip_corrupt: bool = False
) -> tuple[DataFrame, dict[str, int]]:
    """``land_payload`` and what its job counted: ``lines`` of the files and those ``skipped`` as no page.

    A line that is no page fails the job unless ``skip_corrupt`` is set.
    """
    seen = Observation()
    if skip_corrupt:
        judged = judged_payload_pages(spark, pages_path)
        watched = judged.observe(seen, F.count("*").alias("lines"), F.count_if(~F.col("is_page")).alias("skipped"))
        pages, landed = (d.filter("is_page").drop("is_page") for d in (judged, watched))
    else:
        pages = read_payload_pages(spark, pages_path)
        landed = pages.observe(seen, F.count("*").alias("lines"), F.lit(0).alias("skipped"))
    land_raw(payload_observations(landed), raw_path)
    counts = {name: observed(seen)[name] for name in ("lines", "skipped")}
    return release_quality(payload_observations(pages), payload_series_metadata(pages), pages), counts


def attempts_of(quality: DataFrame, attempt: int = 1, pages: DataFrame | None = None) -> DataFrame:
    """Release quality as rows of collection attempts that succeeded.

    Every page took a call to the source; without ``pages`` their number is unknown.
    """
    if pages is None:
        quality = quality.withColumn("api_calls", F.lit(None).cast("bigint"))
    else:
        calls = pages.groupBy(F.col("release_id").alias("_of")).agg(F.count("*").alias("api_calls"))
        quality = quality.join(calls, quality["release_id"].eqNullSafe(calls["_of"]), "left").drop("_of")
    return quality.select(
        "release_id", F.lit(attempt).cast("bigint").alias("attempt"),
        F.lit("success").alias("status"),
        F.col("obs_count").alias("observations"), F.col("series_count").alias("series"),
        "api_calls", F.col("is_valid").alias("qc_valid"),
        "qc_warnings", "qc_errors", F.lit(None).cast("string").alias("error"),
    )


def close_run(
    attempts: DataFrame, vintage_date: str | datetime.date, path: str, started_at: datetime.datetime | None = None
) -> DataFrame:
    """Save manifest and report of a run as JSON lines and return the report.

    With the time it started, the report says how long the run took, up to the report itself.
    """
    outcomes = final_release_outcome(attempts)
    save_json(run_manifest(outcomes, vintage_date), f"{path}/manifest")
    report = qc_report(outcomes, vintage_date)
    if started_at is not None:
        now = datetime.datetime.now(started_at.tzinfo)
        report = report.withColumns({
            "started_at": F.lit(started_at), "duration_seconds": F.lit((now - started_at).total_seconds()),
        })
    save_json(report, f"{path}/qc_report")
    return attempts.sparkSession.read.json(f"{path}/qc_report")
