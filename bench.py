"""Headline queries over tables stored from the test data; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8). The tables the
queries read are written once before the clock starts, as a user's tables would be. Each query
runs once to warm up and three times on the clock; its time is the median.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revtide import fixtures as fx
from revtide.operators import changes, observations, quality, selection, vintages
from revtide.operators import statistics as stats
from revtide.plans import curate, vintages as ingest
from revtide.session import scratch_path
from revtide.sources import tables
from revtide.sources.raw import land_raw

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 3


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def stored(df: DataFrame, name: str) -> DataFrame:
    """A frame written once, in one file per core."""
    path = scratch_path(df.sparkSession, name)
    tables.save(df.repartition(int(CPUS)), path)
    return tables.read_table(df.sparkSession, path, df.schema)


def run(job) -> float:
    """Seconds a job takes; frames are computed in full and thrown away."""
    begin = time.perf_counter()
    result = job()
    if isinstance(result, DataFrame):
        result.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def main() -> None:
    spark = session()
    raw = stored(fx.raw_big(spark, SF_DIR), "raw")
    snapshots = stored(fx.snapshots_big(spark, SF_DIR), "snapshots")
    log = stored(fx.changes_big(spark, SF_DIR), "log")
    events = stored(fx.raw(spark, SF_DIR), "events")
    metadata = stored(fx.series_metadata(spark, SF_DIR), "metadata")
    last = F.lit("2002-04-01").cast("date")
    newest = snapshots.filter(F.col("vintage_date") == last)

    curated_path = scratch_path(spark, "curated")
    tables.overwrite_by_month(observations.with_year_month(snapshots), curated_path)
    curated = tables.read_table(spark, curated_path)
    landing = scratch_path(spark, "landing")
    land_raw(raw, landing)

    jobs = {
        "single_series": lambda: selection.total_count(selection.series_filter(curated, "S3")),
        "one_release": lambda: selection.total_count(selection.release_filter(curated, 10)),
        "one_quarter": lambda: selection.total_count(
            selection.year_month_filter(curated, 1999, [1, 2, 3])
        ),
        "full_count": lambda: selection.total_count(curated),
        "series_coverage": lambda: stats.series_coverage(snapshots),
        "value_statistics": lambda: stats.value_statistics(snapshots),
        "latest_vintage": lambda: vintages.latest_vintage(log),
        "vintage_as_of": lambda: vintages.vintage_as_of(log, "2002-02-15"),
        "detect_changes": lambda: changes.detect_changes(log, newest, "2002-04-01"),
        "change_log": lambda: changes.change_log(snapshots),
        "release_quality": lambda: quality.release_quality(events, metadata),
        "raw_to_curated": lambda: curate.curate(spark, raw, scratch_path(spark, "curated")),
        "ingest_vintages": lambda: ingest.ingest_vintages(
            spark, landing, scratch_path(spark, "snapshots")
        ),
    }
    times = {}
    for name, job in jobs.items():
        run(job)
        times[name] = round(statistics.median(run(job) for _ in range(RUNS)), 4)
    rows = raw.count()
    print(json.dumps({
        "metric": "sum of median query times",
        "value": round(sum(times.values()), 4),
        "unit": "sec",
        "queries": times,
        "sf": Path(SF_DIR).name.removeprefix("sf"),
        "rows": {"raw": rows, "snapshots": snapshots.count(), "change_log": log.count(),
                 "events": events.count()},
        "raw_to_curated_rows_per_sec": round(rows / times["raw_to_curated"]),
        "ingest_rows_per_sec": round(rows / times["ingest_vintages"]),
    }))


if __name__ == "__main__":
    main()
