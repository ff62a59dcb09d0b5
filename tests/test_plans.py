"""What the plans look like, and that results do not depend on broadcasting or on skew."""

import re

from frames import D1, V1, V2, V3, log_rows, snapshot
from pyspark.sql import functions as F

from revtide import fixtures as fx
from revtide.operators import layout, observations, quality, selection, vintages
from revtide.operators.changes import (
    change_log,
    detect_changes,
    touched_calendar,
    within_calendar,
)
from revtide.session import scratch_path, shared_dir, stored
from revtide.sources import tables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_limits_groups_before_the_shuffle(spark, sf_dir):
    raw = fx.raw(spark, sf_dir)
    for rows in (observations.dedup_series_date(raw), quality.issue_samples(
            quality.quality_issues(raw, fx.series_metadata(spark, sf_dir)))):
        text = plan(rows)
        assert re.search(r"WindowGroupLimit.*Partial", text)


def test_newest_values_are_hashed_and_combined_before_the_shuffle(spark, sf_dir):
    log = stored(fx.changes(spark, sf_dir))
    text = plan(vintages.latest_vintage(log))
    assert "SortAggregate" not in text and "Window" not in text
    assert text.count("partial_max_by") >= 2


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    rows = stored(fx.snapshots_big(spark, sf_dir))
    text = plan(selection.release_filter(
        selection.date_range(selection.series_filter(rows, "S3"), "1998-01-01"), 9, ["value"]))
    assert "EqualTo(series_id,S3)" in text and "EqualTo(release_id,9)" in text
    assert "GreaterThanOrEqual(date,1998-01-01)" in text
    assert "vintage_date" not in text.split("ReadSchema")[1]


def test_months_and_vintages_prune_directories(spark, sf_dir):
    path = scratch_path(spark, "curated")
    tables.overwrite_by_month(observations.with_year_month(fx.snapshots_big(spark, sf_dir)), path)
    text = plan(selection.year_month_filter(tables.read_table(spark, path), 1999, [1, 2, 3]))
    kept = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", text)[1]
    assert "year" in kept and "month" in kept


def test_a_batch_reads_only_the_vintages_it_needs(spark, sf_dir):
    path = scratch_path(spark, "snapshots")
    rows = fx.snapshots(spark, sf_dir)
    rows.write.partitionBy("vintage_date").parquet(path)
    table = tables.read_table(spark, path, rows.schema)
    touched = table.filter("vintage_date = '2024-02-22'").select("release_id", "vintage_date")
    calendar = touched_calendar(table, touched)
    since = calendar.agg(F.min("vintage_date")).first()[0]
    needed = within_calendar(table, calendar, since)
    assert re.search(r"PartitionFilters: \[.*?vintage_date.* >= ", plan(needed))
    assert {str(r[0]) for r in needed.select("vintage_date").distinct().collect()} == {
        "2024-02-08", "2024-02-15", "2024-02-22"}


def test_top_k_does_not_sort_everything(spark, sf_dir):
    rows = fx.snapshots_big(spark, sf_dir)
    for found in (selection.latest_n(rows, "S3"), selection.count_by_series(rows),
                  selection.list_series(rows)):
        assert "TakeOrderedAndProject" in plan(found)


def test_lookup_sides_are_broadcast_only_when_they_are_small(spark, sf_dir):
    rows = stored(fx.snapshots(spark, sf_dir))
    raw, metadata = stored(fx.raw(spark, sf_dir)), fx.series_metadata(spark, sf_dir)
    assert "BroadcastHashJoin" in plan(change_log(rows))
    expected = log_rows(change_log(rows))
    verdicts = sorted(map(str, quality.release_quality(raw, metadata).collect()))
    key = "spark.sql.autoBroadcastJoinThreshold"
    try:
        spark.conf.set(key, "100")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "100")
        assert "BroadcastHashJoin" not in plan(change_log(rows))
        assert log_rows(change_log(rows)) == expected
        assert sorted(map(str, quality.release_quality(raw, metadata).collect())) == verdicts
    finally:
        spark.conf.unset(key)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_a_hot_point_keeps_its_result(spark):
    cold = [(f"S{i}", D1, v, float(i)) for i in range(20) for v in (V1, V2, V3)]
    once = snapshot(spark, ("HOT", D1, V1, 1.0), ("HOT", D1, V3, 2.0), *cold)
    hot = spark.range(50_000).select(
        F.lit(1).alias("release_id"), F.lit("HOT").alias("series_id"), F.lit(D1).alias("date"),
        F.lit(V3).alias("vintage_date"), F.lit(2.0).alias("value"))
    many = once.unionByName(hot)
    clean = observations.dedup_vintage_key(many, [*vintages.KEY, "vintage_date"])
    assert log_rows(change_log(clean)) == log_rows(change_log(once))
    log = change_log(once.filter(F.col("vintage_date") < F.lit(V3)))
    new = many.filter(F.col("vintage_date") == F.lit(V3))
    expected = once.filter(F.col("vintage_date") == F.lit(V3))
    assert log_rows(detect_changes(log, new, V3)) == log_rows(detect_changes(log, expected, V3))


def test_rows_that_share_all_cluster_columns_are_split(spark):
    hot = spark.range(20_000).select(
        F.lit("HOT").alias("series_id"), F.lit(1).alias("release_id"), "id")
    sizes = [r["n"] for r in layout.cluster(hot, ["series_id", "release_id"], files=8)
             .groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 8 and max(sizes) < 5_000


def test_shared_folder_is_the_configured_one(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_dir(spark) == configured
    assert scratch_path(spark, "a") != scratch_path(spark, "a")
