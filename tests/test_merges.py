"""Merges of vintages in any order, again, with rows that have no key, as text and without rows."""

import itertools
import json

import pytest
from frames import D1, D2, V1, V2, V3, day, log_rows, snapshot
from pyspark.sql import functions as F

from revtide.operators.changes import CHANGE_COLUMNS, change_log
from revtide.operators.quality import release_quality
from revtide.operators.vintages import latest_vintage
from revtide.plans import calendar, merge
from revtide.plans.curate import filled_rows
from revtide.plans.vintages import ingest_vintages
from revtide.schemas import RAW
from revtide.sources.raw import land_raw, payload_observations, read_payload_pages
from revtide.warehouse import Warehouse

V4 = day("2024-02-22")


def merged(spark, path, rows, order):
    for vintage in order:
        merge.merge_vintage(spark, rows.filter(F.col("vintage_date") == F.lit(vintage)), vintage, path, "r")
    return merge.read_log(spark, path)


def full(df):
    return sorted(map(tuple, df.select(*CHANGE_COLUMNS).collect()), key=str)


def many(spark):
    """Two releases whose every vintage changes something, and which share a series."""
    rows = [
        ("A", D1, v, float(i), release)
        for release in (1, 2) for i, v in enumerate((V1, V2, V3, V4))
    ]
    rows += [("B", D1, V1, 1.0, 1), ("B", D1, V2, 1.0, 1), ("B", D2, V2, None, 1), ("B", D2, V4, None, 1)]
    rows += [("C", D1, V3, 5.0, 2), ("C", D2, V1, 5.0, 2), ("C", D2, V4, 6.0, 2)]
    frame = snapshot(spark, *rows)
    return frame.withColumn("value_str", F.concat(F.lit("t"), F.col("value").cast("string")))


@pytest.mark.parametrize("order", [(V3, V1, V4, V2), (V4, V3, V2, V1), (V1, V2, V4, V3, V2)])
def test_any_order_gives_the_log_of_one_run(spark, tmp_path, order):
    rows = many(spark)
    log = merged(spark, str(tmp_path / "log"), rows, order)
    assert full(log) == full(change_log(rows))


def test_point_of_a_late_vintage_is_not_the_latest(spark, tmp_path):
    rows = snapshot(spark, ("A", D1, V1, 1.0), ("A", D1, V2, 1.0), ("B", D1, V2, 1.0), ("A", D1, V3, 2.0))
    log = merged(spark, str(tmp_path / "log"), rows, (V1, V3, V2))
    assert [r["series_id"] for r in latest_vintage(log).collect()] == ["A"]


@pytest.mark.parametrize("later", [(V3,), (V3, V4)])
def test_point_of_a_vintage_before_an_unchanged_one_is_not_the_latest(spark, tmp_path, later):
    rows = snapshot(
        spark, ("A", D1, V1, 1.0), ("A", D1, V2, 1.0), ("B", D1, V2, 1.0), *(("A", D1, v, 1.0) for v in later)
    )
    log = merged(spark, str(tmp_path / "log"), rows, (V1, *later, V2))
    assert [r["series_id"] for r in latest_vintage(log).collect()] == ["A"]
    assert full(log) == full(change_log(rows.withColumn("value_str", F.lit(None).cast("string"))))


@pytest.mark.parametrize("order", list(itertools.permutations((V1, V2, V3, V4)))[5::9])
def test_any_order_with_vintages_that_change_nothing(spark, tmp_path, order):
    rows = snapshot(
        spark, *(("A", D1, v, 1.0, r) for v in (V1, V2, V3, V4) for r in (1, 2)), ("B", D1, V2, 5.0),
        ("C", D1, V2, 1.0, 2), ("C", D1, V3, 1.0, 2),
    )
    log = merged(spark, str(tmp_path / "log"), rows, order)
    assert full(log) == full(change_log(rows.withColumn("value_str", F.lit(None).cast("string"))))


def test_calendar_of_an_older_log_starts_with_its_vintages(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = snapshot(spark, ("A", D1, V1, 1.0), ("A", D1, V3, 2.0), ("A", D1, V2, 1.0), ("B", D1, V2, 1.0))
    merge.merge_touched(rows.filter(F.col("vintage_date") != F.lit(V2)), rows.filter(
        F.col("vintage_date") != F.lit(V2)).select("release_id", "vintage_date"), path, "r", calendar=f"{path}_old")
    log = merged(spark, path, rows, (V2,))
    assert [r["series_id"] for r in latest_vintage(log).collect()] == ["A"]
    pairs = calendar.read_calendar(spark, calendar.calendar_path(path)).collect()
    assert sorted(r["vintage_date"] for r in pairs) == [V1, V2, V3]


def test_calendar_holds_each_pair_once(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = snapshot(spark, ("A", D1, V1, 1.0), ("A", D1, V2, 1.0), ("A", D1, V1, 1.0, 2))
    merged(spark, path, rows, (V1, V2, V1, V2))
    whole = spark.read.parquet(calendar.calendar_path(path))
    assert whole.count() == 3 and whole.select("release_id", "vintage_date").distinct().count() == 3


def test_a_delivery_is_read_once_and_counted(spark, tmp_path):
    path = str(tmp_path / "log")
    seen = spark.sparkContext.accumulator(0)

    def look(frames):
        for frame in frames:
            seen.add(len(frame))
            yield frame

    rows = snapshot(spark, ("A", D1, V1, 1.0), ("A", D1, V1, 1.0), (None, D1, V1, 1.0), ("B", D1, V1, 2.0))
    counts = merge.merge_vintage(spark, rows.mapInPandas(look, rows.schema), V1, path, "r")
    assert seen.value == 4
    assert {k: counts[k] for k in ("total_processed", "rejected", "duplicates", "inserted")} == {
        "total_processed": 4, "rejected": 1, "duplicates": 1, "inserted": 2}


def test_repeat_with_other_content_moves_on_to_the_next_vintage(spark, tmp_path):
    path = str(tmp_path / "log")
    merged(spark, path, snapshot(spark, ("A", D1, V1, 1.0), ("A", D1, V2, 2.0)), (V1, V2))
    log = merged(spark, path, snapshot(spark, ("A", D1, V1, 2.0), ("B", D1, V1, 7.0)), (V1,))
    assert log_rows(log) == [
        ("A", D1, V1, 2.0, "insert"), ("B", D1, V1, 7.0, "insert"), ("B", D1, V2, None, "delete")]


def test_rows_without_key_are_counted_and_left_out(spark, tmp_path):
    path = str(tmp_path / "log")
    for vintage in (V1, V2):
        rows = snapshot(spark, ("A", D1, vintage, 1.0), (None, D1, vintage, 1.0), ("A", None, vintage, 1.0))
        counts = merge.merge_vintage(spark, rows, vintage, path, "r")
        assert (counts["rejected"], counts["total_processed"]) == (2, 3)
    assert log_rows(merge.read_log(spark, path)) == [("A", D1, V1, 1.0, "insert")]


def test_text_is_parsed(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = spark.createDataFrame(
        [("A", "2024-01-01", "1.5"), ("A", "2024-01-08", "."), ("A", "2024-1-5", "3")],
        "series_id string, date string, value string",
    )
    counts = merge.merge_vintage(spark, rows, V1, path, "r", release_id=1)
    assert (counts["inserted"], counts["rejected"]) == (2, 1)
    assert full(merge.read_log(spark, path)) == [
        (1, "A", D1, V1, 1.5, "1.5", "insert"), (1, "A", D2, V1, None, ".", "insert")]


@pytest.mark.parametrize("release_id", [None, 1])
def test_merge_without_rows_changes_nothing(spark, tmp_path, release_id):
    path = str(tmp_path / "log")
    merge.merge_vintage(spark, snapshot(spark, ("A", D1, V1, 1.0)), V1, path, "r")
    counts = merge.merge_vintage(spark, snapshot(spark).limit(0), V2, path, "r", release_id)
    assert set(counts.values()) == {0}
    assert log_rows(merge.read_log(spark, path)) == [("A", D1, V1, 1.0, "insert")]


def test_ingest_keeps_the_row_collected_last(spark, tmp_path):
    rows = [("A", "2024-01-01", value, 1, "2024-02-01", at) for value, at in (("9", "a"), ("10", "b"))]
    for i, order in enumerate(itertools.permutations(rows)):
        raw, table = str(tmp_path / f"raw{i}"), str(tmp_path / f"table{i}")
        land_raw(spark.createDataFrame(list(order), RAW), raw)
        ingest_vintages(spark, raw, table)
        kept = spark.read.parquet(table)
        assert [r["value"] for r in kept.collect()] == [10.0]
        assert "collected_at" not in kept.columns


def test_collection_time_defaults_to_the_vintage(spark):
    raw = spark.createDataFrame([("A", "2024-01-01", "1", 1, "2024-02-01", None)], RAW)
    assert filled_rows(raw, "2024-02-01").first()["collected_at"] == "2024-02-01"
    assert filled_rows(raw.drop("collected_at"), "2024-02-01").first()["collected_at"] == "2024-02-01"


def test_broken_page_fails_unless_skipped(spark, tmp_path):
    page = {"release_id": 1, "vintage_date": "2024-02-01", "collected_at": "t", "page": 0, "series": [
        {"series_id": "A", "observations": [{"date": "2024-01-01", "value": "1"}]}]}
    text = json.dumps(page)
    (tmp_path / "pages.json").write_text(text + chr(10) + text[:60] + chr(10))
    path = str(tmp_path / "pages.json")
    with pytest.raises(Exception, match="MALFORMED"):
        payload_observations(read_payload_pages(spark, path)).collect()
    assert payload_observations(read_payload_pages(spark, path, skip_corrupt=True)).count() == 1


def test_merge_touches_only_its_release(spark, tmp_path):
    path = tmp_path / "log"
    merge.merge_vintage(spark, snapshot(spark, ("A", D1, V1, 1.0, 1), ("B", D1, V1, 1.0, 2)), V1, str(path), "r1")
    others = {p: p.stat().st_mtime_ns for p in path.glob(f"vintage_date={V1}/release_id=1/*.parquet")}
    merge.merge_vintage(spark, snapshot(spark, ("B", D1, V1, 5.0, 2)), V1, str(path), "r2")
    assert others == {p: p.stat().st_mtime_ns for p in path.glob(f"vintage_date={V1}/release_id=1/*.parquet")}
    assert [(r[0], r[3]) for r in log_rows(merge.read_log(spark, str(path)))] == [("A", 1.0), ("B", 5.0)]


def test_releases_share_a_series_and_rows_without_release_stay_out(spark, tmp_path):
    raw, table = str(tmp_path / "raw"), str(tmp_path / "snapshots")
    rows = [("A", "2024-01-01", "1", r, "2024-02-01", "t") for r in (1, 2, None)]
    land_raw(spark.createDataFrame(rows, RAW), raw)
    for inserted in (2, 0):
        got = ingest_vintages(spark, raw, table).first()
        assert (got["raw_count"], got["inserted"], got["updated"]) == (3, inserted, 0)
    kept = spark.read.parquet(table).orderBy("release_id").collect()
    assert [(r["series_id"], r["release_id"]) for r in kept] == [("A", 1), ("A", 2)]


def test_release_date_reaches_the_curated_table(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "house"))
    rows = spark.createDataFrame([("A", "2024-01-01", "1", 1, "2024-02-01", "t")], RAW)
    house.land(rows.withColumn("release_date", F.lit("2023-12-31")))
    assert [r["release_date"] for r in house.curate("2024-02-01").collect()] == ["2023-12-31"]


def test_rows_without_release_have_their_own_quality(spark):
    rows = [("A", "2024-01-01", str(i), r, "2024-02-01", "t") for i, r in enumerate((1, None, None))]
    raw = spark.createDataFrame(rows, RAW)
    metadata = spark.createDataFrame([("A", 1), ("Z", 7)], "series_id string, release_id int")
    for releases in (None, raw):
        found = release_quality(raw, metadata, releases).collect()
        assert {r["release_id"]: r["obs_count"] for r in found} == {1: 1, None: 2}
