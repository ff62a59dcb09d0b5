"""Change detection and vintages on edge cases and random histories."""

import random

from frames import D1, D2, V1, V2, V3, log_rows, snapshot
from pyspark.sql import functions as F

from revtide.operators.changes import (
    change_counts,
    change_log,
    detect_changes,
    extend_log,
    touched_calendar,
    unprocessed_releases,
)
from revtide.operators.vintages import (
    KEY,
    latest_vintage,
    release_state,
    revision_history,
    vintage_as_of,
)


def history(spark, *rows):
    """Snapshot rows next to a second series that keeps every vintage of the release present."""
    anchor = [("ANCHOR", D1, v, 0.0) for v in (V1, V2, V3)]
    return snapshot(spark, *rows, *anchor)


def of(log, series="A"):
    return log_rows(log.filter(F.col("series_id") == series))


def latest(log):
    rows = latest_vintage(log).filter("series_id <> 'ANCHOR'").collect()
    return {(r["series_id"], r["date"]): (r["vintage_date"], r["value"]) for r in rows}


def test_newest_vintage_wins_whatever_the_row_order(spark):
    log = change_log(history(
        spark, ("A", D1, V1, 1.0), ("A", D1, V3, 3.0), ("A", D1, V2, 2.0)
    ))
    assert latest(log) == {("A", D1): (V3, 3.0)}


def test_deleted_point_is_gone_but_known_before(spark):
    log = change_log(history(spark, ("A", D1, V1, 1.0)))
    assert of(log) == [("A", D1, V1, 1.0, "insert"), ("A", D1, V2, None, "delete")]
    assert latest(log) == {}
    known = vintage_as_of(log, V1).filter("series_id = 'A'").collect()
    assert [(r["date"], r["value"]) for r in known] == [(D1, 1.0)]


def test_null_is_a_value(spark):
    unchanged = change_log(history(spark, *(("A", D1, v, None) for v in (V1, V2, V3))))
    assert of(unchanged) == [("A", D1, V1, None, "insert")]
    assert latest(unchanged) == {("A", D1): (V1, None)}
    revised = change_log(history(
        spark, ("A", D1, V1, None), ("A", D1, V2, 2.0), ("A", D1, V3, None)
    ))
    assert [row[-1] for row in of(revised)] == ["insert", "update", "update"]
    removed = change_log(history(spark, ("A", D1, V1, None)))
    assert [row[-1] for row in of(removed)] == ["insert", "delete"]


def test_reinserted_point(spark):
    log = change_log(history(spark, ("A", D1, V1, 1.0), ("A", D1, V3, 1.0)))
    assert [(row[2], row[-1]) for row in of(log)] == [
        (V1, "insert"), (V2, "delete"), (V3, "insert")
    ]


def test_point_deleted_in_one_release_stays_known_by_another(spark):
    rows = snapshot(
        spark, ("A", D1, V1, 1.0, 1), ("B", D1, V1, 1.0, 1), ("B", D1, V2, 1.0, 1),
        ("A", D1, V1, 5.0, 2), ("A", D1, V2, 5.0, 2),
    )
    found = latest_vintage(change_log(rows)).filter("series_id = 'A'").collect()
    assert [(r["value"], r["release_id"]) for r in found] == [(5.0, 2)]


def test_lowest_release_wins_a_tie(spark):
    rows = snapshot(spark, ("A", D1, V1, 1.0, 7), ("A", D1, V1, 2.0, 3))
    found = latest_vintage(change_log(rows)).collect()
    assert [(r["value"], r["release_id"]) for r in found] == [(2.0, 3)]


def test_release_without_new_rows_is_left_alone(spark):
    rows = snapshot(spark, ("A", D1, V1, 1.0, 1), ("B", D1, V1, 1.0, 2))
    log = change_log(rows)
    new = snapshot(spark, ("A", D1, V2, 9.0, 1))
    assert log_rows(detect_changes(log, new, V2)) == [("A", D1, V2, 9.0, "update")]
    assert log_rows(detect_changes(log, new, V2, release_id=1)) == [("A", D1, V2, 9.0, "update")]


def test_duplicates_in_the_new_rows_do_not_multiply(spark):
    new = snapshot(spark, ("A", D1, V1, 1.0), ("A", D1, V1, 1.0))
    empty = change_log(new.limit(0))
    assert log_rows(detect_changes(empty, new, V1)) == [("A", D1, V1, 1.0, "insert")]


def test_counts(spark):
    log = change_log(history(
        spark, ("A", D1, V1, 1.0), ("A", D1, V2, 2.0), ("B", D2, V2, 1.0)
    ))
    assert change_counts(log).first().asDict() == {
        "inserted": 3, "updated": 1, "deleted": 2, "total_changes": 6
    }


def test_revision_history_keeps_deletes(spark):
    log = change_log(history(spark, ("A", D1, V1, 1.0), ("A", D1, V2, 2.0)))
    rows = revision_history(log, "A", D1, with_previous=True).collect()
    assert [(r["vintage_date"], r["value"], r["previous_value"]) for r in rows] == [
        (V1, 1.0, None), (V2, 2.0, 1.0), (V3, None, 2.0)
    ]


def test_unprocessed(spark):
    raw = snapshot(spark, ("A", D1, V1, 1.0, 1), ("A", D1, V2, 1.0, 1), ("A", D1, V2, 1.0, 2))
    done = raw.filter("release_id = 1 AND vintage_date = '2024-02-01'")
    found = {tuple(r) for r in unprocessed_releases(raw, done).collect()}
    assert found == {(1, V2), (2, V2)}


def random_snapshots(spark, seed):
    """Two releases, four series, three dates; points come and go and change, also to null."""
    pick = random.Random(seed)
    rows = []
    for vintage in (V1, V2, V3):
        for release in (1, 2):
            if pick.random() < 0.2:
                continue
            for series in "ABCD":
                for date in (D1, D2):
                    if pick.random() < 0.7:
                        value = pick.choice([None, 1.0, 2.0])
                        rows.append((series, date, vintage, value, release))
    return snapshot(spark, *(rows or [("A", D1, V1, 1.0, 1)]))


def points(df):
    return {(r["release_id"], r["series_id"], r["date"], r["value"])
            for r in df.select(*KEY, "value").collect()}


def test_replaying_the_log_gives_each_snapshot(spark):
    for seed in range(4):
        rows = random_snapshots(spark, seed).cache()
        log = change_log(rows).cache()
        for vintage in (V1, V2, V3):
            day = F.lit(vintage)
            here = rows.filter(F.col("vintage_date") == day)
            state = release_state(log.filter(F.col("vintage_date") <= day))
            state = state.join(here.select("release_id").distinct(), "release_id", "left_semi")
            assert points(state) == points(here)


def test_merging_one_by_one_equals_the_whole_log(spark):
    for seed in range(3):
        rows = random_snapshots(spark, seed).cache()
        whole = change_log(rows)
        log = whole.limit(0)
        for vintage in (V1, V2, V3):
            new = rows.filter(F.col("vintage_date") == F.lit(vintage))
            log = log.unionByName(detect_changes(log, new, vintage))
        assert log_rows(log) == log_rows(whole)


def test_extending_from_the_middle_equals_the_tail_of_the_log(spark):
    rows = random_snapshots(spark, 5).cache()
    touched = rows.filter(F.col("vintage_date") == F.lit(V2)).select(
        "release_id", "vintage_date"
    ).distinct()
    whole = change_log(rows).join(touched.select("release_id"), "release_id", "left_semi")
    tail = whole.filter(F.col("vintage_date") >= F.lit(V2))
    assert log_rows(extend_log(rows, touched)) == log_rows(tail)


def test_touched_calendar_starts_one_vintage_early(spark):
    rows = history(spark, ("A", D1, V1, 1.0))
    touched = spark.createDataFrame([(1, V3)], "release_id int, vintage_date date")
    found = touched_calendar(rows, touched).orderBy("vintage_date").collect()
    assert [(r["vintage_date"], r["is_new"]) for r in found] == [(V2, False), (V3, True)]
