"""Messages that cannot be merged are kept and counted, once however often a batch runs."""

import time

import pytest
from frames import D1, V1, V2, log_rows, snapshot
from pyspark.sql import functions as F

from revtide.plans import merge
from revtide.streaming import events

BODIES = [
    '{"release_id": 1, "update_date": "2024-02-01"}', "not json", None, "", '{"update_date": "2024-02-01"}',
    '{"release_id": 1, "update_date": "2024-2-1"}', '{"release_id": "one", "update_date": "2024-02-01"}', "[1]",
    '{"release_id": 1}', '{"release_id": 2, "update_date": "2024-02-08", "more": 1}',
]
REASONS = [None, "unreadable", "unreadable", "unreadable", "no_release", "no_date", "unreadable", "unreadable",
           "no_date", None]


def test_reasons(spark):
    frame = spark.createDataFrame([(i, b) for i, b in enumerate(BODIES)], "n int, body string")
    found = {r["n"]: r["reason"] for r in events.judged_messages(frame).collect()}
    assert [found[i] for i in range(len(BODIES))] == REASONS
    assert events.touched_slices(events.judged_messages(frame)).count() == 2


@pytest.fixture
def counts(spark):
    listener = events.MessageCounts()
    spark.streams.addListener(listener)
    yield listener
    spark.streams.removeListener(listener)


def test_dead_letters_and_merged_are_all_bodies(spark, tmp_path, counts):
    source, log = str(tmp_path / "in"), str(tmp_path / "log")
    given = [b for b in BODIES if b]
    rows = snapshot(spark, ("A", D1, V1, 1.0), ("B", D1, V2, 2.0, 2))
    data = str(tmp_path / "snapshots")
    rows.write.parquet(data)

    def run(bodies, checkpoint):
        spark.createDataFrame([(b,) for b in bodies], "value string").coalesce(1).write.mode("append").text(source)
        events.stream_merge(
            events.read_message_files(spark, source, positions=True), lambda: spark.read.schema(rows.schema).parquet(data),
            log, str(tmp_path / checkpoint),
        ).awaitTermination()

    run(given, "checkpoint")
    letters = f"{log}_dead_letters"
    bad = events.read_letters(spark, letters).collect()
    assert sorted(r["reason"] for r in bad) == sorted(r for b, r in zip(BODIES, REASONS) if b and r)
    assert all(r["batch_id"] == 0 and r["source"].startswith("file:") and r["position"] is not None for r in bad)
    batches = events.read_batches(spark, letters).agg(F.sum("messages"), F.sum("merged"), F.sum("letters")).first()
    assert tuple(batches) == (len(given), 2, len(bad))
    assert log_rows(merge.read_log(spark, log)) == [("A", D1, V1, 1.0, "insert"), ("B", D1, V2, 2.0, "insert")]
    for _ in range(50):
        if counts.merged:
            break
        time.sleep(0.2)
    assert (counts.merged, counts.letters) == (2, len(bad))
    # The same batch again, as after a failure before its checkpoint: kept once.
    run([], "another")
    assert events.read_letters(spark, letters).count() == len(bad)
    assert events.read_batches(spark, letters).count() == 1


def test_no_dead_letters(spark, tmp_path):
    source, log = str(tmp_path / "in"), str(tmp_path / "log")
    spark.createDataFrame([(BODIES[0],)], "value string").write.text(source)
    rows = snapshot(spark, ("A", D1, V1, 1.0))
    events.stream_merge(
        events.read_message_files(spark, source), lambda: rows, log, str(tmp_path / "checkpoint")
    ).awaitTermination()
    assert events.read_letters(spark, f"{log}_dead_letters").count() == 0
    assert log_rows(merge.read_log(spark, log)) == [("A", D1, V1, 1.0, "insert")]
