"""Whole jobs on small tables: landing, ingesting, merging, curating, ledgers, streaming."""

import json

import pytest
from frames import D1, D2, V1, V2, V3, log_rows, snapshot
from pyspark.sql import functions as F

from revtide.operators import layout
from revtide.operators.changes import change_log
from revtide.operators.vintages import latest_vintage
from revtide.plans import merge
from revtide.plans.collection import attempts_of, close_run
from revtide.sources import raw as landing
from revtide.sources import tables
from revtide.streaming import events
from revtide.warehouse import Warehouse

RAW = ("series_id string, date string, value string, release_id int, vintage_date string, "
       "collected_at string")


@pytest.fixture
def house(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "house"))


def test_smoke_table(spark, tmp_path):
    values = [3.7, 27500.0, 310.5, 157000.0, 5.33, 4.25, 6.88, 1.085, 13.5, 0.42]
    path = str(tmp_path / "smoke")
    rows = [(i, f"S{i}", "2024-01-01", v) for i, v in enumerate(values, 1)]
    tables.save(spark.createDataFrame(rows, "id int, series_id string, date string, value double"), path)
    table = tables.read_table(spark, path)
    assert table.count() == 10
    updated = layout.update_where(table, F.col("series_id") == "S1", {"value": F.lit(3.8)})
    assert updated.filter("series_id = 'S1'").first()["value"] == 3.8
    assert layout.delete_where(updated, F.col("id") > 7).count() == 7
    assert layout.delete_where(updated, F.lit(None).cast("boolean")).count() == 10


def test_store_release_keeps_log_metadata_and_ledgers(spark, house):
    rows = spark.createDataFrame([("A", "2024-01-01", 1.0), ("B", "2024-01-01", 2.0)],
                                 "series_id string, date string, value double")
    typed = rows.withColumn("date", F.col("date").cast("date"))
    first = house.store_release(typed, 441, "2024-02-01")
    assert (first["inserted"], first["updated"], first["deleted"]) == (2, 0, 0)
    second = house.store_release(typed.filter("series_id = 'A'").withColumn("value", F.lit(9.0)),
                                 441, "2024-02-08")
    assert (second["inserted"], second["updated"], second["deleted"]) == (0, 1, 1)
    again = house.store_release(typed.filter("series_id = 'A'").withColumn("value", F.lit(9.0)),
                                441, "2024-02-08")
    assert (again["updated"], again["deleted"]) == (1, 1)
    assert house.table("series_observations").count() == 4
    assert [(r["vintage_date"], r["value"]) for r in house.latest_vintage("A").collect()] == [(V2, 9.0)]
    assert house.latest_vintage("B").count() == 0
    assert [r["value"] for r in house.vintage_at("B", V1).collect()] == [2.0]
    assert [r["_change_type"] for r in house.revisions("B", D1).collect()] == ["insert", "delete"]
    release = house.table("release_metadata").collect()
    assert [(r["release_id"], r["series_count"], r["collection_status"]) for r in release] == [
        (441, 1, "success")]
    status = house.run_status().collect()
    assert len(status) == 3 and {r["status"] for r in status} == {"success"}
    history = house.history(table="series_observations").collect()
    assert [r["operation"] for r in history] == ["MERGE"] * 3
    assert history[0]["operation_metrics"]["updated"] == 1
    info = {r["metric"]: r["value"] for r in house.info().collect()}
    assert (info["rows"], info["series"], info["columns"]) == (4, 2, 12)
    assert info["files"] >= 2
    empty = house.store_release(typed.limit(0), 441, "2024-02-15")
    assert empty["status"] == "success" and house.table("series_observations").count() == 4
    release = house.table("release_metadata").first()
    assert (release["series_count"], release["observations_count"]) == (0, 0)
    counts = sorted(r["series_count"] for r in house.run_status().collect())
    assert counts == [0, 1, 1, 2]


def test_failure_is_logged_and_raised(spark, house):
    with pytest.raises(Exception):
        house.store_release(spark.createDataFrame([("A",)], "series_id string"), 1, "2024-02-01")
    last = house.run_status().first()
    assert last["status"] == "failed" and last["error_message"]


def raw_rows(spark, *rows):
    return spark.createDataFrame([(s, d, v, r, vin, c) for s, d, v, r, vin, c in rows], RAW)


def test_landing_replaces_only_what_it_brings(spark, house):
    house.land(raw_rows(spark, ("A", "2024-01-01", "1", 1, "2024-02-01", "t"),
                        ("B", "2024-01-01", "1", 2, "2024-02-01", "t")))
    house.land(raw_rows(spark, ("A", "2024-01-01", "7", 1, "2024-02-01", "u")))
    assert sorted((r["series_id"], r["value"]) for r in house.raw("2024-02-01").collect()) == [
        ("A", "7"), ("B", "1")]
    assert house.raw().columns == RAW.replace(" string", "").replace(" int", "").split(", ")


def test_ingest_counts_and_repeats(spark, house):
    house.land(raw_rows(spark, ("A", "2024-01-01", "1", 1, "2024-02-01", "t"),
                        ("A", "2024-01-08", ".", 1, "2024-02-01", "t"),
                        ("A", "bad", "1", 1, "2024-02-01", "t"),
                        ("A", "2024-01-01", "2", 1, "2024-02-08", "t")))
    assert house.unprocessed_releases().count() == 2
    got = house.process_vintage("2024-02-01").first()
    assert (got["raw_count"], got["inserted"], got["updated"]) == (3, 2, 0)
    assert [tuple(r) for r in house.unprocessed_releases().collect()] == [(1, V2)]
    house.land(raw_rows(spark, ("A", "2024-01-01", "5", 1, "2024-02-01", "u"),
                        ("A", "2024-01-08", ".", 1, "2024-02-01", "u")))
    counts = {r["vintage_date"]: (r["inserted"], r["updated"])
              for r in house.process_all_vintages().collect()}
    assert counts == {V1: (0, 1), V2: (1, 0)}
    rows = house.table("snapshots").filter("date = '2024-01-01'").orderBy("vintage_date").collect()
    assert [(r["value"], r["value_str"]) for r in rows] == [(5.0, "5"), (2.0, "2")]
    house.rebuild_log("rebuild")
    log = house.table("series_observations")
    assert [r[2:] for r in log_rows(log)] == [
        (V1, 5.0, "insert"), (V2, 2.0, "update"), (V1, None, "insert"), (V2, None, "delete")]


def test_metadata_upserts(spark, house):
    def meta(*rows):
        return spark.createDataFrame(rows, "series_id string, title string, frequency string")
    house.merge_series_metadata(meta(("A", "old", "D"), ("B", "b", "D")), "r1")
    counts = house.merge_series_metadata(meta(("A", "new", "W"), ("C", "c", "D")), "r2")
    assert (counts["inserted"], counts["updated"], counts["total_processed"]) == (1, 1, 2)
    rows = {r["series_id"]: (r["title"], r["_etl_run_id"]) for r in house.table("series_metadata").collect()}
    assert rows == {"A": ("new", "r2"), "B": ("b", "r1"), "C": ("c", "r2")}


def test_merge_can_empty_a_vintage(spark, tmp_path):
    path = str(tmp_path / "log")
    one = snapshot(spark, ("A", D1, V1, 1.0))
    merge.merge_vintage(spark, one, V1, path, "r1")
    merge.merge_vintage(spark, snapshot(spark, ("A", D1, V2, 2.0)), V2, path, "r2")
    assert merge.merge_vintage(spark, snapshot(spark, ("A", D1, V2, 1.0)), V2, path, "r3") == {
        "inserted": 0, "updated": 0, "deleted": 0, "total_changes": 0, "total_processed": 1}
    assert log_rows(merge.read_log(spark, path)) == [("A", D1, V1, 1.0, "insert")]


def test_merge_keeps_other_releases_of_the_vintage(spark, tmp_path):
    path = str(tmp_path / "log")
    both = snapshot(spark, ("A", D1, V1, 1.0, 1), ("B", D1, V1, 1.0, 2))
    merge.merge_vintage(spark, both, V1, path, "r1")
    merge.merge_vintage(spark, snapshot(spark, ("A", D1, V1, 5.0, 1)), V1, path, "r2", release_id=1)
    assert [(r[0], r[3]) for r in log_rows(merge.read_log(spark, path))] == [("A", 5.0), ("B", 1.0)]


def test_touched_vintages_in_any_order(spark, tmp_path):
    rows = snapshot(spark, ("A", D1, V1, 1.0), ("A", D1, V2, 2.0), ("A", D2, V2, 2.0), ("A", D1, V3, 2.0))
    path = str(tmp_path / "log")
    for vintage in (V3, V1, V2, V2):
        touched = spark.createDataFrame([(1, vintage)], "release_id int, vintage_date date")
        merge.merge_touched(rows, touched, path, "r")
    assert log_rows(merge.read_log(spark, path)) == log_rows(change_log(rows))


def test_stream_equals_batch_and_survives_bad_messages(spark, tmp_path):
    rows = snapshot(spark, ("A", D1, V1, 1.0), ("A", D1, V2, 2.0), ("B", D1, V1, 1.0, 2))
    inbox, log = tmp_path / "inbox", str(tmp_path / "log")
    inbox.mkdir()
    texts = ["not json", '{"release_id": 2, "update_date": "2024-02-01"}',
             '{"release_id": 1, "update_date": "2024-02-08"}', '{"release_id": 1, "update_date": "soon"}',
             '{"release_id": 1, "update_date": "2024-02-01"}']
    for i, text in enumerate(texts):
        (inbox / f"{i}.txt").write_text(text + "\n")
    for _ in range(2):
        bodies = events.read_message_files(spark, str(inbox), files_per_batch=3)
        events.stream_merge(bodies, lambda: rows, log, str(tmp_path / "ckpt")).awaitTermination()
    assert log_rows(merge.read_log(spark, log)) == log_rows(change_log(rows))


def test_payload_pages(spark, house, tmp_path):
    page = {"release_id": 7, "vintage_date": "2024-02-01", "collected_at": "t", "page": 1, "has_more": True,
            "series": [{"series_id": "A", "title": "old", "frequency": "D", "units": "x",
                        "observations": [{"date": "2024-01-01", "value": "."}]}]}
    last = {**page, "page": 2, "has_more": False, "series": [
        {"series_id": "A", "title": "new", "frequency": "D", "units": "x",
         "observations": [{"date": "2024-01-08", "value": "2"}]},
        {"series_id": "E", "title": "empty", "frequency": "D", "units": "x", "observations": []}]}
    (tmp_path / "pages.json").write_text(json.dumps(page) + "\n" + json.dumps(last) + "\n")
    verdicts = house.land_payload(str(tmp_path / "pages.json")).collect()
    assert [(r["release_id"], r["obs_count"], r["is_valid"]) for r in verdicts] == [(7, 2, True)]
    assert sorted(r["value"] for r in house.raw().collect()) == [".", "2"]
    pages = landing.read_payload_pages(spark, str(tmp_path / "pages.json"))
    titles = {r["series_id"]: r["title"] for r in landing.payload_series_metadata(pages).collect()}
    assert titles == {"A": "new", "E": "empty"}
    report = close_run(attempts_of(house.land_payload(str(tmp_path / "pages.json"))), "2024-02-01",
                       str(tmp_path / "run")).first()
    assert (report["total_releases"], report["success_rate"]) == (1, 100.0)


def test_curate_one_release_and_analyse(spark, house):
    house.land(raw_rows(spark, ("A", "2024-01-01", "9", 1, "2024-02-01", "t"),
                        ("A", "2024-02-01", "100", 1, "2024-02-01", "t"),
                        ("B", "2024-01-01", "1", 2, "2024-02-01", "t")))
    curated = house.curate("2024-02-01", release_id=1)
    assert sorted((r["series_id"], r["year"], r["month"]) for r in curated.collect()) == [
        ("A", 2024, 1), ("A", 2024, 2)]
    paths = house.analyse()
    stats = tables.read_table(spark, paths["value_statistics"]).first()
    assert (stats["min_value"], stats["max_value"]) == (9.0, 100.0)
    coverage = tables.read_table(spark, paths["series_coverage"]).first()
    assert (coverage["first_date"], coverage["last_date"]) == (D1, V1)


def test_default_worklist_and_text_file(spark, tmp_path):
    assert landing.read_worklist(spark).count() == 1097
    (tmp_path / "ids.txt").write_text("9\n 11 \n\nx\n11\n")
    found = landing.read_worklist(spark, str(tmp_path / "ids.txt"))
    assert sorted(r[0] for r in found.collect()) == [9, 11]


def test_optimize_keeps_rows_and_narrows_files(spark, house):
    days = spark.range(4000).select(
        F.concat(F.lit("S"), (F.col("id") % 40).cast("string")).alias("series_id"),
        F.date_add(F.lit(D1), (F.col("id") / 40).cast("int")).alias("date"),
        F.lit(1.0).alias("value"), F.lit("1").alias("value_str"), F.lit(V1).alias("vintage_date"),
        F.lit(V1).alias("realtime_start"), F.lit(V1).alias("realtime_end"),
        F.lit(1).alias("release_id"), F.current_timestamp().alias("etl_updated_at"),
    ).orderBy(F.rand(1))
    path = house.path("snapshots")
    tables.append(days, path, "snapshots")
    before = sorted(map(tuple, house.table("snapshots").select("series_id", "date").collect()))
    tables.optimize_table(spark, path, "snapshots", files=16)
    after = house.table("snapshots")
    assert sorted(map(tuple, after.select("series_id", "date").collect())) == before
    ranges = after.groupBy(F.input_file_name()).agg(
        F.count_distinct("series_id").alias("series"), F.count_distinct("date").alias("dates")
    ).collect()
    assert len(ranges) > 8
    assert max(r["series"] for r in ranges) <= 20 and max(r["dates"] for r in ranges) <= 60
    house.optimize(["snapshots", "collection_history"])
    assert house.history(1).first()["operation"] == "OPTIMIZE"
    after = house.table("snapshots")
    assert latest_vintage(change_log(after.dropDuplicates(["series_id", "date"]))).count() == 4000
