"""Many releases share directories; what a table holds does not depend on it."""

import os

import pytest
from frames import D1, D2, V1, V2, V3, snapshot
from pyspark.sql import functions as F

from revtide import fixtures as fx
from revtide.plans import merge
from revtide.plans.vintages import ingest_vintages, read_snapshots
from revtide.schemas import RAW, SNAPSHOTS
from revtide.sources import tables
from revtide.sources.raw import delivered_columns, land_raw, read_raw
from revtide.warehouse import Warehouse

MANY = tables.MOST_RELEASES + 88


def leaves(path):
    return {os.path.relpath(d, path) for d, _, names in os.walk(path)
            if d != str(path) and any(n.endswith(".parquet") for n in names)}


def raw_rows(spark, releases, *vintages, value="1"):
    days = F.explode(F.array(*[F.lit(v) for v in vintages]))
    return spark.range(releases).select(
        F.lit("A").alias("series_id"), F.lit("2024-01-01").alias("date"), F.lit(value).alias("value"),
        F.col("id").cast("int").alias("release_id"), days.alias("vintage_date"), F.lit("t").alias("collected_at"))


@pytest.fixture(params=["few", "many", "growing"])
def layouts(request, monkeypatch):
    """A function to call between writes: releases have directories, share them from the first write or the second."""
    if request.param == "many":
        monkeypatch.setattr(tables, "MOST_RELEASES", 0)
    return lambda: request.param == "growing" and monkeypatch.setattr(tables, "MOST_RELEASES", 0)


def test_directories_do_not_grow_with_releases(spark, tmp_path):
    raw, table, log, added = (str(tmp_path / n) for n in ("raw", "snapshots", "log", "added"))
    rows = raw_rows(spark, MANY, "2024-02-01", "2024-02-08").repartition(8)
    land_raw(rows, raw)
    counts = ingest_vintages(spark, raw, table).collect()
    assert [(r["raw_count"], r["inserted"]) for r in counts] == [(MANY, MANY)] * 2
    assert [r["inserted"] for r in ingest_vintages(spark, raw, table).collect()] == [0, 0]
    known = read_snapshots(spark, table)
    merge.merge_touched(known, known.select("release_id", "vintage_date"), log, "r")
    assert merge.read_log(spark, log).count() == MANY
    changes = merge.read_log(spark, log).repartition(8)
    tables.append(changes, added, "series_observations")
    assert merge.read_log(spark, added).count() == MANY
    for path in (raw, table, log, added):
        assert len(leaves(path)) <= 2 * tables.RELEASE_BUCKETS
    assert sum(len([n for n in names if n.endswith(".parquet")]) for _, _, names in os.walk(added)) < 160


def test_landing_replaces_releases_and_keeps_their_neighbours(spark, tmp_path, layouts, monkeypatch):
    monkeypatch.setattr(tables, "RELEASE_BUCKETS", 2)
    path = str(tmp_path / "raw")
    first = [(f"S{i}", "2024-01-01", "1", r, v, "t") for r in (1, 2, 3, None) for i in (1, 2) for v in ("2024-02-01", "x", None)]
    land_raw(spark.createDataFrame(first, RAW), path)
    layouts()
    again = [("S9", "2024-01-01", "7", r, v, "t") for r, v in ((2, "2024-02-01"), (None, "x"), (3, None), (4, ""))]
    land_raw(spark.createDataFrame(again, RAW).withColumn("release_date", F.lit("d")), path)
    replaced = {(r, v) for _, _, _, r, v, _ in again}
    expected = [row for row in first if (row[3], row[4]) not in replaced] + [(*row[:4], row[4] or None, row[5]) for row in again]
    assert sorted(map(str, map(tuple, read_raw(spark, path).collect()))) == sorted(map(str, expected))


def test_delivered_columns_outlive_a_change_of_layout(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "raw")
    land_raw(raw_rows(spark, 3, "2024-02-01"), path)
    tables.overwrite_touched(raw_rows(spark, 3, "2024-02-08").drop("value"), path, tables.BY_RELEASE)
    monkeypatch.setattr(tables, "MOST_RELEASES", 0)
    land_raw(raw_rows(spark, 3, "2024-02-15"), path)
    assert {d.split("/")[1].split("=")[0] for d in leaves(path)} == {"_bucket"}
    assert set(RAW.names) == set(delivered_columns(spark, path))
    assert set(RAW.names) - set(delivered_columns(spark, path, "2024-02-08")) == {"value"}
    assert read_raw(spark, path).count() == 9


def test_merges_in_any_order_give_one_log(spark, tmp_path, layouts, monkeypatch):
    monkeypatch.setattr(tables, "RELEASE_BUCKETS", 2)
    path = str(tmp_path / "log")
    merges = [
        (V1, [("A", D1, V1, 1.0, r) for r in range(5)]), (V3, [("A", D1, V3, 3.0, r) for r in range(5)]),
        (V2, [("B", D2, V2, 2.0, r) for r in (1, 3)]), (V3, [("A", D1, V3, 1.0, 0), ("A", D1, V3, 4.0, 4)]),
        (V1, [("A", D1, V1, 3.0, 2)]),
    ]
    found = []
    for day, rows in merges:
        found.append(merge.merge_vintage(spark, snapshot(spark, *rows), day, path, "r"))
        layouts()
    assert [f["total_changes"] for f in found] == [5, 5, 4, 1, 1]
    rows = merge.read_log(spark, path).select("release_id", "series_id", "vintage_date", "value", "_change_type")
    assert sorted(map(tuple, rows.collect()), key=str) == sorted([
        (0, "A", V1, 1.0, "insert"), (1, "A", V1, 1.0, "insert"), (2, "A", V1, 3.0, "insert"),
        (3, "A", V1, 1.0, "insert"), (4, "A", V1, 1.0, "insert"),
        *[(r, s, V2, v, kind) for r in (1, 3) for s, v, kind in (("A", None, "delete"), ("B", 2.0, "insert"))],
        *[(r, s, V3, v, kind) for r in (1, 3) for s, v, kind in (("A", 3.0, "insert"), ("B", None, "delete"))],
        (4, "A", V3, 4.0, "update"),
    ], key=str)


def test_ingest_keeps_other_releases(spark, tmp_path, layouts, monkeypatch):
    monkeypatch.setattr(tables, "RELEASE_BUCKETS", 2)
    first, second, table = (str(tmp_path / n) for n in ("first", "second", "snapshots"))
    land_raw(raw_rows(spark, 4, "2024-02-01", "no date"), first)
    land_raw(raw_rows(spark, 2, "2024-02-01", "no date", value="2"), second)
    ingest_vintages(spark, first, table)
    layouts()
    done = {r["vintage_date"]: r["updated"] for r in ingest_vintages(spark, second, table).collect()}
    assert done[V1] == 2
    rows = read_snapshots(spark, table).select("release_id", "vintage_date", "value").collect()
    assert sorted(map(tuple, rows), key=str) == sorted(
        [(r, v, 2.0 if r < 2 else 1.0) for r in range(4) for v in (V1, None)], key=str)


def test_maintenance_of_shared_directories(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "MOST_RELEASES", 0)
    house = Warehouse(spark, str(tmp_path / "house"))
    house.land(raw_rows(spark, 90, "2024-02-01"))
    house.process_all_vintages()
    before = sorted(map(str, house.table("snapshots").drop("etl_updated_at").collect()))
    house.optimize(["snapshots"])
    assert sorted(map(str, house.table("snapshots").drop("etl_updated_at").collect())) == before
    assert house.update("snapshots", F.col("release_id") == 7, {"value": F.lit(9.0)})["updated"] == 1
    assert house.delete("snapshots", F.col("release_id") == 8)["deleted"] == 1
    with pytest.raises(ValueError):
        house.update("snapshots", F.lit(True), {"release_id": F.lit(1)})
    rows = {r["release_id"]: r["value"] for r in house.table("snapshots").collect()}
    assert len(rows) == 89 and rows[7] == 9.0 and rows[6] == 1.0 and SNAPSHOTS.names == house.table("snapshots").columns


def jobs_of(spark, function):
    """How many jobs a function starts."""
    spark.sparkContext.setJobGroup("counted", "counted")
    try:
        before = len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
        function()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted")) - before
    finally:
        spark.sparkContext.setJobGroup("", "")


def log_of(spark, releases):
    """Change rows of many releases."""
    return spark.range(releases).select(
        F.col("id").cast("int").alias("release_id"), F.lit("A").alias("series_id"), F.lit(D1).alias("date"),
        F.lit(V1).alias("vintage_date"), F.lit(1.0).alias("value"), F.lit("insert").alias("_change_type"),
        F.current_timestamp().alias("last_updated"))


def test_existence_is_told_by_one_file(spark, tmp_path):
    path = str(tmp_path / "log")
    assert tables.ensure_table(spark, path, "series_observations")
    assert not tables.ensure_table(spark, path, "series_observations")
    tables.append(log_of(spark, 150), path, "series_observations")
    assert jobs_of(spark, lambda: tables.ensure_table(spark, path, "series_observations")) <= 1
    assert merge.read_log(spark, path).count() == 150


def test_what_is_no_table(spark, tmp_path):
    for name in ("empty", "hidden/_temporary/0", "deep/vintage_date=2024-02-01"):
        (tmp_path / name).mkdir(parents=True)
    (tmp_path / "hidden/_temporary/0/part-0.parquet").write_bytes(b"")
    (tmp_path / "hidden/_SUCCESS").write_bytes(b"")
    for name in ("missing", "empty", "hidden", "deep"):
        assert not tables.table_exists(spark, str(tmp_path / name))
    for fmt in ("parquet", "csv", "json"):
        path = str(tmp_path / fmt)
        log_of(spark, 3).drop("last_updated").write.format(fmt).partitionBy("vintage_date", "release_id").save(path)
        assert tables.table_exists(spark, path, fmt)
    assert tables.table_exists(spark, str(tmp_path / "par*"))


def test_small_directories_are_written_by_several_tasks(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = log_of(spark, 150).unionAll(log_of(spark, 2).withColumn("series_id", F.lit("B")))
    tables.append(rows, path, "series_observations")
    files = [n for _, _, names in os.walk(path) for n in names if n.endswith(".parquet")]
    assert len({n.split("-")[1] for n in files}) >= 4
    assert 150 <= len(files) <= 155 and len(leaves(path)) == 150
    found = merge.read_log(spark, path).select("release_id", "series_id").collect()
    assert sorted(map(tuple, found)) == sorted([*((r, "A") for r in range(150)), (0, "B"), (1, "B")])


def test_one_large_directory_is_written_by_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "TASK_ROWS", 100)
    rows = log_of(spark, 1000).withColumns({"series_id": F.col("release_id").cast("string"), "release_id": F.lit(1)})
    path = str(tmp_path / "log")
    tables.append(rows, path, "series_observations")
    assert len(leaves(path)) == 1 and merge.read_log(spark, path).count() == 1000
    assert len([n for _, _, names in os.walk(path) for n in names if n.endswith(".parquet")]) >= 5


def test_nothing_to_append(spark, tmp_path):
    path = str(tmp_path / "log")
    tables.ensure_table(spark, path, "series_observations")
    tables.append(log_of(spark, 0), path, "series_observations")
    assert merge.read_log(spark, path).count() == 0


def test_change_log_reads_its_input_once(spark, sf_dir):
    assert not [f for f in fx.changes(spark, sf_dir).inputFiles() if "events" in f]
