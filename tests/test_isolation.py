"""A broken vintage or file is reported and stays out; the others go on."""

import os

import pytest
from pyspark.sql import functions as F

from revtide.plans.vintages import ingest_isolated, read_snapshots
from revtide.schemas import RAW
from revtide.sources.files import file_counts, probe_files, read_readable
from revtide.sources.raw import land_raw

ROWS = [
    (f"S{i}", "2024-01-01", str(i), release, vintage, f"2024-02-0{i}T00:00:00")
    for vintage in ("2024-02-01", "2024-02-08", "2024-02-15") for release in (1, 2) for i in (1, 2, 3)
]


@pytest.fixture
def landed(spark, tmp_path):
    path = str(tmp_path / "raw")
    land_raw(spark.createDataFrame(ROWS, RAW), path)
    return path


def cut(folder):
    """Keep the first bytes of a directory's file, with a footer that is none."""
    name = next(n for n in os.listdir(folder) if n.endswith(".parquet"))
    with open(f"{folder}/{name}", "rb") as file:
        content = file.read()
    with open(f"{folder}/{name}", "wb") as file:
        file.write(content[: len(content) // 2])
    crc = f"{folder}/.{name}.crc"
    if os.path.exists(crc):
        os.remove(crc)
    return content, f"{folder}/{name}"


def by_name(status):
    return {r["name"]: r.asDict() for r in status.collect()}


def test_others_go_on_and_a_repair_is_ingested(spark, landed, tmp_path):
    table = str(tmp_path / "snapshots")
    content, name = cut(f"{landed}/vintage_date=2024-02-08/release_id=2")
    found = by_name(ingest_isolated(spark, landed, table))
    assert {n: r["status"] for n, r in found.items()} == {
        "2024-02-01": "success", "2024-02-08": "failed", "2024-02-15": "success"}
    assert "1 of 2 files cannot be read" in found["2024-02-08"]["error"]
    assert (found["2024-02-08"]["raw_count"], found["2024-02-08"]["inserted"]) == (3, 0)
    assert (found["2024-02-01"]["raw_count"], found["2024-02-01"]["inserted"]) == (6, 6)
    days = {str(r[0]) for r in read_snapshots(spark, table).select("vintage_date").distinct().collect()}
    assert days == {"2024-02-01", "2024-02-15"}
    with open(name, "wb") as file:
        file.write(content)
    found = by_name(ingest_isolated(spark, landed, table, ["2024-02-08"]))
    assert [(n, r["status"], r["inserted"]) for n, r in found.items()] == [("2024-02-08", "success", 6)]


def test_a_failed_vintage_keeps_its_old_rows(spark, landed, tmp_path):
    table = str(tmp_path / "snapshots")
    ingest_isolated(spark, landed, table).collect()
    cut(f"{landed}/vintage_date=2024-02-08/release_id=2")
    found = by_name(ingest_isolated(spark, landed, table))
    assert found["2024-02-08"]["status"] == "failed" and found["2024-02-01"]["unchanged"] == 6
    assert read_snapshots(spark, table).filter("vintage_date = '2024-02-08'").count() == 6


def test_other_reasons_and_counts(spark, landed, tmp_path):
    more = [(None, "2024-01-01", "1", 1, "2024-03-01", None), ("A", "x", "1", 1, "2024-03-01", None),
            ("A", "2024-01-01", "1", 1, "no date", None), ("A", "2024-01-01", "1", 1, "2024-04-01", "2024"),
            ("A", "2024-01-01", "2", 1, "2024-04-01", "2025"), (None, "2024-01-01", "2", 1, "2024-04-01", "2025")]
    land_raw(spark.createDataFrame(more, RAW), landed)
    found = by_name(ingest_isolated(spark, landed, str(tmp_path / "snapshots")))
    assert found["2024-03-01"]["error"] == "no row has a release, a series and a date"
    assert found["no date"]["error"] == "the vintage is no date" and found["no date"]["vintage_date"] is None
    late = found["2024-04-01"]
    assert (late["raw_count"], late["rejected"], late["duplicates"], late["inserted"]) == (3, 1, 1, 1)
    missing = by_name(ingest_isolated(spark, landed, str(tmp_path / "snapshots"), ["1999-01-01"]))
    assert missing["1999-01-01"]["error"] == "not landed"


def test_rows_of_readable_files(spark, landed):
    cut(f"{landed}/vintage_date=2024-02-01/release_id=1")
    files = probe_files(spark, landed)
    counts = {r["vintage_date"]: (r["files"], r["bad_files"], r["rows"]) for r in file_counts(files).collect()}
    assert counts == {"2024-02-01": (2, 1, 3), "2024-02-08": (2, 0, 6), "2024-02-15": (2, 0, 6)}
    rows = read_readable(spark, landed, files)
    assert rows.count() == 15
    assert rows.filter((F.col("vintage_date") == "2024-02-01") & (F.col("release_id") == 1)).count() == 0
