"""Changes of stored tables touch the partitions they must, and a failing one none."""

import os
from pathlib import Path

import pytest
from frames import D1, D2, V1, V2, V3, snapshot
from pyspark.sql import functions as F

from revtide.operators.layout import bits_for
from revtide.operators.ledger import conform
from revtide.operators.quality import QualityError
from revtide.operators.upserts import upsert_series_metadata
from revtide.plans import vintages
from revtide.plans.curate import curate_counted
from revtide.schemas import RAW, SERIES_METADATA
from revtide.sources.clustering import cluster_stored
from revtide.sources.mutation import delete_stored, update_stored
from revtide.sources.tables import overwrite_touched, read_table, save
from revtide.warehouse import Warehouse

PARTITIONS = ["vintage_date", "release_id"]


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = snapshot(
        spark, ("A", D1, V1, 1.0), ("B", D1, V1, None), ("A", D1, V2, 2.0), ("A", D2, V2, 3.0, 2), ("B", D1, V3, 4.0, 3),
        ("C", D1, V3, 5.0, None),
    )
    overwrite_touched(rows, path, PARTITIONS)
    return path


def files(path):
    """{directory below the path: names of its data files}."""
    return {
        str(Path(folder).relative_to(path)): sorted(n for n in names if n.endswith(".parquet"))
        for folder, _, names in os.walk(path) if any(n.endswith(".parquet") for n in names)
    }


def values_of(spark, path):
    rows = read_table(spark, path).select("series_id", "vintage_date", "value").collect()
    return [r["value"] for r in sorted(rows, key=str)]


def test_update_rewrites_only_the_partitions_with_matches(spark, table):
    before = files(table)
    counts = update_stored(spark, table, PARTITIONS, F.col("value") >= 3, {"value": F.col("value") * 10})
    after = files(table)
    changed = {d for d in before if before[d] != after[d]}
    assert counts == {"updated": 3, "partitions": 3}
    assert changed == {"vintage_date=2024-02-08/release_id=2", "vintage_date=2024-02-15/release_id=3",
                       "vintage_date=2024-02-15/release_id=__HIVE_DEFAULT_PARTITION__"}
    assert sorted(values_of(spark, table), key=str) == [1.0, 2.0, 30.0, 40.0, 50.0, None]


def test_update_of_nothing_and_of_a_partition_column(spark, table):
    before = files(table)
    assert update_stored(spark, table, PARTITIONS, F.col("value") > 99, {"value": F.lit(0.0)})["updated"] == 0
    assert update_stored(spark, table, PARTITIONS, F.lit(None).cast("boolean"), {"value": F.lit(0.0)})["updated"] == 0
    with pytest.raises(ValueError):
        update_stored(spark, table, PARTITIONS, F.lit(True), {"release_id": F.lit(1)})
    assert files(table) == before


def test_delete_removes_emptied_partitions_only(spark, table):
    before = files(table)
    condition = (F.col("value") == 1) | F.col("release_id").isNull() | (F.col("release_id") == 2)
    assert delete_stored(spark, table, PARTITIONS, condition) == {"deleted": 3, "partitions": 3}
    after = files(table)
    assert set(after) == {"vintage_date=2024-02-01/release_id=1", "vintage_date=2024-02-08/release_id=1",
                          "vintage_date=2024-02-15/release_id=3"}
    for kept in ("vintage_date=2024-02-08/release_id=1", "vintage_date=2024-02-15/release_id=3"):
        assert after[kept] == before[kept]
    assert sorted(values_of(spark, table), key=str) == [2.0, 4.0, None]


def test_delete_in_directories_with_escaped_names(spark, tmp_path):
    path = str(tmp_path / "named")
    rows = spark.createDataFrame([("a:b c/d", 1), ("a%3A", 2), ("plain", 3)], "name string, n int")
    overwrite_touched(rows, path, ["name"])
    delete_stored(spark, path, ["name"], F.col("n") < 3)
    assert list(files(path)) == ["name=plain"]


def metadata(spark, *ids, title="t"):
    rows = spark.createDataFrame([(i, title) for i in ids], "series_id string, title string")
    return conform(rows.withColumn("last_updated", F.current_timestamp()), SERIES_METADATA)


def upsert(spark, path, rows):
    return vintages.upsert_table(spark, rows, path, "series_metadata", upsert_series_metadata)


def test_upsert_touches_the_buckets_of_its_keys(spark, tmp_path):
    path = str(tmp_path / "metadata")
    ids = [f"S{i}" for i in range(300)]
    assert upsert(spark, path, metadata(spark, *ids))["inserted"] == 300
    before = files(path)
    counts = upsert(spark, path, metadata(spark, *ids[:9], "new", title="u"))
    after = files(path)
    assert counts == {"inserted": 1, "updated": 9, "unchanged": 0, "total_processed": 10}
    assert 0 < sum(before.get(d) != after[d] for d in after) <= 10 and len(after) > 40
    titles = read_table(spark, path).groupBy("title").count().collect()
    assert {r["title"]: r["count"] for r in titles} == {"t": 291, "u": 10}
    assert upsert(spark, path, metadata(spark)) == {"inserted": 0, "updated": 0, "unchanged": 0, "total_processed": 0}


def test_a_failing_upsert_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "metadata")
    upsert(spark, path, metadata(spark, "A", "B"))

    def broken(target, source):
        merged = upsert_series_metadata(target, source)
        return merged.withColumn("title", F.when(F.col("series_id") == "B", F.raise_error(F.lit("no"))).otherwise("x"))

    with pytest.raises(Exception, match="no"):
        vintages.upsert_table(spark, metadata(spark, "A", "B", "C"), path, "series_metadata", broken)
    assert read_table(spark, path).filter("title = 't'").count() == 2


def test_a_table_without_buckets_gets_them(spark, tmp_path):
    path = str(tmp_path / "metadata")
    save(metadata(spark, "A", "B"), path)
    assert upsert(spark, path, metadata(spark, "B", "C", title="u"))["updated"] == 1
    found = {r["series_id"]: r["title"] for r in read_table(spark, path).collect()}
    assert found == {"A": "t", "B": "u", "C": "u"} and all("_bucket=" in d for d in files(path))


def raw(spark, *rows):
    return spark.createDataFrame(rows, RAW)


GOOD = ("A", "2024-01-01", "1", 1, "2024-02-01", "2024-02-01")


def test_curating_counts_and_reads_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def look(frames):
        for frame in frames:
            seen.add(len(frame))
            yield frame

    rows = raw(spark, GOOD, GOOD, ("B", "2024-01-01", "1", 1, "2024-02-01", None))
    table, counts = curate_counted(spark, rows.mapInPandas(look, rows.schema), str(tmp_path / "curated"))
    assert counts == {"delivered": 3, "duplicates_removed": 1, "written": 2}
    assert table.count() == 2 and seen.value == 3


@pytest.mark.parametrize("bad, check", [
    ((None, *GOOD[1:]), "series_id_nulls: 1"), (("A", "2024-1-5", *GOOD[2:]), "date_format: 1"),
])
def test_a_failing_gate_leaves_the_table(spark, tmp_path, bad, check):
    path = str(tmp_path / "curated")
    curate_counted(spark, raw(spark, GOOD), path)
    before = files(path)
    with pytest.raises(QualityError, match=check):
        curate_counted(spark, raw(spark, GOOD, bad), path)
    assert files(path) == before


def test_a_delivery_without_values_does_not_pass(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "house"))
    rows = raw(spark, GOOD).drop("value")
    overwrite_touched(rows, house.path("raw"), ["vintage_date", "release_id"])
    with pytest.raises(QualityError, match=r"required_columns \(value\): 1"):
        house.curate("2024-02-01")
    house.land(raw(spark, GOOD))
    assert house.curate_counted("2024-02-01")[1]["written"] == 1


def test_clustering_leaves_unchanged_partitions(spark, table, tmp_path):
    record, columns = str(tmp_path / "layout"), ["series_id", "date"]
    rows = lambda: sorted(map(str, read_table(spark, table).collect()))
    before = rows()
    first = cluster_stored(spark, table, record, columns, PARTITIONS)
    assert first["partitions"] == len(files(table)) and rows() == before
    clustered = files(table)
    assert cluster_stored(spark, table, record, columns, PARTITIONS) == {"partitions": 0, "files": 0, "bytes": 0}
    assert files(table) == clustered
    # A changed partition, one whose release is null, and a new one are rewritten; the others keep their files.
    update_stored(spark, table, PARTITIONS, F.col("series_id") == "C", {"value": F.lit(9.0)})
    overwrite_touched(snapshot(spark, ("D", D1, V2, 1.0, 7)), table, PARTITIONS)
    changed, before = files(table), rows()
    assert cluster_stored(spark, table, record, columns, PARTITIONS)["partitions"] == 2
    assert rows() == before
    same = {folder for folder in changed if files(table)[folder] == changed[folder]}
    assert same == {folder for folder in clustered if changed[folder] == clustered[folder]} and len(same) == len(changed) - 2
    assert cluster_stored(spark, table, record, columns, PARTITIONS)["partitions"] == 0


def test_a_failed_clustering_is_done_again(spark, table, tmp_path):
    record = str(tmp_path / "layout")
    with pytest.raises(Exception, match="missing"):
        cluster_stored(spark, table, record, ["missing"], PARTITIONS)
    assert cluster_stored(spark, table, record, ["series_id"], PARTITIONS)["partitions"] == len(files(table))


def test_ranges_follow_the_bytes():
    assert [bits_for(n << 20, 2) for n in (0, 1, 128, 1280, 1 << 20)] == [2, 2, 2, 4, 8]
