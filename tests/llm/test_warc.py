"""Archives read back against SQL; duplicates, nulls, long records and damaged streams."""

import gzip

import pytest
from compare import difference
from pyspark.sql import functions as F

from revtide.llm import warc
from revtide.session import scratch_path


def test_query_equals_sql(spark, con, sf_dir, monkeypatch):
    monkeypatch.setattr("compare.BANNED", [])
    assert difference(spark, con, "op9_warc_members", sf_dir) is None


def test_awkward_pages(spark):
    long, huge = "é<p>" * 600, "x" * (17 << 20)
    rows = [(1, "http://a/%20 ü", long), (2, None, long), (3, "u", long), (3, "u", long), (4, "", None), (5, "u", ""),
            (None, None, long), (6, "u", "short"), (7, "u", "short"), (8, "u", huge), (9, "u", "a\r\n\r\nWARC/1.1\r\n")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = warc.archived(pages).collect()
    assert len(found) == len(rows)
    for r in found:
        name = r["record_id"].removeprefix("<urn:page:").rstrip(">")
        own = [x for x in rows if str(x[0]) == name.replace("none", "None")][0]
        assert r["url"] == own[1] and r["payload_bytes"] == len((own[2] or "").encode())
        revisit = name in ("1", "2", "none")
        assert (r["record_type"] == "revisit") == revisit
        assert r["refers_to"] == ("<urn:page:3>" if revisit else None)
        assert r["payload"] is None if revisit else bytes(r["payload"]).decode() == (own[2] or "")
    assert warc.archived(pages.limit(0)).count() == 0


def test_members_open_alone(spark, sf_dir):
    source, path = scratch_path(spark, "m"), scratch_path(spark, "n")
    warc.write_monolithic(spark.read.parquet(f"{sf_dir}/pages.parquet"), source)
    warc.normalise(spark, source, path)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    data = [bytes(r["content"]) for r in files.filter(F.col("path").contains("part=data")).collect()]
    before = b"".join(gzip.decompress(bytes(r["content"])) for r in spark.read.format("binaryFile").load(source).collect())
    assert sorted(b"".join(map(gzip.decompress, data))) == sorted(before)
    with pytest.raises(EOFError):
        list(warc.records_of(warc.inflated(gzip.compress(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc"))))
