"""Calls to the source, skipped lines and how long a run took."""

import datetime
import json

import pytest
from frames import V1

from revtide.plans.collection import attempts_of, close_run, land_payload_counted
from revtide.sources.raw import read_payload_pages, read_raw


def page(release, number, *values):
    series = [{"series_id": "A", "title": "t", "observations": [{"date": "2024-01-01", "value": v} for v in values]}]
    return json.dumps({"release_id": release, "vintage_date": "2024-02-01", "page": number, "series": series})


@pytest.fixture
def pages(tmp_path):
    folder = tmp_path / "pages"
    folder.mkdir()
    (folder / "a.json").write_text("\n".join([page(1, 1, "1"), page(1, 2, "2"), page(2, 1, "3")]) + "\n")
    return folder


def test_calls_and_duration(spark, pages, tmp_path):
    quality, counts = land_payload_counted(spark, str(pages), str(tmp_path / "raw"))
    assert counts == {"lines": 3, "skipped": 0}
    attempts = attempts_of(quality, pages=read_payload_pages(spark, str(pages)))
    assert {r["release_id"]: r["api_calls"] for r in attempts.collect()} == {1: 2, 2: 1}
    assert {r["api_calls"] for r in attempts_of(quality).collect()} == {None}
    started = datetime.datetime.now() - datetime.timedelta(seconds=90)
    report = close_run(attempts, V1, str(tmp_path / "run"), started).first()
    assert report["api_calls"] == 3 and 90 <= report["duration_seconds"] < 600
    assert "duration_seconds" not in close_run(attempts, V1, str(tmp_path / "other")).columns


def test_skipped_lines_are_counted(spark, pages, tmp_path):
    (pages / "b.json").write_text("no page\n" + page(3, 1, "4") + "\n{\n")
    quality, counts = land_payload_counted(spark, str(pages), str(tmp_path / "raw"), skip_corrupt=True)
    assert counts == {"lines": 6, "skipped": 2}
    assert {r["release_id"]: r["obs_count"] for r in quality.collect()} == {1: 2, 2: 1, 3: 1}
    assert read_raw(spark, str(tmp_path / "raw")).count() == 4
    with pytest.raises(Exception):
        land_payload_counted(spark, str(pages), str(tmp_path / "raw"))
