"""Quality control, gate, report and batches on edge cases."""

import pytest
from pyspark.sql import functions as F

from revtide.operators import collection, quality
from revtide.plans import curate

RAW = "release_id int, series_id string, date string, value string"
META = "series_id string, release_id int"
ATTEMPTS = """release_id int, attempt bigint, status string, observations bigint, series bigint,
    api_calls bigint, qc_valid boolean, qc_warnings bigint, qc_errors bigint, error string"""


def raw(spark, *rows):
    return spark.createDataFrame(rows, RAW)


def test_verdict(spark):
    rows = [(1, "A", f"2024-01-{d:02d}", "1") for d in range(1, 29)]
    rows += [(1, "A", "2024-02-01", None), (1, "A", "2024-02-02", ".")]
    rows += [(2, "", "2024-01-01", "1"), (2, "B", "", "1"), (2, "B", "2024-01-01", "1"),
             (2, "B", "2024-01-01", "2")]
    metadata = spark.createDataFrame([("A", 1)], META)
    expected = spark.createDataFrame([(1,), (2,), (3,)], "release_id int")
    found = {r["release_id"]: r for r in quality.release_quality(
        raw(spark, *rows), metadata, expected).collect()}
    assert found[1]["is_valid"] and found[1]["null_values"] == 1 and found[1]["qc_warnings"] == 1
    two = found[2]
    assert (two["empty_series_ids"], two["invalid_dates"], two["duplicate_observations"]) == (1, 1, 1)
    assert (two["series_without_metadata"], two["metadata_count"], two["is_valid"]) == (2, 0, False)
    assert (found[3]["obs_count"], found[3]["qc_errors"], found[3]["is_valid"]) == (0, 1, False)
    whole = {r["release_id"]: (r["complete"], r["warning"]) for r in quality.completeness(
        quality.release_quality(raw(spark, *rows), metadata, expected)).collect()}
    assert whole == {1: (True, None), 2: (True, None), 3: (False, "no series collected")}


def test_a_tenth_of_missing_values_is_too_much(spark):
    rows = [(1, "A", f"2024-01-{d:02d}", "1" if d > 1 else "") for d in range(1, 11)]
    metadata = spark.createDataFrame([("A", 1)], META)
    assert not quality.release_quality(raw(spark, *rows), metadata).first()["is_valid"]


def test_outliers_need_more_than_ten_numbers(spark):
    few = [(1, "A", str(i), "1") for i in range(9)] + [(1, "A", "x", "1e9")]
    many = [(2, "A", str(i), "1") for i in range(100)] + [(2, "A", "x", "1e9"), (2, "A", "y", None)]
    found = {r[0]: r[1] for r in quality.outlier_counts(raw(spark, *few, *many)).collect()}
    assert found == {1: 0, 2: 1}


def test_issue_samples_stop_at_ten(spark):
    rows = [(1, "A", f"{i:03d}", None) for i in range(25)] + [(1, None, "d", "1")] * 3
    metadata = spark.createDataFrame([("A", 1)], META)
    issues = quality.quality_issues(raw(spark, *rows), metadata)
    got = quality.issue_samples(issues).collect()
    assert sum(r["kind"] == "warning" for r in got) == 10
    errors = [(r["issue"], r["occurrences"]) for r in got if r["kind"] == "error"]
    assert errors == [("empty_series_id", 3)]


def test_gate_stops_bad_rows(spark, tmp_path):
    good = spark.createDataFrame(
        [("A", "2024-01-01", "1", 1, "t"), ("A", "2024-01-01", "2", 1, "u")],
        "series_id string, date string, value string, release_id int, collected_at string")
    path = str(tmp_path / "curated")
    kept = curate.curate(spark, good, path).collect()
    assert [(r["value"], r["year"], r["month"]) for r in kept] == [("2", 2024, 1)]
    for date in (None, "2024-1-5"):
        bad = good.withColumn("date", F.lit(date).cast("string"))
        with pytest.raises(quality.QualityError, match="date_format"):
            curate.curate(spark, bad, str(tmp_path / "bad"))
    assert not (tmp_path / "bad").exists()
    with pytest.raises(quality.QualityError, match="required_columns: 3"):
        quality.require_passed(quality.gate_checks(good.drop("release_id")
                               .withColumns({"year": F.lit(1), "month": F.lit(1)}),
                               ["series_id", "release_id", "release_date", "q"]))


def attempts(spark, *rows):
    return spark.createDataFrame(
        [(r, a, s, o, 1, 1, v, 0, 0, None if s == "success" else "boom") for r, a, s, o, v in rows],
        ATTEMPTS)


def test_retry_replaces_the_first_outcome(spark):
    tries = attempts(spark, (1, 1, "failed", 0, None), (1, 2, "success", 10, True),
                     (2, 1, "failed", 0, None), (2, 2, "failed", 0, None), (3, 1, "success", 5, False))
    outcomes = collection.final_release_outcome(tries)
    total = collection.run_totals(outcomes).first().asDict()
    assert (total["successful"], total["failed"], total["total_observations"]) == (2, 1, 15)
    assert (total["retries_attempted"], total["retries_succeeded"]) == (2, 1)
    report = collection.qc_report(outcomes, "2024-02-01").first()
    assert [tuple(r) for r in report["failed_releases"]] == [(2, "boom")]
    assert [r["release_id"] for r in report["qc_issues"]] == [3]
    score = collection.quality_score(collection.run_totals(outcomes)).first()
    assert round(score["quality_score"], 3) == round(70 * 2 / 3 + 15, 3) and score["band"] == "poor"


def test_a_run_without_releases(spark):
    totals = collection.run_totals(collection.final_release_outcome(attempts(spark).limit(0)))
    score = collection.quality_score(totals).first()
    assert (score["success_rate"], score["qc_pass_rate"], score["quality_score"]) == (None, None, 100.0)
    assert [r["code"] for r in collection.recommendations(totals).collect()] == ["excellent"]
    outcomes = collection.final_release_outcome(attempts(spark).limit(0))
    assert collection.qc_report(outcomes, "2024-02-01").first()["success_rate"] is None


def test_recommendations(spark):
    def codes(successful, failed, passed, warnings):
        totals = spark.createDataFrame(
            [(successful, failed, passed, warnings)],
            "successful bigint, failed bigint, qc_passed bigint, qc_warnings bigint")
        return [r["code"] for r in collection.recommendations(totals).collect()]

    assert codes(80, 20, 80, 0) == ["high_failure_rate"]
    assert codes(94, 6, 94, 0) == ["moderate_failure_rate"]
    assert codes(100, 0, 80, 201) == ["low_qc_pass_rate", "many_qc_warnings"]
    assert codes(100, 0, 90, 200) == ["excellent"]


def test_batches(spark):
    ids = [5, 70_000, 3, 200_000, 9, 131_072, 9]
    releases = spark.createDataFrame([(i,) for i in ids], "release_id int")
    got = collection.feed_batches(releases, 2, 1).orderBy("release_index").collect()
    assert [tuple(r) for r in got] == [
        (5, 1, 1), (9, 2, 1), (70_000, 3, 2), (131_072, 4, 2), (200_000, 5, 3)]
