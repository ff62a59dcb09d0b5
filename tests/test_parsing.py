"""Parsing, deduplication, filling and upserts on edge cases."""

import pytest
from frames import D1, D2, V1, day
from pyspark.sql import functions as F

from revtide.functions.parsing import parse_date, parse_value
from revtide.operators import observations, selection, upserts
from revtide.operators.statistics import value_statistics, volatile_series

RAW = "series_id string, date string, value string, release_id int, vintage_date string, collected_at string"


def test_bad_text_becomes_null(spark):
    rows = [(".", "2024-01-05"), ("x", "2024-13-01"), ("", "2024-1-5"), (None, None),
            ("1.5", "2024-01-05x"), ("-2e3", "2024-02-30"), ("7", " 2024-1-5"), ("8", "2024-01-05\n")]
    df = spark.createDataFrame(rows, "v string, d string")
    got = df.select(parse_value(F.col("v")), parse_date(F.col("d"))).collect()
    assert [r[0] for r in got] == [None, None, None, None, 1.5, -2000.0, 7.0, 8.0]
    assert [r[1] for r in got] == [day("2024-01-05")] + [None] * 7


def test_only_plain_numbers_are_values(spark):
    texts = ["5d", "1f", "NaN", "Infinity", "-inf", "0x1", "1_000", "1e", ".5", "+5.", " 6 ", "1E-3"]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    assert [r[0] for r in df.select(parse_value(F.col("v"))).collect()] == [None] * 8 + [0.5, 5.0, 6.0, 0.001]


def test_series_of_a_frame(spark):
    df = spark.createDataFrame([("A", 1), ("B", 2), (None, 3)], "series_id string, value int")
    wanted = spark.createDataFrame([("A",), ("A",), (None,)], "series_id string")
    assert [tuple(r) for r in selection.series_filter(df, wanted).collect()] == [("A", 1)]
    many = [str(i) for i in range(3000)] + ["B"]
    assert [tuple(r) for r in selection.series_filter(df, many).collect()] == [("B", 2)]


def test_dates_are_parsed_only_once(spark):
    df = spark.createDataFrame([("A", D1)], "series_id string, date date")
    stamped = observations.stamp_run(df, "2024-02-01", 9, "run", "v2").first()
    assert (stamped["date"], stamped["vintage_date"], stamped["release_id"]) == (D1, V1, 9)
    both = observations.with_year_month(df).first()
    assert (both["year"], both["month"]) == (2024, 1)


def test_a_wrong_date_argument_fails_before_any_job(spark):
    df = spark.createDataFrame([("A", D1)], "series_id string, date date")
    with pytest.raises(ValueError):
        selection.date_range(df, "2024-1-5")


def test_dedup_takes_the_last_collected_row(spark):
    rows = [("A", "2024-01-01", "1", 2, "v", "t1"), ("A", "2024-01-01", "2", 3, "v", "t2"),
            ("A", "2024-01-01", "3", 1, "v", "t2"), (None, None, "4", 1, "v", None),
            (None, None, "5", 1, "v", None)]
    kept = observations.dedup_series_date(spark.createDataFrame(rows, RAW)).collect()
    assert sorted((r["series_id"] or "", r["value"]) for r in kept) == [("", "5"), ("A", "3")]


def test_fill_keeps_what_is_there(spark):
    df = spark.createDataFrame([("A", "2024-01-01")], "series_id string, date string")
    filled = observations.fill_missing_columns(df, defaults={"collected_at": F.lit("now")})
    row = filled.first()
    assert (row["series_id"], row["collected_at"], row["release_date"]) == ("A", "now", None)
    assert dict(filled.dtypes)["release_id"] == "int"


def test_sorting_does_not_need_the_projected_date(spark):
    df = spark.createDataFrame([("A", D2, 2.0), ("A", D1, 1.0)], "series_id string, date date, value double")
    assert [r[0] for r in selection.get_series(df, "A", columns=["value"]).collect()] == [1.0, 2.0]


def test_long_id_lists_are_joined(spark):
    df = spark.range(3000).select(F.col("id").cast("string").alias("series_id"))
    wanted = [str(i) for i in range(0, 4000, 2)]
    assert selection.series_filter(df, wanted).count() == 1500


def test_statistics_are_numeric_and_safe(spark):
    df = spark.createDataFrame(
        [("A", "9"), ("A", "10"), ("A", "100"), ("Z", "."), ("O", "1")], "series_id string, value string"
    ).withColumn("value", parse_value(F.col("value")))
    found = {r["series_id"]: r for r in value_statistics(df).collect()}
    assert (found["A"]["min_value"], found["A"]["max_value"]) == (9.0, 100.0)
    assert (found["Z"]["n_obs"], found["Z"]["mean_value"], found["O"]["stddev_value"]) == (1, None, None)
    zero = spark.createDataFrame([("Q", v) for v in (-1.0, 1.0)], "series_id string, value double")
    assert volatile_series(value_statistics(zero), min_obs=1).count() == 0


def snapshots(spark, *rows):
    schema = "series_id string, date date, vintage_date date, value double, value_str string"
    return spark.createDataFrame(rows, schema).withColumn("release_id", F.lit(1))


def test_upsert_applies_a_change_to_null(spark):
    target = snapshots(spark, ("A", D1, V1, 1.0, "1"), ("B", D1, V1, None, "."), ("C", D1, V1, 3.0, "3"))
    source = snapshots(spark, ("A", D1, V1, None, "."), ("B", D1, V1, None, "."), ("D", D1, V1, 4.0, "4"))
    done = upserts.upsert_snapshot(target, source)
    got = {r["series_id"]: (r["value"], r["_action"]) for r in done.collect()}
    assert got == {"A": (None, "updated"), "B": (None, "unchanged"), "C": (3.0, "kept"), "D": (4.0, "inserted")}
    assert upserts.upsert_counts(done).first().asDict() == {
        "inserted": 1, "updated": 1, "unchanged": 1, "total_processed": 3}


def test_partial_columns_keep_the_others(spark):
    target = spark.createDataFrame([(1, "one", "link")], "release_id int, release_name string, link string")
    source = spark.createDataFrame([(1, "uno"), (2, "due")], "release_id int, release_name string")
    partial = upserts.upsert_release_metadata(target, source).orderBy("release_id").collect()
    assert [(r["release_name"], r["link"]) for r in partial] == [("uno", "link"), ("due", None)]
    whole = upserts.upsert(target, source, ["release_id"]).orderBy("release_id").collect()
    assert [(r["release_name"], r["link"]) for r in whole] == [("uno", None), ("due", None)]
