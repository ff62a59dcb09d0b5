"""Quality control of raw rows, per release, and the gate in front of the curated table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revtide.functions.parsing import is_blank, is_iso_date, parse_value
from revtide.schemas import CURATED_REQUIRED, DELIVERED_REQUIRED
from revtide.session import stored

# Fixed values of the rules.
OUTLIER_MIN_VALUES = 10
OUTLIER_DEVIATIONS = 5
MAX_NULL_SHARE = 0.1
ISSUES_PER_KIND = 10
KEY_COLUMNS = ["series_id", "date", "release_id"]


class QualityError(Exception):
    """The gate found something that must not reach the curated table."""


def blank_counts(raw: DataFrame) -> DataFrame:
    """Per release: rows without a series id, without a date, and without a value."""
    return raw.groupBy("release_id").agg(
        F.count_if(is_blank(F.col("series_id"))).alias("empty_series_ids"),
        F.count_if(is_blank(F.col("date"))).alias("invalid_dates"),
        F.count_if(is_blank(F.col("value"))).alias("null_values"),
    )


def duplicate_counts(raw: DataFrame) -> DataFrame:
    """Per release: rows beyond the first of their (series, date)."""
    points = raw.groupBy("release_id", "series_id", "date").agg(F.count("*").alias("n"))
    return points.groupBy("release_id").agg(
        F.sum(F.col("n") - 1).alias("duplicate_observations")
    )


def obs_per_series(raw: DataFrame) -> DataFrame:
    """Rows per series of each release."""
    return raw.groupBy("release_id", "series_id").agg(F.count("*").alias("obs_count"))


def series_without_metadata(observations: DataFrame, metadata: DataFrame) -> DataFrame:
    """Observed series ids that have no metadata row."""
    observed = observations.select("series_id").distinct()
    return observed.join(metadata.select("series_id"), "series_id", "left_anti")


def outlier_limits(raw: DataFrame, by: Sequence[str] = ("release_id",)) -> DataFrame:
    """Magnitude beyond which a value is an outlier; null with ten numeric values or fewer."""
    number = parse_value(F.col("value"))
    limit = F.abs(F.avg(number)) + OUTLIER_DEVIATIONS * F.stddev_samp(number)
    return raw.groupBy(*by).agg(
        F.when(F.count(number) > OUTLIER_MIN_VALUES, limit).alias("outlier_limit")
    )


def outlier_counts(raw: DataFrame, by: Sequence[str] = ("release_id",)) -> DataFrame:
    """Values beyond the outlier limit, per release or per other grouping without nulls."""
    marked = _with_limits(raw.dropna(subset=list(by)), by)
    return marked.groupBy(*by).agg(F.count_if(_is_outlier()).alias("value_outliers"))


def _with_limits(raw: DataFrame, by: Sequence[str] = ("release_id",)) -> DataFrame:
    """Raw rows with their group's outlier limit; nulls in the grouping are a group like any other."""
    return _joined_limits(raw, stored(outlier_limits(raw, by), "limits"), by)


def _joined_limits(raw: DataFrame, limits: DataFrame, by: Sequence[str] = ("release_id",)) -> DataFrame:
    limits = limits.withColumnsRenamed({c: f"_of_{c}" for c in by})
    same = [raw[c].eqNullSafe(limits[f"_of_{c}"]) for c in by]
    return raw.join(limits, same, "left").drop(*(f"_of_{c}" for c in by))


def release_quality(
    raw: DataFrame, metadata: DataFrame, releases: DataFrame | None = None
) -> DataFrame:
    """All metrics and the verdict per release.

    Rows are first counted per (release, series, date), then per series, then per release, so each
    step combines before its shuffle. ``releases`` adds releases that delivered nothing. Rows without a
    release have a line of their own, under null. A release is valid without errors and with less than a
    tenth of its values missing.
    """
    marked = _with_limits(raw)
    points = marked.groupBy("release_id", "series_id", "date").agg(
        F.count("*").alias("n"),
        F.count_if(is_blank(F.col("value"))).alias("null_values"),
        F.count_if(_is_outlier()).alias("outliers"),
    )
    series = points.groupBy("release_id", "series_id").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") - 1).alias("duplicates"),
        F.sum("null_values").alias("null_values"),
        F.sum("outliers").alias("outliers"),
        F.sum(F.when(is_blank(F.col("date")), F.col("n")).otherwise(0)).alias("no_date"),
    )
    described = metadata.select("series_id").distinct().withColumn("_described", F.lit(True))
    per_release = series.join(described, "series_id", "left").groupBy("release_id").agg(
        F.sum("n").alias("obs_count"),
        F.count("*").alias("series_count"),
        F.sum(F.when(is_blank(F.col("series_id")), F.col("n")).otherwise(0))
        .alias("empty_series_ids"),
        F.sum("no_date").alias("invalid_dates"),
        F.sum("null_values").alias("null_values"),
        F.sum("duplicates").alias("duplicate_observations"),
        F.count_if(F.col("_described").isNull()).alias("series_without_metadata"),
        F.sum("outliers").alias("value_outliers"),
    )
    listed = per_release.withColumn("_listed", F.lit(True))
    if releases is not None:
        expected = releases.select("release_id").distinct().withColumn("_listed", F.lit(True))
        listed = listed.unionByName(expected, True)
    known = metadata.groupBy("release_id").agg(F.count("*").alias("metadata_count"))
    together = listed.unionByName(known, True)
    counts = [c for c in together.columns if c not in ("release_id", "_listed")]
    summed = together.groupBy("release_id").agg(
        F.max("_listed").alias("_listed"), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts)
    )
    return _verdict(summed.filter("_listed").drop("_listed"))


def _verdict(counts: DataFrame) -> DataFrame:
    def c(name: str) -> Column:
        return F.col(name)

    empty = (c("obs_count") == 0).cast("bigint")
    errors = c("empty_series_ids") + c("invalid_dates") + empty
    warnings = (
        c("null_values") + c("duplicate_observations") + c("series_without_metadata")
        + (c("value_outliers") > 0).cast("bigint") + (c("metadata_count") == 0).cast("bigint")
    )
    return counts.withColumns({"qc_errors": errors, "qc_warnings": warnings}).withColumn(
        "is_valid",
        (c("qc_errors") == 0) & (c("null_values") < c("obs_count") * MAX_NULL_SHARE),
    )


def emptiness(releases: DataFrame, raw: DataFrame, metadata: DataFrame) -> DataFrame:
    """Per expected release: has it no observations (error), has it no metadata (warning).

    No release, null, is one like any other.
    """
    expected = releases.select("release_id").distinct()
    observed = raw.select(F.col("release_id").alias("_of")).distinct().withColumn("_observed", F.lit(True))
    described = metadata.select(F.col("release_id").alias("_in")).distinct().withColumn("_described", F.lit(True))
    return expected.join(observed, expected["release_id"].eqNullSafe(observed["_of"]), "left").join(
        described, expected["release_id"].eqNullSafe(described["_in"]), "left"
    ).select(
        "release_id",
        F.col("_observed").isNull().alias("no_observations"),
        F.col("_described").isNull().alias("no_metadata"),
    )


def completeness(quality: DataFrame) -> DataFrame:
    """A release is complete if it brought series and observations; anything less is explained."""
    no_series = F.col("series_count") == 0
    return quality.select(
        "release_id", "series_count", "obs_count",
        (~no_series & (F.col("obs_count") > 0)).alias("complete"),
        F.when(no_series, "no series collected").alias("warning"),
    )


def quality_issues(
    raw: DataFrame, metadata: DataFrame, releases: DataFrame | None = None
) -> DataFrame:
    """Every finding: release, kind (error or warning), issue, series, date, occurrences.

    Limits and series are small against the rows and are stored, so the rows are scanned three
    times however many checks there are.
    """
    points = raw.groupBy("release_id", "series_id", "date").agg(
        F.count("*").alias("n"),
        F.count_if(is_blank(F.col("value"))).alias("null_values"),
    )
    found = F.array(
        F.when(is_blank(F.col("series_id")), _issue("error", "empty_series_id", F.col("n"))),
        F.when(is_blank(F.col("date")), _issue("error", "missing_date", F.col("n"))),
        F.when(F.col("null_values") > 0, _issue("warning", "null_value", F.col("null_values"))),
        F.when(F.col("n") > 1, _issue("warning", "duplicate", F.col("n") - 1)),
    )
    by_point = points.select(
        "release_id", "series_id", "date", F.inline(F.array_compact(found))
    )
    limits = stored(outlier_limits(raw), "limits")
    series = stored(
        _joined_limits(raw, limits).groupBy("release_id", "series_id").agg(
            F.count_if(_is_outlier()).alias("outliers")
        ), "series",
    )
    by_series = series.join(metadata.select("series_id"), "series_id", "left_anti").select(
        "release_id", "series_id", *_labels("warning", "no_metadata", F.lit(1))
    )
    outliers = series.groupBy("release_id").agg(F.sum("outliers").alias("outliers")).filter(
        "outliers > 0"
    ).select("release_id", *_labels("warning", "outliers", F.col("outliers")))
    issues = by_point.unionByName(by_series, True).unionByName(outliers, True)
    empty = emptiness(limits if releases is None else releases, limits, metadata)
    return issues.unionByName(
        empty.filter("no_observations")
        .select("release_id", *_labels("error", "no_observations", F.lit(1))), True
    ).unionByName(
        empty.filter("no_metadata")
        .select("release_id", *_labels("warning", "no_metadata_at_all", F.lit(1))), True
    )


def issue_samples(issues: DataFrame, n: int = ISSUES_PER_KIND) -> DataFrame:
    """The first ``n`` findings of each kind per release, in a fixed order."""
    order = [F.asc_nulls_first(c) for c in ("series_id", "date", "issue")]
    window = Window.partitionBy("release_id", "kind").orderBy(*order)
    ranked = issues.withColumn("position", F.row_number().over(window))
    return ranked.filter(F.col("position") <= n)


def required_columns(df: DataFrame, required: Sequence[str] = CURATED_REQUIRED) -> DataFrame:
    """Per required column: is it there, and in how many rows is it filled."""
    filled = [
        F.struct(
            F.lit(name).alias("column"),
            F.lit(name in df.columns).alias("present"),
            (F.count(name) if name in df.columns else F.lit(0).cast("bigint"))
            .alias("filled_rows"),
        )
        for name in required
    ]
    return df.agg(F.array(*filled).alias("_columns")).select(F.inline("_columns"))


def key_null_counts(df: DataFrame, keys: Sequence[str] = KEY_COLUMNS) -> DataFrame:
    """Nulls in each key column, as one row."""
    return df.agg(*(F.count_if(F.col(k).isNull()).alias(f"{k}_nulls") for k in keys))


def bad_date_format(df: DataFrame) -> DataFrame:
    """Rows whose date text is not a year-month-day; a null date is one of them."""
    return df.filter(~is_iso_date(F.col("date")))


def missing_columns(
    df: DataFrame, required: Sequence[str] = CURATED_REQUIRED, delivered: Sequence[str] | None = None
) -> list[str]:
    """Required columns that rows lack, and those that had to be in a delivery (its columns) and were not.

    Rows may have been given columns of nulls since; that does not make up for a delivery without them.
    """
    absent = [c for c in required if c not in df.columns]
    if delivered is not None:
        absent += [c for c in DELIVERED_REQUIRED if c not in delivered and c not in absent]
    return absent


def gate_failures(df: DataFrame) -> dict[str, Column]:
    """What the checks on rows count, as aggregates by name.

    A key column that is absent fails its null check with every row.
    """
    failures = {}
    for key in KEY_COLUMNS:
        bad = F.col(key).isNull() if key in df.columns else F.lit(True)
        failures[f"{key}_nulls"] = F.count_if(bad)
    bad = ~is_iso_date(F.col("date").cast("string")) if "date" in df.columns else F.lit(True)
    failures["date_format"] = F.count_if(bad)
    return failures


def gate_checks(
    df: DataFrame, required: Sequence[str] = CURATED_REQUIRED, delivered: Sequence[str] | None = None
) -> DataFrame:
    """The checks before a curated table is written: check, failures, passed. One pass over rows."""
    missing = len(missing_columns(df, required, delivered))
    failures = {"required_columns": F.lit(missing).cast("bigint"), **gate_failures(df)}
    rows = F.array(*(
        F.struct(F.lit(name).alias("check"), count.alias("failures"))
        for name, count in failures.items()
    ))
    checks = df.agg(rows.alias("_checks")).select(F.inline("_checks"))
    return checks.withColumn("passed", F.col("failures") == 0)


def require_passed(checks: DataFrame) -> None:
    """Raise unless all checks passed. Runs the checks; they are a handful of rows."""
    require_none({r["check"]: r["failures"] for r in checks.collect()})


def require_none(failures: Mapping[str, int]) -> None:
    """Raise if any check counted a failure."""
    failed = [f"{name}: {count}" for name, count in failures.items() if count]
    if failed:
        raise QualityError("quality gate failed: " + ", ".join(failed))


def _is_outlier() -> Column:
    return F.abs(parse_value(F.col("value"))) > F.col("outlier_limit")


def _labels(kind: str, issue: str, occurrences: Column) -> list[Column]:
    return [
        F.lit(kind).alias("kind"), F.lit(issue).alias("issue"),
        occurrences.cast("bigint").alias("occurrences"),
    ]


def _issue(kind: str, issue: str, occurrences: Column) -> Column:
    return F.struct(*_labels(kind, issue, occurrences))
