"""Raw rows to the curated table: fill, derive, deduplicate, check, write by month, analyse."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from revtide.functions.parsing import parse_date, parse_value
from revtide.operators.observations import (
    dedup_series_date,
    fill_missing_columns,
    with_year_month,
)
from revtide.operators.quality import gate_failures, missing_columns, require_none
from revtide.schemas import RAW_PATCHED
from revtide.session import observed, stored
from revtide.sources.tables import overwrite_by_month, read_table, save_analysis_tables


def filled_rows(raw: DataFrame, vintage_date: str | None = None) -> DataFrame:
    """Raw rows with all columns of the curated table. A missing collection time is the vintage."""
    filled = fill_missing_columns(raw, RAW_PATCHED)
    if vintage_date:
        filled = filled.withColumn("collected_at", F.coalesce("collected_at", F.lit(vintage_date)))
    return with_year_month(filled)


def curated_rows(raw: DataFrame, vintage_date: str | None = None) -> DataFrame:
    """Deduplicated rows of the curated table, still unchecked."""
    return dedup_series_date(filled_rows(raw, vintage_date))


def curate_counted(
    spark: SparkSession, raw: DataFrame, table_path: str, vintage_date: str | None = None,
    delivered: Sequence[str] | None = None,
) -> tuple[DataFrame, dict[str, int]]:
    """Write the curated table; returns it and the rows delivered, removed as duplicates, and written.

    Raises ``QualityError`` and leaves the old table as it is if a check fails. ``delivered`` names the
    columns that the delivery has, if ``raw`` may have been given more. Raw rows are read once: the job that
    deduplicates them counts them and what the gate looks for, and stores its result, from which the table is
    written when all checks have passed. A job that fails has not touched the table.
    """
    filled = filled_rows(raw, vintage_date)
    absent = missing_columns(filled, delivered=raw.columns if delivered is None else delivered)
    require_none({f"required_columns ({', '.join(absent)})": len(absent)})
    whole, kept = Observation(), Observation()
    checks = gate_failures(filled)
    watched = filled.observe(whole, F.count("*").alias("rows"), *[c.alias(n) for n, c in checks.items()])
    rows = dedup_series_date(watched).observe(kept, F.count("*").alias("rows"))
    staged = stored(rows, "curated")
    seen, written = observed(whole), observed(kept)["rows"]
    require_none({name: seen[name] for name in checks})
    overwrite_by_month(staged, table_path)
    counts = {"delivered": seen["rows"], "duplicates_removed": seen["rows"] - written, "written": written}
    return read_table(spark, table_path), counts


def curate(
    spark: SparkSession, raw: DataFrame, table_path: str, vintage_date: str | None = None,
    delivered: Sequence[str] | None = None,
) -> DataFrame:
    """``curate_counted`` for its table alone."""
    return curate_counted(spark, raw, table_path, vintage_date, delivered)[0]


def numeric(curated: DataFrame) -> DataFrame:
    """Curated rows with dates and numbers, as the statistics need them."""
    return curated.withColumns({
        "date": parse_date(F.col("date")), "value": parse_value(F.col("value")),
    })


def analyse(curated: DataFrame, path: str) -> dict[str, str]:
    """Persist the statistics of a curated table."""
    return save_analysis_tables(numeric(curated), path)
