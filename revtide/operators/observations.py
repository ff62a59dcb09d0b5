"""From raw rows to typed observations: parse, stamp, fill, deduplicate, combine."""

from __future__ import annotations

import datetime
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from revtide.functions.parsing import as_date, parse_date, parse_value, with_parsed_date
from revtide.schemas import RAW_PATCHED


def typed_observations(raw: DataFrame) -> DataFrame:
    """Parse dates and values of raw rows; the delivered text stays in ``value_str``."""
    return raw.withColumns({
        "date": parse_date(F.col("date")),
        "value_str": F.col("value"),
        "value": parse_value(F.col("value")),
    })


def to_snapshot(
    raw: DataFrame, vintage_date: str | datetime.date | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Raw rows as snapshot rows. Without ``vintage_date`` each row keeps its own vintage.

    ``keep`` names further raw columns, such as those that decide between duplicates.
    """
    day = as_date(vintage_date)
    vintage = F.lit(day) if day else parse_date(F.col("vintage_date"))
    return raw.select(
        "series_id",
        parse_date(F.col("date")).alias("date"),
        parse_value(F.col("value")).alias("value"),
        F.col("value").alias("value_str"),
        vintage.alias("vintage_date"),
        vintage.alias("realtime_start"),
        vintage.alias("realtime_end"),
        F.col("release_id").cast("int").alias("release_id"),
        F.current_timestamp().alias("etl_updated_at"),
        *keep,
    )


def stamp_run(
    df: DataFrame,
    vintage_date: str | datetime.date,
    release_id: int | None,
    etl_run_id: str,
    api_version: str,
) -> DataFrame:
    """Add the columns that say which run brought the rows in.

    ``release_id=None`` keeps the column of a frame that spans several releases.
    """
    stamps = {
        "vintage_date": F.lit(as_date(vintage_date)),
        "last_updated": F.current_timestamp(),
        "_etl_run_id": F.lit(etl_run_id),
        "_source_api_version": F.lit(api_version),
    }
    if release_id is not None:
        stamps["release_id"] = F.lit(release_id).cast("int")
    return with_parsed_date(df).withColumns(stamps)


def with_year_month(df: DataFrame) -> DataFrame:
    """Integer year and month of ``date``, from text or dates."""
    day = with_parsed_date(df).select("date").schema["date"].dataType
    parsed = F.col("date") if df.schema["date"].dataType == day else parse_date(F.col("date"))
    return df.withColumns({"year": F.year(parsed), "month": F.month(parsed)})


def fill_missing_columns(
    df: DataFrame, schema: StructType = RAW_PATCHED, defaults: dict[str, Column] | None = None
) -> DataFrame:
    """Add every column of ``schema`` that is absent, as its default or as a typed null."""
    defaults = defaults or {}
    return df.withColumns({
        field.name: defaults.get(field.name, F.lit(None)).cast(field.dataType)
        for field in schema.fields
        if field.name not in df.columns
    })


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key.

    Spark turns this filter on ``row_number`` into a group limit that also runs before the shuffle,
    so a hot key sends one row per task, not all of its rows.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def dedup_series_date(raw: DataFrame) -> DataFrame:
    """One row per (series, date): the last one collected, then the lowest release."""
    return first_per_key(raw, ["series_id", "date"], [
        F.desc_nulls_last("collected_at"), F.asc_nulls_last("release_id"),
        F.desc_nulls_last("vintage_date"), F.desc_nulls_last("value"),
    ])


def dedup_vintage_key(
    df: DataFrame, keys: Sequence[str] = ("series_id", "date", "vintage_date")
) -> DataFrame:
    """One row per (series, date, vintage): the last one collected, then the lowest release."""
    rest = [c for c in ("collected_at", "etl_updated_at") if c in df.columns]
    text = "value_str" if "value_str" in df.columns else "value"
    return first_per_key(df, keys, [
        *(F.desc_nulls_last(c) for c in rest),
        F.asc_nulls_last("release_id"), F.desc_nulls_last(text),
    ])


def union_releases(frames: Iterable[DataFrame]) -> DataFrame:
    """Stack release frames by column name; columns a frame lacks become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
