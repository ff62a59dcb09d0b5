"""Keyed upserts on plain tables: one full outer join decides and counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revtide.operators.vintages import KEY


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Sequence[str] | None = None,
    when_different: Sequence[str] = (),
) -> DataFrame:
    """Target after the upsert, with an ``_action`` column saying what happened to each row.

    ``update`` lists the columns a matched row takes from the source (default: every column; one
    the source lacks becomes null). With ``when_different`` a matched row is updated only if one of
    those columns differs, nulls included. Actions: inserted, updated, unchanged, kept. Keys must
    be unique on both sides, which also keeps the join free of skew.
    """
    keys = list(keys)
    columns = [*target.columns, *(c for c in source.columns if c not in target.columns)]
    update = [c for c in columns if c not in keys] if update is None else list(update)
    joined = _packed(target, keys, "_t").join(_packed(source, keys, "_s"), keys, "full_outer")
    differs = F.lit(not when_different)
    for name in when_different:
        differs = differs | ~F.col(f"_t.{name}").eqNullSafe(F.col(f"_s.{name}"))
    action = (
        F.when(F.col("_t").isNull(), "inserted")
        .when(F.col("_s").isNull(), "kept")
        .when(differs, "updated")
        .otherwise("unchanged")
    )

    def pick(name: str) -> Column:
        if name in keys:
            return F.col(name)
        old = _field(target, "_t", name)
        new = _field(source, "_s", name)
        takes_new = [F.lit("inserted"), F.lit("updated")] if name in update else [F.lit("inserted")]
        return F.when(F.col("_action").isin(*takes_new), new).otherwise(old).alias(name)

    return joined.withColumn("_action", action).select(*map(pick, columns), "_action")


def upsert_series_metadata(target: DataFrame, source: DataFrame) -> DataFrame:
    """Upsert on series_id that replaces every column."""
    return upsert(target, source, ["series_id"])


def upsert_release_metadata(target: DataFrame, source: DataFrame) -> DataFrame:
    """Upsert on release_id that replaces only the columns the source has."""
    return upsert(target, source, ["release_id"], [c for c in source.columns if c != "release_id"])


def upsert_snapshot(target: DataFrame, source: DataFrame) -> DataFrame:
    """Upsert on (release, series, date, vintage) that touches a row only if its value changed."""
    update = [c for c in ("value", "value_str", "etl_updated_at") if c in source.columns]
    return upsert(
        target, source, [*KEY, "vintage_date"], update, when_different=["value"]
    )


def upsert_counts(upserted: DataFrame) -> DataFrame:
    """One row: source rows that were inserted, updated, left unchanged, and their total."""
    action = F.col("_action")
    return upserted.agg(
        F.count_if(action == "inserted").alias("inserted"),
        F.count_if(action == "updated").alias("updated"),
        F.count_if(action == "unchanged").alias("unchanged"),
        F.count_if(action != "kept").alias("total_processed"),
    )


def _packed(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    return df.select(*keys, F.struct(F.lit(True).alias("_present"), *rest).alias(name))


def _field(df: DataFrame, side: str, name: str) -> Column:
    return F.col(f"{side}.{name}") if name in df.columns else F.lit(None)
