"""What the corpus operators share: words, packed rows, batch sizes, ranks over whole tables."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revtide.session import stored

#: A word of the contracts: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Texts per Arrow batch, and bytes: a few long texts fill one.
TEXTS_PER_BATCH = 256
ROWS_PER_BATCH = 20_000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
ROWS_PER_TEXT_BATCH = 2_000
BYTES_PER_BATCH = 4_000_000
_BATCH_DEFAULT = "10000"
_BYTES_DEFAULT = "67108864b"


def text_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of whole texts small, in rows and bytes, unless the session has sizes of its own."""
    if spark.conf.get(_BATCH) == _BATCH_DEFAULT:
        spark.conf.set(_BATCH, TEXTS_PER_BATCH)
    if spark.conf.get(_BATCH_BYTES) == _BYTES_DEFAULT:
        spark.conf.set(_BATCH_BYTES, BYTES_PER_BATCH)


@contextlib.contextmanager
def narrow_batches(spark: SparkSession) -> Iterator[None]:
    """Larger batches for jobs on a few numbers per row, which run inside the block."""
    before = spark.conf.get(_BATCH)
    spark.conf.set(_BATCH, ROWS_PER_BATCH)
    try:
        yield
    finally:
        spark.conf.set(_BATCH, before)


@contextlib.contextmanager
def text_bytes(spark: SparkSession) -> Iterator[None]:
    """Batches of whole texts bounded by their size, for jobs that run inside the block."""
    before = {key: spark.conf.get(key) for key in (_BATCH, _BATCH_BYTES)}
    spark.conf.set(_BATCH, ROWS_PER_TEXT_BATCH)
    spark.conf.set(_BATCH_BYTES, BYTES_PER_BATCH)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def word_count(text: Column) -> Column:
    """Words of a text as a long; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def packed(df: DataFrame, **columns: Column) -> DataFrame:
    """All columns of a frame as one struct ``row`` beside computed ones.

    Whatever columns a user's frame has, none can clash with those an operator adds.
    """
    whole = F.struct(*[df[f"`{c}`"] for c in df.columns])
    return df.select(whole.alias("row"), *[c.alias(name) for name, c in columns.items()])


def ranked(
    df: DataFrame, within: Sequence[str], order: Sequence[Column], rank: str = "rank"
) -> DataFrame:
    """Rows with their place (from 1) within a group, also if one group holds most rows.

    Rows are range-partitioned by (group, order), so that a group spans as many tasks as it needs, and
    stored. A row's place is its place in its partition plus the rows its group has in earlier
    partitions; only those counts, one row per (partition, group), go through a window.
    """
    by = [*(F.col(c).asc_nulls_last() for c in within), *order]
    placed = df.repartitionByRange(*by).sortWithinPartitions(*by)
    placed = stored(placed.withColumn("_at", F.monotonically_increasing_id()), "ranked")
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    keys = {f"_key{i}": F.col(c) for i, c in enumerate(within)}
    counts = placed.groupBy("_part", *[c.alias(k) for k, c in keys.items()]).agg(
        F.count("*").alias("_rows"), F.min("_at").alias("_first")
    )
    earlier = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = stored(
        counts.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
        .withColumnRenamed("_part", "_of").drop("_rows"),
        "offsets",
    )
    same = placed["_part"] == offsets["_of"]
    for key, column in zip(keys, within):
        same &= placed[column].eqNullSafe(offsets[key])
    place = F.col("_at") - F.col("_first") + F.col("_before") + 1
    return placed.join(offsets, same).select(*df.columns, place.alias(rank))
