"""How rows are laid out in files, and row-level mutation by rewriting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, MapType, NumericType, TimestampType

from revtide.functions.clustering import bucket_of, interleave_bits

CLUSTER_BITS = 6
#: Bytes that a file of a clustered table should have, and the bits of a key at least and at most.
FILE_BYTES = 128 << 20
LEAST_BITS, MOST_BITS = 2, 8


def repartition_by_series(df: DataFrame) -> DataFrame:
    """Bring the rows of a series together before a write.

    A rebalance hint: adaptive execution merges small partitions and splits a series that is too
    big for one, so there is no partition count to guess.
    """
    return df.hint("rebalance", "series_id")


def compact(df: DataFrame, partition_columns: Sequence[str] = ()) -> DataFrame:
    """Rows regrouped into evenly sized partitions, one directory's rows together."""
    return df.hint("rebalance", *partition_columns)


def range_bounds(df: DataFrame, column: str, buckets: int) -> list:
    """At most ``buckets - 1`` values that cut the rows of a column into even ranges.

    Numbers and dates by approximate percentiles; other types by the ranges Spark cuts them into. Either
    way all rows weigh in, and only the bounds reach the driver.
    """
    values = df.select(F.col(column).alias("_value")).filter(F.col("_value").isNotNull())
    if isinstance(df.schema[column].dataType, (NumericType, DateType, TimestampType)):
        shares = [i / buckets for i in range(1, buckets)]
        found = values.agg(F.percentile_approx("_value", shares)).first()[0] or []
    else:
        ranged = values.repartitionByRange(buckets, "_value")
        firsts = ranged.groupBy(F.spark_partition_id()).agg(F.min("_value").alias("_value"))
        found = sorted(row["_value"] for row in firsts.select("_value").collect())[1:]
    return sorted(set(found))


def bits_for(size: int, columns: int) -> int:
    """Bits per column for rows of so many bytes: four times as many ranges a column as the files need."""
    files = max(1, -(-size // FILE_BYTES))
    return min(MOST_BITS, max(LEAST_BITS, -(-(files - 1).bit_length() // columns) + 2))


def cluster_key(df: DataFrame, columns: Sequence[str], bits: int = CLUSTER_BITS) -> Column:
    """Space-filling key: rows near each other in all columns get near keys. Reads the columns."""
    buckets = [bucket_of(F.col(c), range_bounds(df, c, 1 << bits)) for c in columns]
    return interleave_bits(buckets, bits)


def cluster(
    df: DataFrame,
    columns: Sequence[str],
    partition_columns: Sequence[str] = (),
    files: int | None = None,
    bits: int = CLUSTER_BITS,
) -> DataFrame:
    """Rows range-partitioned and sorted along the key, so files cover narrow ranges of each column.

    Partition columns come first in the ranges: a task then writes to one or two directories, not
    to all of them. A hash of the row comes last: rows that share all clustered columns can still
    be cut into several tasks.
    """
    order = [*(F.col(c) for c in partition_columns), F.col("_cluster"), *(F.col(c) for c in columns)]
    hashable = [f.name for f in df.schema.fields if not isinstance(f.dataType, MapType)]
    keyed = df.withColumn("_cluster", cluster_key(df, columns, bits))
    ranges = [*order, F.xxhash64(*hashable)]
    ranged = keyed.repartitionByRange(files, *ranges) if files else keyed.repartitionByRange(*ranges)
    return ranged.sortWithinPartitions(*order).drop("_cluster")


def update_where(df: DataFrame, condition: Column, values: dict[str, Column]) -> DataFrame:
    """Set columns in the rows where the condition holds."""
    return df.withColumns({
        name: F.when(condition, value).otherwise(F.col(name)) for name, value in values.items()
    })


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Drop the rows where the condition holds; an unknown condition keeps the row."""
    return df.filter(~F.coalesce(condition, F.lit(False)))
