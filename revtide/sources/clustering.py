"""Clustering a stored table piece by piece.

Beside a table lies a record of its layout: per partition a fingerprint of the files that the last clustering left.
Listing files reads no column. Partitions whose files are the recorded ones are left alone, all others are read,
clustered together and replaced. A run that ends before its record is written is done again by the next one.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from revtide.operators.layout import bits_for, cluster
from revtide.session import stored
from revtide.sources.mutation import within
from revtide.sources.tables import overwrite_touched, read_table, save, table_exists


def layout_of(rows: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """(partition columns, files, bytes, fingerprint) of every partition of a stored table."""
    files = rows.select(
        *partitions, F.col("_metadata.file_name").alias("_file"), F.col("_metadata.file_size").alias("_size")
    ).groupBy(*partitions, "_file").agg(F.max("_size").alias("_size"))
    return files.groupBy(*partitions).agg(
        F.count("*").alias("files"), F.sum("_size").alias("bytes"),
        F.bit_xor(F.xxhash64("_file", "_size")).alias("fingerprint"),
    )


def unrecorded(layout: DataFrame, record: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """Partitions of a layout that have other files than their record, or none; null is a partition too."""
    known = record.select(*[F.col(p).alias(f"_{p}") for p in partitions], F.col("fingerprint").alias("_fingerprint"))
    same = [layout[p].eqNullSafe(known[f"_{p}"]) for p in partitions]
    same.append(layout["fingerprint"] == known["_fingerprint"])
    return layout.join(known, reduce(lambda a, b: a & b, same), "left_anti")


def cluster_stored(
    spark: SparkSession, path: str, record: str, columns: Sequence[str], partitions: Sequence[str],
    schema: StructType | None = None,
) -> dict[str, int]:
    """Cluster the partitions that changed since the last call; returns how many, and their files and bytes before.

    The number of ranges of a column follows from the bytes to be rewritten. An empty table has nothing to cluster.
    """
    rows = read_table(spark, path, schema)
    changed = stored(layout_of(rows, partitions), "layout")
    if table_exists(spark, record) and set(partitions) <= set(read_table(spark, record).columns):
        changed = stored(unrecorded(changed, read_table(spark, record), partitions), "changed")
    found = changed.agg(F.count("*"), F.sum("files"), F.sum("bytes")).first()
    counts = dict(zip(("partitions", "files", "bytes"), (n or 0 for n in found)))
    if counts["partitions"]:
        touched = within(rows, changed, partitions)
        laid_out = cluster(touched, columns, partitions, bits=bits_for(counts["bytes"], len(columns)))
        overwrite_touched(laid_out, path, partitions)
        save(layout_of(read_table(spark, path, schema), partitions), record)
    return counts
