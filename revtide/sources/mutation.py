"""Changing and deleting rows of a stored table, partition by partition.

The partitions that hold matching rows are found first, from the columns of the condition; only their directories
are read whole and rewritten. All others keep their files.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from revtide.operators.layout import compact, update_where
from revtide.schemas import BUCKET
from revtide.session import stored
from revtide.sources.tables import BY_BUCKET, BY_RELEASE, in_layout, overwrite_touched, read_table, remove, sliced_by


def update_stored(
    spark: SparkSession, path: str, partitions: Sequence[str], condition: Column,
    values: dict[str, Column], schema: StructType | None = None,
) -> dict[str, int]:
    """Set columns where the condition holds; returns the rows updated and the partitions rewritten.

    Partition columns cannot be set: that would move rows. An unknown condition changes nothing.
    """
    moved = set(values) & {*partitions, *(BY_RELEASE if partitions == BY_BUCKET else [])}
    if moved:
        raise ValueError(f"partition columns cannot be updated: {sorted(moved)}")
    rows, touched = _touched(spark, path, partitions, condition, schema)
    counts = _counts(touched, "updated")
    if counts["updated"]:
        changed = update_where(within(rows, touched, partitions), _known(condition), values)
        overwrite_touched(compact(changed, partitions), path, partitions)
    return counts


def delete_stored(
    spark: SparkSession, path: str, partitions: Sequence[str], condition: Column,
    schema: StructType | None = None,
) -> dict[str, int]:
    """Delete the rows where the condition holds; returns the rows deleted and the partitions rewritten.

    A partition that loses all its rows loses its directory. An unknown condition deletes nothing.
    """
    rows, touched = _touched(spark, path, partitions, condition, schema)
    counts = _counts(touched, "deleted")
    if not counts["deleted"]:
        return counts
    kept = within(rows, touched, partitions).filter(~_known(condition))
    left = stored(kept.select(*partitions).distinct(), "left").withColumnsRenamed({p: f"_{p}" for p in partitions})
    same = [touched[p].eqNullSafe(left[f"_{p}"]) for p in partitions]
    emptied = stored(touched.join(left, same, "left_anti").select("_folder"), "emptied")
    overwrite_touched(compact(kept, partitions), path, partitions)
    for (folder,) in emptied.toLocalIterator():
        remove(spark, spark._jvm.java.net.URI(folder))
    return counts


def _known(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def _touched(
    spark: SparkSession, path: str, partitions: Sequence[str], condition: Column, schema: StructType | None
) -> tuple[DataFrame, DataFrame]:
    """The table, and its partitions with matching rows: how many, and their directory. Stored."""
    rows = read_table(spark, path, schema)
    folder = F.regexp_extract("_metadata.file_path", "^(.*)/[^/]*$", 1)
    # Filters on hidden columns of the files stand above the scan, the condition itself is pushed into it.
    matched = rows.withColumn("_folder", folder).filter(condition)
    return rows, stored(matched.groupBy(*partitions, "_folder").agg(F.count("*").alias("_rows")), "touched")


def _counts(touched: DataFrame, name: str) -> dict[str, int]:
    found = touched.agg(F.sum("_rows"), F.count("*")).first()
    return {name: found[0] or 0, "partitions": found[1]}


def within(rows: DataFrame, touched: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """Rows of the touched partitions. A plain join on partition columns lets Spark skip other directories."""
    names = touched.select(*[F.col(p).alias(f"_{p}") for p in partitions])
    known = reduce(lambda a, b: a & b, [F.col(f"_{p}").isNotNull() for p in partitions])
    plain = [rows[p] == names[f"_{p}"] for p in partitions]
    found = rows.join(names.filter(known), plain, "left_semi")
    unknown = names.filter(~known)
    if not unknown.isEmpty():
        safe = [rows[p].eqNullSafe(unknown[f"_{p}"]) for p in partitions]
        found = found.unionByName(rows.join(unknown, safe, "left_semi"))
    return found


def with_neighbours(rows: DataFrame, path: str, slices: DataFrame, schema: StructType) -> DataFrame:
    """Rows that replace (release, vintage) slices of a table in buckets, and the rows of other slices in their directories.

    Writing them over the touched directories replaces the slices and keeps the others. Needs slices that cost little.
    """
    spark = rows.sparkSession
    rows = in_layout(rows, BY_BUCKET)
    if sliced_by(spark, path)[0] is None:
        return rows
    slices = slices.select(*[F.col(c).cast(schema[c].dataType).alias(c) for c in BY_RELEASE]).distinct()
    touched = stored(in_layout(slices, BY_BUCKET).select(*BY_BUCKET).distinct(), "touched")
    there = within(read_table(spark, path, schema).select(*schema.names, BUCKET), touched, BY_BUCKET)
    names = slices.select(*[F.col(c).alias(f"_{c}") for c in BY_RELEASE])
    others = there.join(names, [there[c].eqNullSafe(names[f"_{c}"]) for c in BY_RELEASE], "left_anti")
    return rows.unionByName(others, allowMissingColumns=True)
