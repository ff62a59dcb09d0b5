"""Tables as directories of files.

Plain Parquet by default; ``fmt`` may name any installed file format. Replacing rows means
rewriting the partitions they are in, with dynamic partition overwrite: the old files of a
partition go away only when the job commits.

Tables by vintage and release have a directory for each release while these are few. Beyond that the
releases of a vintage share directories by a hash of their id, so that neither files nor what the driver lists and
renames grow with the number of releases. Which of the two a table has is seen from the names of its directories.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from revtide.operators.layout import cluster, compact
from revtide.operators.ledger import conform
from revtide.operators.statistics import release_statistics, series_coverage, value_statistics
from revtide.schemas import BUCKET, CLUSTER_COLUMNS, PARTITION_COLUMNS, schema_of
from revtide.session import stored

DEFAULT_FORMAT = "parquet"
COMPRESSION = "snappy"

BY_RELEASE, BY_BUCKET = ["vintage_date", "release_id"], ["vintage_date", BUCKET]
#: Releases that a write or a vintage may have with a directory for each, and the buckets of a vintage beyond that.
MOST_RELEASES = 512
RELEASE_BUCKETS = 64
#: Directories, and rows, that a task of an append should write at most where releases have a directory each.
TASK_DIRECTORIES, TASK_ROWS = 32, 1 << 20


def read_table(
    spark: SparkSession, path: str, schema: StructType | None = None, fmt: str = DEFAULT_FORMAT
) -> DataFrame:
    """Rows of a table; with a schema nothing is inferred from the files."""
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema else reader).load(path)


def first_file(spark: SparkSession, path: str) -> str | None:
    """A data file of a table, or None if there is none; no more directories are listed than lead to it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return None
    for status in system.listStatus(folder):
        name = status.getPath().getName()
        if name.startswith(".") or (name.startswith("_") and "=" not in name):
            continue
        inner = str(status.getPath())
        found = first_file(spark, inner) if status.isDirectory() else inner
        if found:
            return found
    return None


def table_exists(spark: SparkSession, path: str, fmt: str = DEFAULT_FORMAT) -> bool:
    """Whether a readable table is at the path.

    One file tells in most formats, so the directories of a large table are not all listed for it.
    """
    for place in (first_file(spark, path), path):
        try:
            if place:
                read_table(spark, place, fmt=fmt)
                return True
        except AnalysisException:
            pass
    return False


def ensure_table(spark: SparkSession, path: str, table: str, fmt: str = DEFAULT_FORMAT) -> bool:
    """Create an empty typed table unless there is one; tells whether it was created."""
    if table_exists(spark, path, fmt):
        return False
    spark.createDataFrame([], schema_of(table)).write.format(fmt).mode("append").save(path)
    return True


def append(df: DataFrame, path: str, table: str, fmt: str = DEFAULT_FORMAT) -> None:
    """Add rows to a known table, in its column order and types; rows of one directory are brought together first."""
    partitions = PARTITION_COLUMNS.get(table, [])
    rows = conform(df, schema_of(table))
    if partitions == BY_RELEASE:
        rows, partitions = sliced(rows, path, schema_of(table), fmt)
        rows = compact(rows, partitions) if BUCKET in partitions else spread(rows, partitions)
    writer = rows.write.format(fmt).mode("append")
    writer.option("compression", COMPRESSION).partitionBy(*partitions).save(path)


def spread(rows: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """Stored rows cut into even ranges of directories.

    Small directories cost their files, not their bytes, by which a rebalance would leave them all to a task or two. A
    large directory is cut as well.
    """
    sizes = rows.groupBy(*partitions).count()
    directories, count = sizes.agg(F.count("*"), F.coalesce(F.sum("count"), F.lit(0))).first()
    tasks = max(1, -(-directories // TASK_DIRECTORIES), -(-count // TASK_ROWS))
    return rows.repartitionByRange(tasks, *partitions, F.xxhash64(*rows.columns))


def release_bucket() -> Column:
    """Bucket of a row's release in a table whose releases share directories."""
    return F.pmod(F.xxhash64(F.col("release_id").cast("int")), F.lit(RELEASE_BUCKETS)).cast("int").alias(BUCKET)


def vintage_folders(spark: SparkSession, path: str) -> list:
    """Directories of a table's vintages; only names are listed."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    found = system.listStatus(folder) if system.exists(folder) else []
    return [s.getPath() for s in found if s.isDirectory() and s.getPath().getName().startswith("vintage_date=")]


def sliced_by(spark: SparkSession, path: str) -> tuple[list[str] | None, int]:
    """Partition columns of a table by vintage, or None while it has no rows, and the most directories of a vintage."""
    columns, most = None, 0
    for vintage in vintage_folders(spark, path):
        inner = vintage.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(vintage)
        most = max(most, len(inner))
        if columns is None and len(inner):
            columns = BY_BUCKET if inner[0].getPath().getName().startswith(f"{BUCKET}=") else BY_RELEASE
    return columns, most


def partitions_of(spark: SparkSession, path: str, table: str) -> list[str]:
    """Partition columns of a known table as it is stored."""
    partitions = PARTITION_COLUMNS.get(table, [])
    return (sliced_by(spark, path)[0] or partitions) if partitions == BY_RELEASE else partitions


def slice_layout(
    spark: SparkSession, path: str, releases: DataFrame, schema: StructType, fmt: str = DEFAULT_FORMAT,
    pieces: Callable[[], list[DataFrame]] | None = None,
) -> list[str]:
    """Partition columns that rows of these releases are to be written with.

    A table goes over to buckets, for good, before a write that has more than ``MOST_RELEASES`` releases or if one of its
    vintages has. Frames of it read before are then out of date. ``pieces`` are its rows by vintages
    with the columns to keep, by default all rows with those of the schema.
    """
    columns, most = sliced_by(spark, path)
    if columns == BY_BUCKET:
        return columns
    if most <= MOST_RELEASES:
        distinct = releases.select("release_id").distinct()
        if distinct.limit(MOST_RELEASES + 1).count() <= MOST_RELEASES:
            return BY_RELEASE
    if columns is not None:
        old = pieces() if pieces else [read_table(spark, path, schema, fmt).select(*schema.names)]
        old = [stored(in_layout(piece, BY_BUCKET), "old") for piece in old]
        for i, piece in enumerate(old):
            writer = compact(piece, BY_BUCKET).write.format(fmt).mode("append" if i else "overwrite")
            writer.option("partitionOverwriteMode", "static").option("compression", COMPRESSION).partitionBy(
                *BY_BUCKET
            ).save(path)
    return BY_BUCKET


def in_layout(rows: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """Rows with the bucket of their release if the partition columns name it."""
    return rows.withColumn(BUCKET, release_bucket()) if BUCKET in partitions else rows


def sliced(
    rows: DataFrame, path: str, schema: StructType, fmt: str = DEFAULT_FORMAT
) -> tuple[DataFrame, list[str]]:
    """Rows to be written by vintage and release, and the partition columns; computed once, into a stored table."""
    spark = rows.sparkSession
    if sliced_by(spark, path)[0] != BY_BUCKET:
        rows = stored(rows, "sliced")
    partitions = slice_layout(spark, path, rows, schema, fmt)
    return in_layout(rows, partitions), partitions


def overwrite_touched(
    df: DataFrame, path: str, partitions: Sequence[str], fmt: str = DEFAULT_FORMAT
) -> None:
    """Replace the partitions that occur in ``df`` and keep all others."""
    writer = df.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.option("compression", COMPRESSION).partitionBy(*partitions).save(path)


def overwrite_by_month(df: DataFrame, path: str, fmt: str = DEFAULT_FORMAT) -> None:
    """Rewrite a whole table partitioned by its year and month columns; the schema may change."""
    rows = compact(df, ["year", "month"])
    writer = rows.write.format(fmt).mode("overwrite").option("overwriteSchema", True)
    writer.option("partitionOverwriteMode", "static").option("compression", COMPRESSION).partitionBy(
        "year", "month"
    ).save(path)


def remove(spark: SparkSession, path) -> None:
    """Delete a directory, a path or a Java URI, in whatever file system it is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def save(df: DataFrame, path: str, fmt: str = DEFAULT_FORMAT) -> None:
    """Write a table without partitions, replacing what is there."""
    df.write.format(fmt).mode("overwrite").save(path)


def save_json(df: DataFrame, path: str) -> None:
    """Write rows as JSON lines."""
    df.write.mode("overwrite").json(path)


def save_analysis_tables(df: DataFrame, path: str) -> dict[str, str]:
    """Persist coverage, value and release statistics; returns their paths."""
    tables = {
        "series_coverage": series_coverage(df),
        "value_statistics": value_statistics(df),
        "release_statistics": release_statistics(df),
    }
    for name, frame in tables.items():
        save(frame, f"{path}/{name}")
    return {name: f"{path}/{name}" for name in tables}


def optimize_table(
    spark: SparkSession, path: str, table: str, files: int | None = None
) -> None:
    """Rewrite a table in place, clustered if it has cluster columns, else compacted.

    Directories are replaced as a whole when the job commits. A table without partitions cannot be
    read while it is replaced, so its new rows are stored first.
    """
    rows = read_table(spark, path)
    partitions = [c for c in partitions_of(spark, path, table) if c in rows.columns]
    columns = [c for c in CLUSTER_COLUMNS.get(table, []) if c in rows.columns]
    if columns:
        laid_out = cluster(rows, columns, partitions, files)
    else:
        laid_out = compact(rows, partitions)
    if partitions:
        overwrite_touched(laid_out, path, partitions)
    else:
        save(stored(laid_out, "optimized"), path)


def table_info(df: DataFrame) -> DataFrame:
    """Files, columns, rows and distinct series of a table, as (metric, value) rows."""
    found = df.select(F.col("_metadata.file_path").alias("_path"), "series_id").agg(
        F.count_distinct("_path").alias("files"), F.count("*").alias("rows"),
        F.count_distinct("series_id").alias("series"),
        F.lit(len(df.columns)).cast("bigint").alias("columns"),
    )
    metrics = [F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in found.columns]
    return found.select(F.inline(F.array(*metrics)))
