"""Ingesting raw vintages into the snapshots table."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StringType, StructField, StructType

from revtide.functions.parsing import as_date, parse_date
from revtide.operators.layout import compact
from revtide.operators.observations import dedup_vintage_key, to_snapshot
from revtide.operators.upserts import upsert_snapshot
from revtide.operators.vintages import KEY
from revtide.schemas import BUCKET, BUCKET_KEYS, SNAPSHOTS, schema_of
from revtide.session import observed, stored
from revtide.sources.files import file_counts, probe_files
from revtide.sources.raw import read_raw
from revtide.sources.mutation import with_neighbours
from revtide.sources.tables import (
    BY_BUCKET,
    ensure_table,
    in_layout,
    overwrite_touched,
    read_table,
    slice_layout,
    table_exists,
)

Day = str | datetime.date

#: Buckets of an upserted table. It stays as it is once the table exists, as rows are found by it.
BUCKETS = 64


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """The snapshots table."""
    return read_table(spark, path, SNAPSHOTS).select(*SNAPSHOTS.names)


def landed_vintages(raw: DataFrame) -> DataFrame:
    """The vintages present in the landing zone."""
    return raw.select(parse_date(F.col("vintage_date")).alias("vintage_date")).distinct()


def ingest_vintages(
    spark: SparkSession, raw_path: str, table_path: str, vintages: Sequence[Day] | None = None
) -> DataFrame:
    """Upsert landed vintages (default: all) into the snapshots table in one job.

    Returns raw_count, inserted and updated per vintage; see ``ingest_counts`` for all figures. Only the directories of those vintages are
    read and rewritten, and a row is updated only if its value changed. Releases may share a series. Of several
    rows of a release's point the one collected last counts. Rows without a release, a series or a
    date cannot be keyed and stay in the landing zone. What happened to a row is kept next to it in
    a column outside the table's schema, so counting reads one small column and nothing is computed
    twice.
    """
    counts = ingest_counts(spark, raw_path, table_path, vintages)
    return counts.select("vintage_date", "raw_count", "inserted", "updated")


def ingest_counts(
    spark: SparkSession, raw_path: str, table_path: str, vintages: Sequence[Day] | None = None
) -> DataFrame:
    """``ingest_vintages`` with all figures of each vintage.

    Beside raw_count, inserted and updated: rows ``rejected`` for want of a release, a series or a date,
    ``duplicates`` of other rows, and rows that left the table ``unchanged``. Raw rows are counted from
    the columns of the key alone.
    """
    ensure_table(spark, table_path, "snapshots")
    raw = read_raw(spark, raw_path)
    if vintages is not None:
        raw = raw.filter(F.col("vintage_date").isin([as_date(v).isoformat() for v in vintages]))
    partitions = slice_layout(spark, table_path, raw, SNAPSHOTS)
    target = read_snapshots(spark, table_path)
    if vintages is None:
        days = stored(landed_vintages(raw), "vintages")
        target = target.join(days, "vintage_date", "left_semi")
    else:
        target = target.filter(F.col("vintage_date").isin([as_date(v) for v in vintages]))
    typed = to_snapshot(raw, keep=["collected_at"]).dropna(subset=KEY)
    source = dedup_vintage_key(typed, [*KEY, "vintage_date"]).drop("collected_at")
    merged = upsert_snapshot(target, source)
    if partitions == BY_BUCKET and vintages is None:
        # Rows of a known vintage are all in ``merged``, those of vintages that are no date are not.
        undated = stored(typed.filter("vintage_date IS NULL").select("release_id", "vintage_date").distinct(), "undated")
        merged = with_neighbours(merged, table_path, undated, SNAPSHOTS)
    laid_out = compact(in_layout(merged, partitions), partitions)
    laid_out = laid_out.sortWithinPartitions(*partitions, "release_id", "series_id", "date")
    overwrite_touched(laid_out, table_path, partitions)
    unkeyed = F.col("release_id").isNull() | F.col("series_id").isNull() | parse_date(F.col("date")).isNull()
    landed = raw.groupBy(parse_date(F.col("vintage_date")).alias("vintage_date")).agg(
        F.count("*").alias("raw_count"), F.count_if(unkeyed).alias("rejected")
    )
    done = read_table(
        spark, table_path, StructType().add("vintage_date", DateType()).add("_action", StringType())
    ).groupBy("vintage_date").agg(
        F.count_if(F.col("_action") == "inserted").alias("inserted"),
        F.count_if(F.col("_action") == "updated").alias("updated"),
        F.count_if(F.col("_action") == "unchanged").alias("unchanged"),
    )
    counts = landed.join(done, "vintage_date", "left").fillna(0)
    points = F.col("inserted") + F.col("updated") + F.col("unchanged")
    return counts.withColumn("duplicates", F.col("raw_count") - F.col("rejected") - points)


def ingest_isolated(
    spark: SparkSession, raw_path: str, table_path: str, vintages: Sequence[Day] | None = None
) -> DataFrame:
    """Ingest the vintages that can be ingested, in one job, and say for each what became of it.

    Returns per vintage: status (``success`` or ``failed``), error, files, bad_files and the figures of
    ``ingest_counts``. A vintage fails as a whole, and its directories in the table stay as they are, if one of
    its files cannot be read through, if its name is no date, or if none of its rows has a release, a series and
    a date. The others go on. Asked for and not landed is a failure, too. Repeating the job
    after a repair ingests what failed.
    """
    wanted = None
    if vintages is not None:
        names = [as_date(v).isoformat() for v in vintages]
        wanted = F.col("vintage_date").cast("string").isin(names)
    files = file_counts(probe_files(spark, raw_path, wanted))
    if vintages is not None:
        asked = spark.createDataFrame([(n,) for n in names], "vintage_date string").distinct()
        files = asked.join(files, "vintage_date", "left").fillna(0)
    named = files.withColumnRenamed("vintage_date", "name").withColumn("vintage_date", parse_date(F.col("name")))
    problem = (
        F.when(F.col("files") == 0, "not landed")
        .when(F.col("vintage_date").isNull(), "the vintage is no date")
        .when(F.col("bad_files") > 0, F.concat_ws(
            " ", "bad_files", F.lit("of"), "files", F.lit("files cannot be read:"), "error"))
    )
    judged = stored(named.withColumn("error", problem), "probed")
    sound = [r["name"] for r in judged.filter("error IS NULL").select("name").collect()]
    raw = read_raw(spark, raw_path).filter(F.col("vintage_date").isin(sound))
    keyed = raw.filter(F.col("release_id").isNotNull() & F.col("series_id").isNotNull())
    keyed = keyed.filter(parse_date(F.col("date")).isNotNull()).groupBy("vintage_date").agg(F.lit(True).alias("keyed"))
    keyed = stored(keyed.select(F.col("vintage_date").alias("name"), "keyed"), "keyed")
    good = [r["name"] for r in keyed.collect()]
    judged = judged.join(keyed, "name", "left").withColumn("error", F.coalesce("error", F.when(
        F.col("keyed").isNull(), "no row has a release, a series and a date")))
    figures = ["raw_count", "rejected", "duplicates", "inserted", "updated", "unchanged"]
    done = stored(ingest_counts(spark, raw_path, table_path, good).select("vintage_date", *figures), "ingested")
    status = judged.join(done, "vintage_date", "left").withColumns({
        "status": F.when(F.col("error").isNull(), "success").otherwise("failed"),
        "raw_count": F.coalesce("raw_count", "rows"),
    })
    return status.select(
        "name", "vintage_date", "status", "error", "files", "bad_files",
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in figures],
    )


def ingest_vintage(
    spark: SparkSession, raw_path: str, table_path: str, vintage_date: Day
) -> DataFrame:
    """``ingest_vintages`` for a single vintage."""
    return ingest_vintages(spark, raw_path, table_path, [vintage_date])


def bucket_of(key: str, buckets: int = BUCKETS) -> Column:
    """Bucket of a row of an upserted table: a hash of its key."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias(BUCKET)


def upsert_table(
    spark: SparkSession, source: DataFrame, table_path: str, table: str, upsert, key: str | None = None
) -> dict[str, int]:
    """Run an upsert operator against a table laid out in hash buckets of its key; returns the counts.

    Only the buckets of the source's keys are read and replaced, when the job commits: one that fails leaves all
    old rows. The counts are observed by the job that writes. A table without buckets is laid out in them first.
    """
    key = key or BUCKET_KEYS[table]
    rows = _bucketed(spark, table_path, table, key)
    # Stored, so that one evaluation of the source names the buckets and is merged.
    source = stored(source.withColumn(BUCKET, bucket_of(key)), "source")
    touched = [r[0] for r in source.select(BUCKET).distinct().collect()]
    merged = upsert(rows.filter(F.col(BUCKET).isin(touched)), source)
    done = Observation()
    action = F.col("_action")
    counted = merged.observe(
        done, *[F.count_if(action == name).alias(name) for name in ("inserted", "updated", "unchanged")],
        F.count_if(action != "kept").alias("total_processed"),
    )
    if touched:
        overwrite_touched(compact(counted.drop("_action"), [BUCKET]), table_path, [BUCKET])
        seen = observed(done)
        return {name: seen[name] for name in ("inserted", "updated", "unchanged", "total_processed")}
    return dict.fromkeys(("inserted", "updated", "unchanged", "total_processed"), 0)


def _bucketed(spark: SparkSession, path: str, table: str, key: str) -> DataFrame:
    """A table with its buckets. One that is new or has none yet is written in buckets."""
    schema = schema_of(table)
    whole = StructType([*schema.fields, StructField(BUCKET, IntegerType())])
    if not table_exists(spark, path) or BUCKET not in read_table(spark, path).columns:
        ensure_table(spark, path, table)
        old = stored(read_table(spark, path, schema).select(*schema.names).withColumn(BUCKET, bucket_of(key)), "old")
        old.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(BUCKET).parquet(path)
    return read_table(spark, path, whole)
