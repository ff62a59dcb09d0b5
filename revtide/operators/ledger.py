"""Ledgers of runs and of operations on tables, both append-only tables."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from revtide.operators.observations import first_per_key
from revtide.schemas import COLLECTION_HISTORY, OPERATIONS


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """The columns of a schema in its order and types; absent ones are null."""
    return df.select(*(
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ))


def run_records(runs: DataFrame) -> DataFrame:
    """Ledger rows from run facts; a finished run gets its duration."""
    duration = F.timestamp_diff("MICROSECOND", "started_at", "completed_at") / 1_000_000
    return conform(runs.withColumn("duration_seconds", duration), COLLECTION_HISTORY)


def run_record(
    spark: SparkSession,
    etl_run_id: str,
    release_id: int,
    started_at: datetime.datetime,
    completed_at: datetime.datetime | None = None,
    status: str = "running",
    **facts: object,
) -> DataFrame:
    """One ledger row; ``facts`` are further columns of the ledger."""
    unknown = set(facts) - set(COLLECTION_HISTORY.names)
    if unknown:
        raise ValueError(f"not columns of the ledger: {sorted(unknown)}")
    given = {
        "etl_run_id": etl_run_id, "release_id": release_id, "started_at": started_at,
        "completed_at": completed_at, "status": status, **facts,
    }
    if completed_at:
        given["duration_seconds"] = (completed_at - started_at).total_seconds()
    row = tuple(given.get(name) for name in COLLECTION_HISTORY.names)
    return spark.createDataFrame([row], COLLECTION_HISTORY)


def run_status(history: DataFrame) -> DataFrame:
    """Current state of each run: its last row, a finished row before a running one."""
    return first_per_key(history, ["etl_run_id", "release_id"], [
        F.desc(F.coalesce("completed_at", "started_at")),
        F.desc_nulls_last("completed_at"), F.asc("status"),
    ])


def runs_by_period(status: DataFrame, period: str = "yyyy-MM") -> DataFrame:
    """Runs per period of their start and final status."""
    label = F.date_format("started_at", period).alias("period")
    return status.groupBy(label, "status").agg(F.count("*").alias("runs"))


def operation_record(
    spark: SparkSession, table: str, operation: str, counts: dict[str, int]
) -> DataFrame:
    """One row of the ledger of operations."""
    row = (table, datetime.datetime.now(), operation, counts)
    return spark.createDataFrame([row], OPERATIONS)


def operation_counts(operations: DataFrame) -> DataFrame:
    """Per table and operation: how often it ran, when last, and the rows it wrote in all."""
    return operations.groupBy("table_name", "operation").agg(
        F.count("*").alias("operations"), F.max("done_at").alias("last_done"),
        F.sum("rows_written").alias("rows_written"),
    )


def newest_operations(operations: DataFrame, limit: int = 3, table: str | None = None) -> DataFrame:
    """The operations done last, on a table or on all of them."""
    if table:
        operations = operations.filter(F.col("table_name") == table)
    return operations.orderBy(F.desc("done_at"), "table_name").limit(limit)
