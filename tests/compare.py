"""Compare registered queries with their SQL: ``python tests/compare.py [sf_dir] [query ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as spark_entry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def session() -> SparkSession:
    return (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.maxMetadataStringLength", "10000")
        .getOrCreate()
    )


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


# DuckDB's name of each Spark type that a registered query may return.
TYPES = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
    "date": "DATE", "boolean": "BOOLEAN",
}


# No query crosses its inputs or runs Python per row.
BANNED = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"]


def in_order(names: list[str], rows: list) -> list[tuple]:
    """Rows with columns by name, in an order that does not depend on the engine."""
    places = [names.index(n) for n in sorted(names)]
    return sorted((tuple(row[p] for p in places) for row in rows), key=repr)


def difference(spark: SparkSession, con, name: str, sf_dir: str) -> str | None:
    """What differs between a query and its SQL, or which banned node its plan has, or None."""
    text = spark_entry.oracle_sql()[name]
    got = spark_entry.queries()[name](spark, sf_dir)
    plan = got._jdf.queryExecution().executedPlan().toString()
    found = [node for node in BANNED if node in plan]
    if found:
        return f"plan: {found}"
    wanted = {row[0]: row[1] for row in con.execute(f"DESCRIBE {text}").fetchall()}
    found = {f.name: TYPES.get(f.dataType.simpleString(), "?") for f in got.schema.fields}
    if found != wanted:
        return f"schema: {sorted(found.items())} <> {sorted(wanted.items())}"
    left = in_order(got.columns, got.collect())
    right = in_order(list(wanted), con.execute(text).fetchall())
    if len(left) != len(right):
        return f"rows: {len(left)} <> {len(right)}"
    bad = [(a, b) for a, b in zip(left, right) if a != b]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else None


def main(sf_dir: str = "/root/testdata/sf0.01", *names: str) -> int:
    spark, con, failed = session(), connect(sf_dir), 0
    spark.sparkContext.setLogLevel("ERROR")
    for name in names or spark_entry.queries():
        begin = time.time()
        try:
            problem = difference(spark, con, name, sf_dir)
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok':4} {time.time() - begin:6.2f}s {name} {problem or ''}",
              flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(min(main(*sys.argv[1:]), 1))
