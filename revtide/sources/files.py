"""Files of a landing zone one by one: which can be read, and the rows of those that can.

Spark either fails on a broken file or, told to ignore such files, drops what it cannot read without a word, and
keeps the rows before the damage. Here every file is read through in a task of its own first.
This is the one place of the library (beside the corpus operators) that runs Python in tasks: no built-in
source tells a broken file from an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from revtide.schemas import RAW
from revtide.session import stored

PROBED = "file string, vintage_date string, release_id string, bytes long, rows long, error string"
ERROR_CHARS = 300


def _probe(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        found = []
        for content in frame["content"]:
            rows, error = 0, None
            try:
                file = pq.ParquetFile(pa.BufferReader(content))
                for batch in file.iter_batches():
                    rows += batch.num_rows
            except (pa.ArrowException, OSError, ValueError) as problem:
                error = f"{type(problem).__name__}: {problem}"[:ERROR_CHARS]
            found.append((rows, error))
        out = frame.drop(columns="content")
        yield out.assign(rows=[r for r, _ in found], error=[e for _, e in found])


def probe_files(spark: SparkSession, path: str, wanted: Column | None = None) -> DataFrame:
    """Every file below ``path``, stored: its directory's vintage and release, rows, and why it cannot be read.

    ``wanted`` picks directories by vintage_date and release_id. A file is held by one task
    at a time; it must be smaller than two gigabytes, as landed files are.
    """
    listed = spark.read.format("binaryFile").load(path)
    if wanted is not None:
        listed = listed.filter(wanted)
    named = {
        c: F.col(c).cast("string") if c in listed.columns else F.lit(None).cast("string")
        for c in ("vintage_date", "release_id")
    }
    files = listed.select(
        F.col("_metadata.file_path").alias("file"), *[c.alias(n) for n, c in named.items()],
        F.col("length").alias("bytes"), "content",
    )
    return stored(files.mapInPandas(_probe, PROBED), "files")


def read_readable(
    spark: SparkSession, path: str, files: DataFrame, schema: StructType = RAW
) -> DataFrame:
    """Rows of the files that ``probe_files`` could read through; none of a file it could not."""
    bad = stored(files.filter("error IS NOT NULL").select(F.col("file").alias("_file")), "bad")
    rows = spark.read.schema(schema).option("ignoreCorruptFiles", True).parquet(path)
    kept = rows.select(*schema.names, F.col("_metadata.file_path").alias("_file")).join(bad, "_file", "left_anti")
    return kept.drop("_file")


def file_counts(files: DataFrame) -> DataFrame:
    """Per vintage: files, rows of the readable ones, and how many cannot be read with the first reason."""
    bad = F.col("error").isNotNull()
    return files.groupBy("vintage_date").agg(
        F.count("*").alias("files"), F.count_if(bad).alias("bad_files"),
        F.sum(F.when(bad, 0).otherwise(F.col("rows"))).alias("rows"), F.min("error").alias("error"),
    )
