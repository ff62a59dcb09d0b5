"""The landing zone: raw Parquet per vintage and release, JSON payload pages, worklists."""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from revtide.functions.parsing import as_date
from revtide.operators.collection import DEFAULT_RELEASES
from revtide.operators.layout import compact
from revtide.operators.observations import first_per_key
from revtide.schemas import BUCKET, PAYLOAD_PAGE, RAW, RAW_PATCHED
from revtide.session import stored
from revtide.sources.mutation import with_neighbours
from revtide.sources.tables import BY_BUCKET, BY_RELEASE, overwrite_touched, slice_layout, vintage_folders

LANDING_PARTITIONS = BY_RELEASE


def read_raw(
    spark: SparkSession, path: str, vintage_date: str | None = None, skip_corrupt: bool = False,
    schema: StructType = RAW,
) -> DataFrame:
    """All raw rows below a path, or those of one vintage; ``RAW_PATCHED`` reads the release date too.

    The schema is given, so columns a file lacks become null. Unreadable files fail the job unless ``skip_corrupt`` is set.
    """
    reader = spark.read.schema(schema).option("ignoreCorruptFiles", skip_corrupt)
    raw = reader.parquet(path).select(*schema.names)
    if vintage_date is None:
        return raw
    return raw.filter(F.col("vintage_date") == as_date(vintage_date).isoformat())


def delivered_columns(spark: SparkSession, path: str, vintage_date: str | None = None) -> list[str]:
    """Columns that the landed files themselves have, of all vintages or one; directories name two more.

    Only footers are read, in tasks.
    """
    files = spark.read.option("mergeSchema", True).option("basePath", path)
    name = "" if vintage_date is None else f"/vintage_date={as_date(vintage_date).isoformat()}"
    return [c for c in files.parquet(f"{path}{name}").columns if c != BUCKET]


def _pieces(spark: SparkSession, path: str) -> list[DataFrame]:
    """Landed rows by the columns that the files of their vintage have, so that these stay as delivered."""
    days = defaultdict(list)
    for folder in (f.toString() for f in vintage_folders(spark, path)):
        files = spark.read.option("mergeSchema", True).option("basePath", path).parquet(folder)
        days[tuple(c for c in RAW_PATCHED.names if c in files.columns)].append(folder)
    return [
        spark.read.schema(RAW_PATCHED).option("basePath", path).parquet(*folders).select(*names)
        for names, folders in days.items()
    ]


def land_raw(raw: DataFrame, path: str) -> None:
    """Write raw rows below ``vintage_date=…/release_id=…``, replacing only the rows of these vintages of the releases.

    A release date is landed where there is one. Rows of one directory are brought together first; a big
    release is split over several files. Of many releases (``slice_layout``) those of a bucket share a directory
    ``vintage_date=…/_bucket=…``, of which other releases' rows are read and written again.
    """
    spark = raw.sparkSession
    names = [c for c in RAW_PATCHED.names if c in RAW.names or c in raw.columns]
    rows = stored(raw.select(*names), "landed")
    partitions = slice_layout(spark, path, rows, RAW_PATCHED, pieces=lambda: _pieces(spark, path))
    if partitions == BY_BUCKET:
        day, release = F.col("vintage_date").cast("string"), F.col("release_id").cast("int")
        rows = rows.withColumns({"vintage_date": F.nullif(day, F.lit("")), "release_id": release})
        slices = stored(rows.select(*LANDING_PARTITIONS).distinct(), "slices")
        dated = vintage_folders(spark, path) and "release_date" in delivered_columns(spark, path)
        rows = with_neighbours(rows, path, slices, RAW_PATCHED if dated else RAW)
    overwrite_touched(compact(rows, partitions), path, partitions)


def read_payload_pages(spark: SparkSession, path: str, skip_corrupt: bool = False) -> DataFrame:
    """Payload pages, one JSON document per line.

    A line that is no page fails the job unless ``skip_corrupt`` is set; it then gives no rows.
    """
    mode = "DROPMALFORMED" if skip_corrupt else "FAILFAST"
    return spark.read.schema(PAYLOAD_PAGE).json(path, mode=mode)


def judged_payload_pages(spark: SparkSession, path: str) -> DataFrame:
    """Every line of the files as a page and ``is_page``; a line that is none has nulls."""
    corrupt = "_unreadable"
    schema = StructType([*PAYLOAD_PAGE.fields, StructField(corrupt, StringType())])
    lines = spark.read.schema(schema).json(path, mode="PERMISSIVE", columnNameOfCorruptRecord=corrupt)
    return lines.select(*PAYLOAD_PAGE.names, F.col(corrupt).isNull().alias("is_page"))


def payload_observations(pages: DataFrame) -> DataFrame:
    """Raw rows of all pages; a series without observations gives none."""
    series = pages.select(
        "release_id", "vintage_date", "collected_at", F.inline("series")
    )
    rows = series.select(
        "release_id", "vintage_date", "collected_at", "series_id", F.inline("observations")
    )
    return rows.select(*RAW.names)


def payload_series_metadata(pages: DataFrame) -> DataFrame:
    """One metadata row per series, from the last page that names it, also without observations."""
    series = pages.select(
        "release_id", "vintage_date", "page", F.inline("series")
    ).drop("observations")
    last = first_per_key(series, ["series_id"], [
        F.desc("vintage_date"), F.desc("page"), F.asc("release_id"), F.asc_nulls_last("title"),
    ])
    return last.select("series_id", "title", "frequency", "units", "release_id")


def default_worklist(spark: SparkSession) -> DataFrame:
    """The releases of a run that names none."""
    ids = spark.range(DEFAULT_RELEASES.start, DEFAULT_RELEASES.stop)
    return ids.select(F.col("id").cast("int").alias("release_id"))


def read_worklist(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Release ids from a text file with one id per line, else the default ids."""
    if path is None:
        return default_worklist(spark)
    lines = spark.read.text(path).select(F.trim("value").try_cast("int").alias("release_id"))
    return lines.filter(F.col("release_id").isNotNull()).distinct()


def on_worklist(df: DataFrame, worklist: DataFrame) -> DataFrame:
    """Rows whose release is on the worklist."""
    return df.join(worklist, "release_id", "left_semi")
