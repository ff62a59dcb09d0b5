"""Test tables as time series inputs.

The driver's tables hold no vintages, so these frames give its events, orders and line items the
shape of raw deliveries, snapshots, metadata, attempts, runs and messages. They keep every row.
The same definitions in DuckDB's SQL are in ``oracle.py``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revtide.operators.changes import change_log
from revtide.operators.observations import dedup_vintage_key, to_snapshot
from revtide.operators.vintages import KEY
from revtide.session import stored

SNAPSHOT_KEY = [*KEY, "vintage_date"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _series_id() -> Column:
    return F.concat_ws("_", "event_type", F.col("user_id").cast("string"))


def _release_id() -> Column:
    """Ten users share a release; half of their purchases are also published by a second one."""
    second = (F.col("event_type") == "purchase") & (F.col("event_id") % 2 == 1)
    release = F.floor(F.col("user_id") / 10) + 9
    return (release + F.when(second, 100_000).otherwise(0)).cast("int")


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly observations in four vintages, all text, with dirt: empty and null ids, bad and null
    dates, missing, empty and unreadable values, outliers, duplicates."""
    n = F.col("event_id")
    week = F.date_format(F.date_trunc("week", "ts"), "yyyy-MM-dd")
    return table(spark, sf_dir, "events").select(
        F.when(n % 211 == 0, "").when(n % 223 == 0, None).otherwise(_series_id())
        .alias("series_id"),
        F.when(n % 307 == 0, "2024-1-5").when(n % 313 == 0, "2024-13-01")
        .when(n % 401 == 0, None).otherwise(week).alias("date"),
        F.when(n % 29 == 0, ".").when(n % 101 == 0, None).when(n % 103 == 0, "")
        .when(n % 251 == 0, "n/a").when(n % 503 == 0, "99999.5")
        .otherwise(F.col("value").cast("string")).alias("value"),
        _release_id().alias("release_id"),
        F.when(n % 4 == 0, "2024-02-01").when(n % 4 == 1, "2024-02-08")
        .when(n % 4 == 2, "2024-02-15").otherwise("2024-02-22").alias("vintage_date"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("collected_at"),
    )


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed snapshot rows of ``raw``, one per release, series, date and vintage."""
    rows = raw(spark, sf_dir).filter("series_id <> ''")
    typed = to_snapshot(rows).drop("etl_updated_at", "realtime_start", "realtime_end")
    return dedup_vintage_key(typed.filter(F.col("date").isNotNull()), SNAPSHOT_KEY)


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change log of ``snapshots``, which are stored: the log reads them twice, for its calendar and its rows."""
    return change_log(stored(snapshots(spark, sf_dir), "snapshots"))


def snapshots_big(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly snapshots of line item prices, one per release, series, date and vintage."""
    line = F.col("l_linenumber") % 4
    rows = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("series_id"),
        F.to_date(F.date_trunc("month", "l_shipdate")).alias("date"),
        F.when(line == 0, "2002-01-01").when(line == 1, "2002-02-01")
        .when(line == 2, "2002-03-01").otherwise("2002-04-01").cast("date")
        .alias("vintage_date"),
        (F.floor(F.col("l_suppkey") / 25) + 9).cast("int").alias("release_id"),
        F.col("l_extendedprice").alias("value"),
    )
    return rows.groupBy(*SNAPSHOT_KEY).agg(F.max("value").alias("value"))


def snapshots_unchanged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first two vintages of ``snapshots_big``, and a third that says the same as the first."""
    rows = snapshots_big(spark, sf_dir)
    third = rows.filter("vintage_date = '2002-01-01'").withColumn("vintage_date", F.lit("2002-03-01").cast("date"))
    return rows.filter("vintage_date <= '2002-02-01'").unionByName(third)


def raw_big(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as raw rows: monthly prices, all text, with duplicates but no bad dates."""
    line = F.col("l_linenumber") % 4
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("series_id"),
        F.date_format(F.date_trunc("month", "l_shipdate"), "yyyy-MM-dd").alias("date"),
        F.col("l_extendedprice").cast("string").alias("value"),
        (F.floor(F.col("l_suppkey") / 25) + 9).cast("int").alias("release_id"),
        F.when(line == 0, "2002-01-01").when(line == 1, "2002-02-01")
        .when(line == 2, "2002-03-01").otherwise("2002-04-01").alias("vintage_date"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss").alias("collected_at"),
    )


def changes_big(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change log of ``snapshots_big``."""
    return change_log(snapshots_big(spark, sf_dir))


def _metadata(by_user: DataFrame, prefix: str) -> DataFrame:
    return by_user.select(
        _series_id().alias("series_id"),
        F.concat(F.lit(prefix), F.col("event_type")).alias("title"),
        F.lit("W").alias("frequency"), F.lit("index").alias("units"),
        (F.floor(F.col("user_id") / 10) + 9).cast("int").alias("release_id"),
    )


def series_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata of one series per user, that of the first event type in order of text."""
    events = table(spark, sf_dir, "events")
    return _metadata(events.groupBy("user_id").agg(F.min("event_type").alias("event_type")), "")


def series_metadata_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata of the series of each user's last event: partly new, partly an update."""
    last = F.max_by("event_type", "event_id").alias("event_type")
    return _metadata(table(spark, sf_dir, "events").groupBy("user_id").agg(last), "new ")


def release_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Releases: customers, and suppliers under even negative ids."""
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("int").alias("release_id"))
    suppliers = table(spark, sf_dir, "supplier").select((-2 * F.col("s_suppkey") - 2).cast("int"))
    key = F.col("release_id")
    return customers.unionAll(suppliers).select(
        key,
        F.concat(F.lit("Release "), key.cast("string")).alias("release_name"),
        F.concat(F.lit("https://example.org/"), key.cast("string")).alias("link"),
        F.lit(0).alias("observations_count"), F.lit("pending").alias("collection_status"),
    )


def release_metadata_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of the releases with orders, and nations under negative ids; has no link column."""
    ordered = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("int").alias("release_id"))
    nations = table(spark, sf_dir, "nation").select((-1 - F.col("n_nationkey")).cast("int"))
    counted = ordered.unionAll(nations).groupBy("release_id").agg(
        F.count("*").cast("int").alias("observations_count")
    )
    return counted.withColumns({
        "release_name": F.concat(F.lit("Updated "), F.col("release_id").cast("string")),
        "collection_status": F.lit("success"),
    })


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as collection attempts of a release (customer)."""
    n = F.col("o_orderkey")
    failed = F.col("o_orderstatus") == "F"
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("int").alias("release_id"), n.alias("attempt"),
        F.when(failed, "failed").otherwise("success").alias("status"),
        F.floor(F.col("o_totalprice") / 100).alias("observations"),
        (n % 50 + 1).alias("series"), (n % 4 + 1).alias("api_calls"),
        (F.col("o_totalprice") < 400000).alias("qc_valid"),
        (n % 5).alias("qc_warnings"),
        F.when(F.col("o_totalprice") < 400000, 0).otherwise(n % 3 + 1).cast("bigint")
        .alias("qc_errors"),
        F.when(failed, F.col("o_orderpriority")).alias("error"),
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as runs: a row when one starts and, unless it is pending, a row when it ends."""
    n = F.col("o_orderkey")
    started = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("run-"), n.cast("string")).alias("etl_run_id"),
        (n % 10 + 9).cast("int").alias("release_id"),
        F.col("o_orderdate").cast("timestamp").alias("started_at"),
        F.col("o_orderstatus").alias("_state"), (n % 3600 + 1).alias("_seconds"),
    )
    begin = started.withColumn("status", F.lit("running")).drop("_seconds")
    end = started.filter("_state <> 'P'").withColumns({
        "completed_at": F.timestamp_add("SECOND", F.col("_seconds"), F.col("started_at")),
        "status": F.when(F.col("_state") == "F", "failed").otherwise("success"),
    }).drop("_seconds")
    return begin.unionByName(end, True).drop("_state")


def operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as operations on two tables."""
    return table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderpriority") == "1-URGENT", "snapshots")
        .otherwise("series_observations").alias("table_name"),
        F.col("o_orderdate").cast("date").alias("done_at"),
        F.when(F.col("o_orderstatus") == "F", "MERGE").when(F.col("o_orderstatus") == "O", "WRITE")
        .otherwise("OPTIMIZE").alias("operation"),
        F.floor("o_totalprice").alias("rows_written"),
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows announced by messages, one body per event, some of them malformed."""
    n = F.col("event_id")
    vintage = (
        F.when(n % 4 == 0, "2024-02-01").when(n % 4 == 1, "2024-02-08")
        .when(n % 4 == 2, "2024-02-15").otherwise("2024-02-22")
    )
    body = F.concat(
        F.lit('{"release_id": '), _release_id().cast("string"),
        F.lit(', "release_name": "'), F.col("event_type"),
        F.lit('", "update_date": "'), vintage, F.lit('", "priority": "normal"}'),
    )
    return table(spark, sf_dir, "events").select(
        n.alias("offset_id"), F.when(n % 97 == 0, "not json").otherwise(body).alias("body")
    )


def messages_with_dirt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``messages`` of which some also name no release or a day that is none."""
    n = F.col("offset_id")
    dirty = F.when(n % 97 == 0, F.col("body")).when(
        n % 89 == 0, '{"release_name": "x", "update_date": "2024-02-01"}'
    ).when(n % 83 == 0, '{"release_id": 9, "update_date": "2024-13-01"}').when(
        n % 79 == 0, '{"release_id": "nine", "update_date": "2024-02-01"}').otherwise(F.col("body"))
    return messages(spark, sf_dir).withColumn("body", dirty)


def raw_partly_released(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw`` with every seventh release left out of its rows."""
    release = F.when(F.col("release_id") % 7 != 3, F.col("release_id"))
    return raw(spark, sf_dir).withColumn("release_id", release)


def payload_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows packed into payload pages: 500 consecutive events per page at most.

    A page is thus bounded, however many rows a release or series has.
    """
    rows = table(spark, sf_dir, "events").select(
        _release_id().alias("release_id"), _series_id().alias("series_id"), "event_type",
        F.date_format(F.date_trunc("week", "ts"), "yyyy-MM-dd").alias("date"),
        F.col("value").cast("string").alias("value"),
        F.floor(F.col("event_id") / 500).cast("int").alias("page"),
    )
    by_series = rows.groupBy("release_id", "page", "series_id", "event_type").agg(
        F.collect_list(F.struct("date", "value")).alias("observations")
    )
    title = F.concat_ws(" ", F.lit("page"), F.col("page").cast("string"), "event_type")
    series = F.struct(
        "series_id", title.alias("title"), F.lit("W").alias("frequency"),
        F.lit("index").alias("units"), "observations",
    )
    pages = by_series.groupBy("release_id", "page").agg(F.collect_list(series).alias("series"))
    return pages.withColumns({
        "vintage_date": F.lit("2024-02-01"), "collected_at": F.lit("2024-02-01T00:00:00"),
        "has_more": F.lit(False),
    })
