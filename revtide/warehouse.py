"""All tables of one installation below a root folder, and the daily operations on them."""

from __future__ import annotations

import datetime
import traceback
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revtide.functions.parsing import as_date
from revtide.operators import changes, collection, ledger, quality, selection, upserts, vintages
from revtide.plans import collection as runs
from revtide.plans import analysis, curate, merge
from revtide.plans import vintages as ingest
from revtide.schemas import (
    CLUSTER_COLUMNS, PARTITION_COLUMNS, RAW_PATCHED, RELEASE_METADATA, SERIES_METADATA, TABLES, schema_of,
)
from revtide.session import stored
from revtide.sources import clustering, mutation, tables
from revtide.sources import raw as landing
from revtide.streaming import events

Day = str | datetime.date


class Warehouse:
    """Facade over the operators; every read returns a lazy DataFrame.

    Writers of one table must not overlap: plain files have no transactions.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        """Where a table is."""
        return f"{self.root}/{name}"

    def table(self, name: str) -> DataFrame:
        """Rows of a table; an empty one is created if it is not there."""
        tables.ensure_table(self.spark, self.path(name), name)
        schema = schema_of(name)
        return tables.read_table(self.spark, self.path(name), schema).select(*schema.names)

    # Landing and ingesting

    def land_payload(self, pages_path: str) -> DataFrame:
        """Land downloaded payload pages; returns the quality of each release."""
        return runs.land_payload(self.spark, pages_path, self.path("raw"))

    def land_payload_counted(self, pages_path: str, skip_corrupt: bool = False) -> tuple[DataFrame, dict[str, int]]:
        """``land_payload`` with the lines read and those skipped because they are no page."""
        return runs.land_payload_counted(self.spark, pages_path, self.path("raw"), skip_corrupt)

    def land(self, raw: DataFrame) -> None:
        """Land raw rows."""
        landing.land_raw(raw, self.path("raw"))

    def raw(self, vintage_date: str | None = None) -> DataFrame:
        """Landed rows."""
        return landing.read_raw(self.spark, self.path("raw"), vintage_date)

    def process_vintage(self, vintage_date: Day) -> DataFrame:
        """Upsert a landed vintage into the snapshots; returns its counts."""
        return self.process_all_vintages([vintage_date])

    def process_all_vintages(self, vintage_dates: Sequence[Day] | None = None) -> DataFrame:
        """Upsert several landed vintages, by default all, in one job; returns counts per vintage."""
        counts = ingest.ingest_vintages(
            self.spark, self.path("raw"), self.path("snapshots"), vintage_dates
        )
        done = counts.agg(F.sum("inserted"), F.sum("updated")).first()
        self._done("snapshots", "MERGE", {"inserted": done[0] or 0, "updated": done[1] or 0})
        return counts

    def process_isolated(self, vintage_dates: Sequence[Day] | None = None) -> DataFrame:
        """Upsert the landed vintages that can be read, by default all; returns status and counts per vintage."""
        return ingest.ingest_isolated(
            self.spark, self.path("raw"), self.path("snapshots"), vintage_dates
        )

    def unprocessed_releases(self) -> DataFrame:
        """(release, vintage) pairs that were landed but not ingested."""
        raw = self.raw().withColumn("vintage_date", F.col("vintage_date").cast("date"))
        return changes.unprocessed_releases(raw, self.table("snapshots"))

    def curate(self, vintage_date: Day, release_id: int | None = None) -> DataFrame:
        """Write the curated table from a landed vintage, or from one release of it."""
        return self.curate_counted(vintage_date, release_id)[0]

    def curate_counted(
        self, vintage_date: Day, release_id: int | None = None
    ) -> tuple[DataFrame, dict[str, int]]:
        """``curate`` with the rows delivered, removed as duplicates, and written."""
        day = as_date(vintage_date).isoformat()
        raw = landing.read_raw(self.spark, self.path("raw"), day, schema=RAW_PATCHED)
        if release_id is not None:
            raw = raw.filter(F.col("release_id") == release_id)
        delivered = landing.delivered_columns(self.spark, self.path("raw"), day)
        return curate.curate_counted(self.spark, raw, self.path("curated"), day, delivered)

    def analyse(self) -> dict[str, str]:
        """Persist the statistics of the curated table; returns their paths."""
        curated = tables.read_table(self.spark, self.path("curated"))
        return curate.analyse(curated, self.path("analysis"))

    def refresh_analysis(self, vintage_dates: Sequence[Day] | None = None) -> dict[str, str]:
        """Statistics of the snapshots, brought up to date for some vintages, by default all; returns their paths."""
        touched = None
        if vintage_dates is not None:
            days = [(as_date(v),) for v in vintage_dates]
            touched = self.spark.createDataFrame(days, "vintage_date date")
        states = self.path("analysis_states")
        analysis.refresh_states(self.table("snapshots"), states, ["vintage_date"], touched)
        return analysis.save_analysis_of_states(self.spark, states, self.path("snapshot_analysis"))

    # Merging

    def merge_observations(
        self, new: DataFrame, vintage_date: Day, etl_run_id: str,
        release_id: int | None = None, api_version: str = "v2",
    ) -> dict[str, int]:
        """Merge one vintage of one or more releases into the change log."""
        counts = merge.merge_vintage(
            self.spark, new, vintage_date, self.path("series_observations"), etl_run_id,
            release_id, api_version, self.path("release_calendar"),
        )
        self._done("series_observations", "MERGE", counts)
        return counts

    def rebuild_log(self, etl_run_id: str) -> None:
        """Derive the whole change log from the snapshots."""
        snapshots = self.table("snapshots")
        touched = snapshots.select("release_id", "vintage_date").distinct()
        merge.merge_touched(
            snapshots, touched, self.path("series_observations"), etl_run_id,
            calendar=self.path("release_calendar"),
        )
        self._done("series_observations", "WRITE", {})

    def merge_series_metadata(self, new: DataFrame, etl_run_id: str) -> dict[str, int]:
        """Upsert series metadata, replacing every column."""
        stamped = new.withColumns({
            "last_updated": F.current_timestamp(), "_etl_run_id": F.lit(etl_run_id),
        })
        return self._upsert(
            ledger.conform(stamped, SERIES_METADATA), "series_metadata",
            upserts.upsert_series_metadata,
        )

    def merge_release_metadata(self, new: DataFrame, etl_run_id: str) -> dict[str, int]:
        """Upsert release metadata, replacing the given columns only."""
        given = new.withColumn("_etl_run_id", F.lit(etl_run_id))
        typed = given.select(*(
            F.col(f.name).cast(f.dataType) for f in RELEASE_METADATA if f.name in given.columns
        ))
        return self._upsert(typed, "release_metadata", upserts.upsert_release_metadata)

    def store_release(
        self, observations: DataFrame, release_id: int, vintage_date: Day,
        triggered_by: str = "manual", api_version: str = "v2", api_calls: int | None = None,
    ) -> dict[str, object]:
        """Merge a collected release, update its metadata and keep the run ledger.

        ``observations`` has series_id, date and value; ``api_calls`` to the source brought them. A failure is
        logged and raised.
        """
        run = f"run-{datetime.datetime.now():%Y%m%d-%H%M%S}-{uuid.uuid4().hex[:8]}"
        started = datetime.datetime.now()
        context = {"triggered_by": triggered_by, "api_version": api_version, "api_calls": api_calls}
        self.log_run(run, release_id, started, **context)
        try:
            rows = observations.withColumn("release_id", F.lit(release_id).cast("int"))
            counts = dict.fromkeys(("inserted", "updated", "deleted", "total_processed"), 0)
            day = F.lit(as_date(vintage_date)).alias("vintage_date")
            if not rows.isEmpty():
                counts = self.merge_observations(
                    rows, vintage_date, run, release_id, api_version
                )
            collected = self.spark.range(1).select(F.lit(release_id).cast("int").alias("release_id"), day)
            dated = rows.select("release_id", "series_id", day)
            summary = stored(collection.release_summary(dated, run, collected), "summary")
            self.merge_release_metadata(summary, run)
            series_count = summary.first()["series_count"]
        except Exception as error:
            self.log_run(
                run, release_id, started, datetime.datetime.now(), "failed",
                error_message=str(error), error_stack_trace=traceback.format_exc(), **context,
            )
            raise
        self.log_run(
            run, release_id, started, datetime.datetime.now(), "success",
            observations_added=counts["inserted"], observations_updated=counts["updated"],
            observations_deleted=counts["deleted"], series_count=series_count, **context,
        )
        return {"etl_run_id": run, "status": "success", **counts}

    def stream_releases(self, bodies: DataFrame, available_now: bool = True):
        """Merge releases from the snapshots as their notifications arrive."""
        return events.stream_merge(
            bodies, lambda: self.table("snapshots"), self.path("series_observations"),
            self.path("_checkpoints/stream_releases"), available_now, calendar=self.path("release_calendar"),
            letters=self.path("dead_letters"),
        )

    def dead_letters(self) -> DataFrame:
        """Messages that could not be merged, with the reason."""
        return events.read_letters(self.spark, self.path("dead_letters"))

    # Ledgers

    def log_run(
        self, etl_run_id: str, release_id: int, started_at: datetime.datetime,
        completed_at: datetime.datetime | None = None, status: str = "running", **facts: object,
    ) -> None:
        """Append a row to the run ledger."""
        row = ledger.run_record(
            self.spark, etl_run_id, release_id, started_at, completed_at, status, **facts
        )
        tables.append(row, self.path("collection_history"), "collection_history")

    def run_status(self) -> DataFrame:
        """Current state of each run."""
        return ledger.run_status(self.table("collection_history"))

    def history(self, limit: int = 3, table: str | None = None) -> DataFrame:
        """The newest operations on a table or on all of them."""
        return ledger.newest_operations(self.table("operations"), limit, table)

    # Reading

    def latest_vintage(self, series_id: str) -> DataFrame:
        """Newest value of every date of a series."""
        return vintages.latest_vintage(self._series(series_id)).orderBy("date")

    def vintage_at(self, series_id: str, day: Day) -> DataFrame:
        """A series as it was known on a day."""
        return vintages.vintage_as_of(self._series(series_id), day).orderBy("date")

    def revisions(self, series_id: str, date: Day) -> DataFrame:
        """All vintages of one point."""
        return vintages.revision_history(self.table("series_observations"), series_id, date)

    def get_series(
        self, series_id: str | Sequence[str], start: Day | None = None, end: Day | None = None,
        columns: Sequence[str] | None = None, table: str = "series_observations",
    ) -> DataFrame:
        """Stored observations of one or more series."""
        return selection.get_series(self.table(table), series_id, start, end, columns)

    def list_series(self, pattern: str | None = None, limit: int = 100) -> DataFrame:
        """Series ids, sorted."""
        return selection.list_series(self.table("series_observations"), pattern, limit)

    def search(self, pattern: str) -> DataFrame:
        """Series ids that match a pattern."""
        return self.list_series(pattern)

    def latest(self, series_id: str, n: int = 10) -> DataFrame:
        """Newest observations of a series."""
        return selection.latest_n(self.table("series_observations"), series_id, n)

    def count_by_series(self, limit: int = 50) -> DataFrame:
        """Series with the most observations."""
        return selection.count_by_series(self.table("series_observations"), limit)

    def info(self, table: str = "series_observations") -> DataFrame:
        """Files, columns, rows and series of a table."""
        tables.ensure_table(self.spark, self.path(table), table)
        rows = tables.read_table(self.spark, self.path(table))
        return tables.table_info(rows)

    # Maintenance

    def optimize(self, names: Sequence[str] | None = None) -> None:
        """Cluster or compact tables, by default all that exist.

        Of a partitioned table with cluster columns only the partitions that changed since the last time are rewritten.
        """
        for name in names or TABLES:
            if tables.table_exists(self.spark, self.path(name)):
                if PARTITION_COLUMNS.get(name) and CLUSTER_COLUMNS.get(name):
                    clustering.cluster_stored(
                        self.spark, self.path(name), self.path(f"layout/{name}"), CLUSTER_COLUMNS[name],
                        self._partitions(name),
                    )
                else:
                    tables.optimize_table(self.spark, self.path(name), name)
                if name != "operations":
                    self._done(name, "OPTIMIZE", {})

    def update(self, name: str, condition: Column, values: dict[str, Column]) -> dict[str, int]:
        """Set columns of the rows of a table where the condition holds."""
        counts = mutation.update_stored(
            self.spark, self.path(name), self._partitions(name), condition, values
        )
        self._done(name, "UPDATE", counts)
        return counts

    def delete(self, name: str, condition: Column) -> dict[str, int]:
        """Delete the rows of a table where the condition holds."""
        counts = mutation.delete_stored(self.spark, self.path(name), self._partitions(name), condition)
        self._done(name, "DELETE", counts)
        return counts

    def quality(self, vintage_date: str, metadata: DataFrame | None = None) -> DataFrame:
        """Quality of the releases of a landed vintage."""
        metadata = self.table("series_metadata") if metadata is None else metadata
        return quality.release_quality(self.raw(vintage_date), metadata)

    def _partitions(self, name: str) -> list[str]:
        return tables.partitions_of(self.spark, self.path(name), name)

    def _series(self, series_id: str) -> DataFrame:
        return selection.series_filter(self.table("series_observations"), series_id)

    def _upsert(self, source: DataFrame, name: str, operator) -> dict[str, int]:
        counts = ingest.upsert_table(self.spark, source, self.path(name), name, operator)
        self._done(name, "MERGE", counts)
        return counts

    def _done(self, name: str, operation: str, counts: dict[str, int]) -> None:
        record = ledger.operation_record(self.spark, name, operation, counts)
        tables.append(record, self.path("operations"), "operations")
