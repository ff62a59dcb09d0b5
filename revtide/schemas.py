"""Table schemas.

Column names and types are fixed values: readers of existing tables rely on them. Counts are BIGINT
throughout; older files with INT counts read the same.
"""

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructType,
    TimestampType,
)

_TYPES = {
    "STRING": StringType(), "DATE": DateType(), "TIMESTAMP": TimestampType(),
    "DOUBLE": DoubleType(), "INT": IntegerType(), "BIGINT": LongType(), "BOOLEAN": BooleanType(),
}


def _struct(columns: str) -> StructType:
    """Schema from ``name TYPE [NOT NULL], …``; unlike ``fromDDL`` it needs no running session."""
    schema = StructType()
    for column in columns.split(","):
        name, kind, *rest = column.split()
        schema.add(name, _TYPES[kind], nullable=not rest)
    return schema

# One row per observation exactly as it was delivered; everything is still text.
RAW = _struct("""
    series_id STRING, date STRING, value STRING, release_id INT,
    vintage_date STRING, collected_at STRING
""")

# Raw landing rows patched with the publication date (input of the curated table).
RAW_PATCHED = _struct("""
    series_id STRING, date STRING, value STRING, release_id INT,
    vintage_date STRING, release_date STRING, collected_at STRING
""")

# Full copy of every observation, once per vintage.
SNAPSHOTS = _struct("""
    series_id STRING, date DATE, value DOUBLE, value_str STRING, vintage_date DATE,
    realtime_start DATE, realtime_end DATE, release_id INT, etl_updated_at TIMESTAMP
""")

# Append-only change log: rows that did not change are never written.
SERIES_OBSERVATIONS = _struct("""
    series_id STRING NOT NULL, date DATE NOT NULL, vintage_date DATE NOT NULL,
    value DOUBLE, value_str STRING,
    release_id INT NOT NULL, realtime_start DATE, realtime_end DATE,
    last_updated TIMESTAMP NOT NULL, _change_type STRING NOT NULL,
    _etl_run_id STRING, _source_api_version STRING
""")

SERIES_METADATA = _struct("""
    series_id STRING NOT NULL, title STRING,
    observation_start DATE, observation_end DATE,
    frequency STRING, frequency_short STRING, units STRING, units_short STRING,
    seasonal_adjustment STRING, seasonal_adjustment_short STRING,
    release_id INT, popularity INT, group_popularity INT,
    realtime_start DATE, realtime_end DATE, last_updated TIMESTAMP NOT NULL,
    notes STRING, _etl_run_id STRING
""")

RELEASE_METADATA = _struct("""
    release_id INT NOT NULL, release_name STRING NOT NULL, press_release BOOLEAN, link STRING,
    series_count BIGINT, observations_count BIGINT, last_collected TIMESTAMP,
    last_updated_by_source DATE, collection_status STRING, collection_error STRING,
    _etl_run_id STRING
""")

COLLECTION_HISTORY = _struct("""
    etl_run_id STRING NOT NULL, release_id INT NOT NULL,
    started_at TIMESTAMP NOT NULL, completed_at TIMESTAMP, duration_seconds DOUBLE,
    series_count BIGINT, observations_added BIGINT, observations_updated BIGINT,
    observations_deleted BIGINT, api_calls INT, api_key_used STRING,
    status STRING NOT NULL, error_message STRING, error_stack_trace STRING,
    triggered_by STRING, kubernetes_pod STRING, api_version STRING
""")

# The vintages of each release that were merged into the change log, also those that changed nothing there.
RELEASE_CALENDAR = _struct("""
    release_id INT NOT NULL, vintage_date DATE NOT NULL, processed_at TIMESTAMP NOT NULL, _etl_run_id STRING
""")

# What operations did to tables: a row for each, appended when it is done.
OPERATIONS = _struct("""
    table_name STRING NOT NULL, done_at TIMESTAMP NOT NULL, operation STRING NOT NULL
""").add("operation_metrics", MapType(StringType(), LongType()))

# One page of a bulk download, stored as one JSON document.
PAYLOAD_PAGE = _struct("""
    release_id INT, vintage_date STRING, collected_at STRING, page INT,
    has_more BOOLEAN, next_cursor STRING
""").add("series", ArrayType(
    _struct("series_id STRING, title STRING, frequency STRING, units STRING")
    .add("observations", ArrayType(_struct("date STRING, value STRING")))
))

# Notification that a release was updated.
MESSAGE = _struct("""
    release_id INT, release_name STRING, update_date STRING, priority STRING, batch_mode BOOLEAN
""")

# Messages that could not be merged, and what each batch of messages held.
LETTERS = _struct("""
    body STRING, reason STRING, source STRING, position BIGINT, stream STRING, batch_id BIGINT
""")
BATCHES = _struct("""
    messages BIGINT, merged BIGINT, letters BIGINT, stream STRING, batch_id BIGINT
""")

TABLES = {
    "series_observations": SERIES_OBSERVATIONS,
    "series_metadata": SERIES_METADATA,
    "release_metadata": RELEASE_METADATA,
    "collection_history": COLLECTION_HISTORY,
    "snapshots": SNAPSHOTS,
    "release_calendar": RELEASE_CALENDAR,
    "operations": OPERATIONS,
}

# Releases of a vintage, not series, make up directories: a merge replaces whole directories, and a directory
# per series would mean a million tiny files.
BUCKET = "_bucket"
BUCKET_KEYS = {"series_metadata": "series_id", "release_metadata": "release_id"}

PARTITION_COLUMNS = {
    "series_metadata": [BUCKET],
    "release_metadata": [BUCKET],
    "series_observations": ["vintage_date", "release_id"],
    "snapshots": ["vintage_date", "release_id"],
    "release_calendar": ["vintage_date"],
    "curated": ["year", "month"],
}

# Columns whose ranges readers filter on; a table that is not listed is only compacted.
CLUSTER_COLUMNS = {
    "series_observations": ["series_id", "date"],
    "snapshots": ["series_id", "date"],
    "curated": ["series_id", "release_id"],
    "series_metadata": ["release_id", "frequency"],
    "release_metadata": ["last_updated_by_source"],
}

# Columns the curated table must have before it is written, and those of the stricter variant.
CURATED_REQUIRED = [
    "series_id", "date", "value", "release_id", "release_date", "collected_at", "year", "month",
]
#: Columns that a delivery itself must have for the curated table; the others can be derived or are optional.
DELIVERED_REQUIRED = ["series_id", "date", "value", "release_id"]
CURATED_REQUIRED_FULL = [
    "series_id", "date", "value", "vintage_date", "collected_at", "release_id",
    "release_date", "collection_vintage", "year", "month",
]


def schema_of(table: str) -> StructType:
    """Schema of a known table."""
    if table not in TABLES:
        raise ValueError(f"unknown table {table!r}, expected one of {sorted(TABLES)}")
    return TABLES[table]
