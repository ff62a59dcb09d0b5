"""Notifications of updated releases as a stream that merges into the change log.

Delivery is at least once: a batch is acknowledged by the checkpoint after its merge, so a batch can
run twice. The merge replaces the (release, vintage) slices it touches and derives them from the
snapshots, so a repeat or a late notification leaves the same table. Late data needs no watermark: a
late value is simply a newer vintage. Bodies that cannot be merged are dead letters, kept and counted by batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.types import StringType, StructField, StructType

from revtide.functions.parsing import parse_date
from revtide.operators.ledger import conform
from revtide.plans.merge import merge_touched
from revtide.schemas import BATCHES, LETTERS, MESSAGE
from revtide.session import stored
from revtide.sources.tables import overwrite_touched, read_table

#: Name under which a stream's counts are observed.
OBSERVED = "messages"
LETTER_PARTITIONS = ["stream", "batch_id"]


def parse_messages(bodies: DataFrame, column: str = "body") -> DataFrame:
    """Message fields next to the other columns; a body that is not a message gives nulls."""
    parsed = bodies.withColumn("_message", F.from_json(F.col(column), MESSAGE))
    others = [c for c in bodies.columns if c != column]
    fields = [F.col(f"_message.{name}").alias(name) for name in MESSAGE.names]
    return parsed.select(*others, *fields, F.col("_message.release_id").isNotNull().alias("valid"))


def message_counts(messages: DataFrame) -> DataFrame:
    """How many messages could be read and how many could not."""
    return messages.agg(
        F.count_if("valid").alias("valid_messages"),
        F.count_if(~F.col("valid")).alias("bad_messages"),
    )


def judged_messages(bodies: DataFrame, column: str = "body") -> DataFrame:
    """Messages next to all other columns, and ``reason``, why one cannot be merged, or null.

    ``unreadable`` bodies are no JSON object of the message's types, ``no_release`` names none and ``no_date``
    has no update date in year-month-day.
    """
    corrupt = "_unreadable"
    schema = StructType([*MESSAGE.fields, StructField(corrupt, StringType())])
    parsed = bodies.withColumn(
        "_message", F.from_json(F.col(column), schema, {"columnNameOfCorruptRecord": corrupt})
    )
    message = F.col("_message")
    reason = (
        F.when(message.isNull() | message[corrupt].isNotNull(), "unreadable")
        .when(message["release_id"].isNull(), "no_release")
        .when(parse_date(message["update_date"]).isNull(), "no_date")
    )
    fields = [message[name].alias(name) for name in MESSAGE.names]
    return parsed.select(*bodies.columns, *fields, reason.alias("reason"))


def touched_slices(messages: DataFrame) -> DataFrame:
    """The (release, vintage) pairs that mergeable messages name."""
    pairs = messages.filter("reason IS NULL").select(
        "release_id", parse_date(F.col("update_date")).alias("vintage_date")
    )
    return pairs.distinct()


class MessageCounts(StreamingQueryListener):
    """Adds up what streams that are observed as ``messages`` report: merged and dead letters.

    A batch that runs again after a failure reports again; the table of batches counts it once.
    """

    def __init__(self):
        self.merged = self.letters = 0

    def onQueryStarted(self, event) -> None:  # noqa: N802 - Spark's names
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        found = event.progress.observedMetrics.get(OBSERVED)
        if found is not None:
            self.merged += found["merged"] or 0
            self.letters += found["letters"] or 0

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass


def read_message_files(
    spark: SparkSession, path: str, files_per_batch: int | None = None, positions: bool = False
) -> DataFrame:
    """Stream of message bodies from text files, one message per line, from the first file on.

    With ``positions`` also ``source``, the file, and ``position``, where the block of the file begins.
    """
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    lines = reader.load(path)
    where = [
        F.col("_metadata.file_path").alias("source"), F.col("_metadata.file_block_start").alias("position"),
    ] if positions else []
    return lines.select(F.col("value").alias("body"), *where)


def read_message_topic(
    spark: SparkSession, servers: str, topic: str, messages_per_batch: int | None = None,
    positions: bool = False,
) -> DataFrame:
    """Stream of message bodies from a Kafka topic, from its beginning. Needs the Kafka package.

    With ``positions`` also ``source``, topic and partition, and ``position``, the offset there.
    """
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
    reader = reader.option("subscribe", topic).option("startingOffsets", "earliest")
    if messages_per_batch:
        reader = reader.option("maxOffsetsPerTrigger", messages_per_batch)
    where = [
        F.concat_ws("/", "topic", F.col("partition").cast("string")).alias("source"),
        F.col("offset").alias("position"),
    ] if positions else []
    return reader.load().select(F.col("value").cast("string").alias("body"), *where)


def read_letters(spark: SparkSession, path: str) -> DataFrame:
    """Dead letters: stream, batch, body, reason, and where the body came from."""
    return read_table(spark, f"{path}/letters", LETTERS).select(*LETTERS.names)


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """Per stream and batch: messages, how many were merged, and how many are dead letters."""
    return read_table(spark, f"{path}/batches", BATCHES).select(*BATCHES.names)


def stream_merge(
    bodies: DataFrame,
    snapshots: Callable[[], DataFrame],
    log_path: str,
    checkpoint: str,
    available_now: bool = True,
    etl_run_id: str = "stream",
    calendar: str | None = None,
    letters: str | None = None,
) -> StreamingQuery:
    """Start merging the releases named by a stream of bodies into the change log.

    ``snapshots`` is called per batch, so that each batch sees newly landed vintages. The run id of
    a row names the batch that wrote it. A body that names no release or no date is a dead letter: below
    ``letters`` (a path, by default beside the log) it is kept with its reason, batch, and position if the stream
    has columns ``source`` and ``position``, next to the counts of every batch. Both are replaced by batch, so
    a batch that runs twice is kept once. The counts are also observed as ``messages``, for a ``MessageCounts``.
    """
    letters = letters or f"{log_path.rstrip('/')}_dead_letters"
    fine = F.col("reason").isNull()
    counts = [F.count_if(fine).alias("merged"), F.count_if(~fine).alias("letters")]
    watched = judged_messages(bodies).observe(OBSERVED, *counts)

    def merge(batch: DataFrame, batch_id: int) -> None:
        judged = stored(batch, "messages")
        named = judged.withColumns({"stream": F.lit(etl_run_id), "batch_id": F.lit(batch_id).cast("bigint")})
        bad = conform(named.filter(~fine), LETTERS)
        overwrite_touched(bad, f"{letters}/letters", LETTER_PARTITIONS)
        counted = judged.agg(F.count("*").alias("messages"), *counts)
        counted = counted.withColumns({"stream": F.lit(etl_run_id), "batch_id": F.lit(batch_id).cast("bigint")})
        overwrite_touched(conform(counted, BATCHES), f"{letters}/batches", LETTER_PARTITIONS)
        merge_touched(snapshots(), touched_slices(judged), log_path, f"{etl_run_id}-{batch_id}", calendar=calendar)

    writer = watched.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
