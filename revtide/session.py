"""Session helpers: the shared folder, and lookup sides whose size Spark knows."""

from __future__ import annotations

import tempfile
import uuid
from collections import defaultdict

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without the setting gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="revtide-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/revtide/{uuid.uuid4().hex}/{name}"


def observed(observation: Observation) -> dict[str, int]:
    """Figures that a finished job observed; those missing are 0.

    An input that is empty by its plan is planned away with its observation, which then has no row to give.
    """
    try:
        found = observation.get
    except Py4JJavaError:
        found = {}
    return defaultdict(int, {name: value or 0 for name, value in found.items()})


def stored(df: DataFrame, name: str = "stored") -> DataFrame:
    """Write a frame to the shared folder once and read it back.

    What follows does not compute it again, also not after losing an executor, and Spark plans with
    its real size: as a join side it is broadcast if its files are within
    ``spark.sql.autoBroadcastJoinThreshold``, else the join is shuffled and adaptive execution splits
    hot keys. The frames this is used for come from aggregates over big tables, whose size Spark
    could only guess; a wrong guess shuffles the big table.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
