"""Analysis tables kept up to date by partition, without reading the whole table again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revtide.operators.layout import compact
from revtide.operators.statistics import (
    coverage_of_states,
    release_statistics_of_states,
    statistics_states,
    value_statistics_of_states,
)
from revtide.session import stored
from revtide.sources.tables import overwrite_touched, read_table, remove, save, table_exists


def refresh_states(
    rows: DataFrame, path: str, partitions: Sequence[str], touched: DataFrame | None = None
) -> None:
    """Bring the states of the touched partitions up to date, by default of all.

    ``rows`` is the table and ``touched`` names values of its partition columns; only those directories of the table are
    read, and only theirs are replaced. A partition without rows any more loses its states.
    """
    spark = rows.sparkSession
    if touched is not None:
        touched = stored(touched.select(*partitions).distinct(), "touched")
        rows = rows.join(touched, list(partitions), "left_semi")
    states = stored(statistics_states(rows, partitions), "states")
    old = None
    if table_exists(spark, path):
        folder = F.regexp_extract("_metadata.file_path", "^(.*)/[^/]*$", 1).alias("_folder")
        old = read_table(spark, path).select(*partitions, folder).distinct()
        if touched is not None:
            old = old.join(touched, list(partitions), "left_semi")
        new = states.select(*partitions).distinct()
        old = stored(old.join(new, list(partitions), "left_anti").select("_folder"), "emptied")
    overwrite_touched(compact(states, partitions), path, partitions)
    for (gone,) in old.toLocalIterator() if old is not None else ():
        remove(spark, spark._jvm.java.net.URI(gone))


def save_analysis_of_states(spark: SparkSession, states_path: str, path: str) -> dict[str, str]:
    """Write coverage, value and release statistics from the states; returns their paths."""
    states = read_table(spark, states_path)
    frames = {
        "series_coverage": coverage_of_states(states),
        "value_statistics": value_statistics_of_states(states),
        "release_statistics": release_statistics_of_states(states),
    }
    for name, frame in frames.items():
        save(frame, f"{path}/{name}")
    return {name: f"{path}/{name}" for name in frames}
