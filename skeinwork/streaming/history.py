"""Upkeep of a system-versioned table from a stream of changes.

This is an extension: the vocabulary itself has no streams.  Each micro-batch is one point in time; its changes are applied
to the current rows, and replaced rows go to history.  A batch that is run again after a failure writes the same paths
again, so it counts once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skeinwork.operators.temporal import Period, maintain


def last_changes(changes: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last change of each key of a batch."""
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*[F.col(o).desc() for o in order]))
    return changes.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def history_writer(folder: str, key: Sequence[str], order: Sequence[str], clock: Callable[[int], datetime], period: Period = Period()) -> Callable[[DataFrame, int], None]:
    """A function for foreachBatch.  Generation n holds the table after batch n, under current/n and history/n; generation -1 is the start."""

    def write(changes: DataFrame, batch: int) -> None:
        spark = changes.sparkSession
        current, history = (spark.read.parquet(f"{folder}/{part}/{batch - 1}") for part in ("current", "history"))
        now, gone = maintain(current, history, last_changes(changes, key, order), key, clock(batch), period)
        now.write.mode("overwrite").parquet(f"{folder}/current/{batch}")
        gone.write.mode("overwrite").parquet(f"{folder}/history/{batch}")

    return write
