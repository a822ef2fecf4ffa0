"""Choice of the next file to publish, failing the missing ones before it."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cliptrack.functions import queue_key
from cliptrack.operators.files import on_disk
from cliptrack.operators.selection import publishable
from cliptrack.schema import PENDING

NEXT = "next"
FAIL = "failed"
LEAVE = "untouched"


def sweep(
    inventory: DataFrame, files: DataFrame, statuses: Iterable[str] = (PENDING,)
) -> DataFrame:
    """Outcome per publishable row: failed before the first file found, then next.

    Rows behind the chosen one are untouched, whether their file exists or not;
    with no file at all every row fails. The first file found is one aggregate
    over the rows with a file (rows that share a path are folded first), and
    everything before it is missing by definition, so the second pass compares
    keys only: no join, no ranking, no ordered window.
    """
    rows = publishable(inventory, tuple(statuses)).withColumn("turn", queue_key())
    by_path = rows.groupBy("path_local").agg(F.min("turn").alias("turn"))
    found = on_disk(by_path, files).agg(F.min("turn").alias("turn"))
    first = F.col("first")
    outcome = (
        F.when(first.isNull() | (F.col("turn") < first), FAIL)
        .when(F.col("turn") == first, NEXT)
        .otherwise(LEAVE)
    )
    return rows.withColumn("first", found.scalar()).select(
        "video_id", "path_local", outcome.alias("outcome")
    )
