"""The one queue order: oldest first, rows without a time last, then by id."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def queue_sort() -> list[Column]:
    return [F.col("created_at").asc_nulls_last(), F.col("video_id").asc()]


def queue_key() -> Column:
    """The same order as one comparable value, for min and `<`."""
    return F.struct(
        F.col("created_at").isNull().alias("undated"),
        F.col("created_at"),
        F.col("video_id"),
    )
