"""Stream of state changes folded into the stored inventory.

Input columns: `video_id`, `status_fb`, `ts`, `event_id`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from cliptrack.schema import KEY
from cliptrack.sources.inventory import Inventory, repeat_on_conflict
from cliptrack.streaming.batches import stream_id
from cliptrack.streaming.timed import newest_status

EVENT_TIME = "event_time"
ARRIVAL = "arrival"


def latest_status(events: DataFrame) -> DataFrame:
    """Last status per item by event time; on a stream the newest of each item stays in
    state for ever, see `newest_status` for state that ends."""
    last = F.max(F.struct("ts", "event_id", "status_fb")).alias("last")
    return events.groupBy(KEY).agg(last).select(KEY, "last.*")


def status_patches(latest: DataFrame) -> DataFrame:
    return latest.select(
        KEY,
        "status_fb",
        F.array(F.lit("status_fb")).alias("set_cols"),
        F.col("ts").cast("timestamp").alias("at"),
        "event_id",
    )


def fold_into(
    events: DataFrame,
    inventory: Inventory,
    checkpoint: str,
    by: str = EVENT_TIME,
    lateness: str = "7 days",
) -> DataStreamWriter:
    """A stream writer that keeps the inventory at the latest status.

    By event time, state holds the items that moved within `lateness` and only items
    that moved are emitted, so an event that comes late never overrides a newer one, and
    one that comes later than that is dropped. By arrival no state is kept and a later
    micro-batch wins. Either way a
    micro-batch is one commit of patches, and a repeated one is skipped. The
    batch is written down first, because checking its ids reads it a second
    time and must not touch the state again.
    """
    if by not in (EVENT_TIME, ARRIVAL):
        raise ValueError(f"unknown order: {by}")

    def commit(batch: DataFrame, number: int) -> None:
        order = ("at", "event_id")
        with inventory.staged(batch) as changed:
            patches = status_patches(changed if by == EVENT_TIME else latest_status(changed))
            stream = stream_id(batch)
            repeat_on_conflict(lambda: inventory.patch(patches, order, stream, number))

    rows = newest_status(events, lateness) if by == EVENT_TIME else events
    return (
        rows.writeStream.outputMode("update" if by == EVENT_TIME else "append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(commit)
    )
