"""Requests meet their downloads, both as streams.

A request waits for its download in the state of a stream-stream join, and leaves it
when the download comes or when it can come in time no more. State so holds the
requests and downloads of one patience, not those of all time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from cliptrack.functions import is_filled
from cliptrack.plans.ingest import ROUND_ORDER, asked, from_results
from cliptrack.schema import DOWNLOAD
from cliptrack.sources.inventory import Inventory, repeat_on_conflict
from cliptrack.streaming.batches import stream_id

#: What is said of a request whose download did not come in time.
MISSING = "no download in time"

_TAKEN = [f.name for f in DOWNLOAD if f.name not in ("source_url", "entry_id")]


def met(
    requests: DataFrame, downloads: DataFrame, patience: str = "1 hour", lateness: str = "10 minutes"
) -> DataFrame:
    """Each request with its download, or with the error MISSING where none came in time.

    requests: source_url, pos, video_id, webpage_url, requested_at. downloads: DOWNLOAD
    and fetched_at. In time is a download within `patience` after the request; both may
    reach Spark `lateness` after the newest row of their stream. Requests that are still
    waiting have no row yet: one leaves without its download once the time of both
    streams has passed its patience. A download that nobody asked for has no row. A
    request that was fetched twice has two, of which the ingest keeps the first.

    Time moves with the rows of both streams. Where one may be silent, send ticks: rows
    with an empty id and listing; `ingest_into` leaves them out.
    """
    waiting = asked(requests, "requested_at").withWatermark("requested_at", lateness)
    fetched = downloads.select(
        F.col("source_url").alias("from_listing"), F.col("entry_id").alias("for_entry"), *_TAKEN, "fetched_at"
    ).withWatermark("fetched_at", lateness)
    # Without an upper bound no request would ever be given up.
    together = F.expr(
        f"""listing = from_listing and entry_id = for_entry
            and fetched_at between requested_at and requested_at + interval {patience}"""
    )
    pairs = waiting.join(fetched, together, "left_outer")
    missing = F.when(F.col("fetched_at").isNull(), MISSING).otherwise(F.col("error"))
    return pairs.withColumn("error", missing).drop("from_listing", "for_entry")


def ingest_into(
    results: DataFrame, inventory: Inventory, files: Callable[[], DataFrame], checkpoint: str
) -> DataStreamWriter:
    """A stream writer that ingests requests that have met their downloads.

    results: what `met` gives. files: the files as they are when a micro-batch is taken.
    Failures come before appends, as in a round; a micro-batch is one numbered commit of
    each, and one that comes again is skipped. Patches of new items match nothing and are
    kept as such: `inventory.transitions(unmatched=True)`.
    """

    def commit(batch: DataFrame, number: int) -> None:
        stream = stream_id(batch)
        real = batch.filter(is_filled(F.col("entry_id")))
        # Written down, so that the join's state is touched once.
        with inventory.staged(real) as rows:
            done = from_results(rows.drop("requested_at", "fetched_at"), files())
            repeat_on_conflict(
                lambda: inventory.patch(done.failures, writer=f"{stream}-failed", number=number)
            )
            repeat_on_conflict(lambda: inventory.append(done.rows, ROUND_ORDER, stream, number))

    return (
        results.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(commit)
    )
