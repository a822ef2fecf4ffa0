"""Stream of new rows appended with keep-first deduplication."""

from __future__ import annotations

import threading
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQueryListener

from cliptrack.schema import KEY
from cliptrack.sources.inventory import Inventory, repeat_on_conflict
from cliptrack.streaming.batches import stream_id


class ArrivalMetrics(StreamingQueryListener):
    """Per micro-batch of arrivals: offered, inserted, refused for no id, duplicate.

    Spark counts offered and refused rows as the stream passes them (`observe`) and tells
    them with its progress; inserted ones are those of the append. One row a micro-batch
    stays on the driver, until `taken` hands them over.
    """

    name = "arrivals"

    def __init__(self):
        self._seen: dict[int, dict[str, int]] = {}
        self._lock, self._ended = threading.Lock(), threading.Event()

    def observed(self, rows: DataFrame) -> DataFrame:
        counts = F.count(F.lit(1)).alias("offered"), F.count_if(F.col(KEY).isNull()).alias("refused")
        return rows.observe(self.name, *counts)

    def add(self, number: int, **counts: int) -> None:
        with self._lock:
            self._seen.setdefault(number, {}).update(counts)

    def onQueryStarted(self, event) -> None:
        self._ended.clear()

    def onQueryProgress(self, event) -> None:
        found = event.progress.observedMetrics.get(self.name)
        if found is not None:
            self.add(event.progress.batchId, offered=found["offered"], refused=found["refused"])

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._ended.set()

    def taken(self, timeout: float = 60) -> list[tuple[int, int, int, int, int]]:
        """(micro-batch, offered, inserted, refused, duplicate) of the query, once it has ended."""
        if not self._ended.wait(timeout):
            raise TimeoutError("the query has not ended")
        with self._lock:
            seen, self._seen = self._seen, {}
        return [
            (n, s["offered"], s["inserted"], s["refused"], s["offered"] - s["inserted"] - s["refused"])
            for n, s in sorted(seen.items())
            if "offered" in s and "inserted" in s
        ]


def append_into(
    rows: DataFrame,
    inventory: Inventory,
    checkpoint: str,
    order: Sequence[str],
    metrics: ArrivalMetrics | None = None,
) -> DataStreamWriter:
    """A stream writer that appends rows whose id is new.

    The inventory itself is the memory of what was seen, so no stream state
    grows with it. A repeated micro-batch is skipped. Metrics are told what was
    appended; add them to the session's listeners to hear the rest.
    """

    def commit(batch: DataFrame, number: int) -> None:
        stream = stream_id(batch)
        done = repeat_on_conflict(lambda: inventory.append(batch, order, stream, number))
        if metrics is not None:
            metrics.add(number, inserted=done.inserted)

    return (
        (rows if metrics is None else metrics.observed(rows))
        .writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(commit)
    )
