"""Identity of a stream, for commits that must happen once."""

from __future__ import annotations

from pyspark.sql import DataFrame


def stream_id(batch: DataFrame) -> str:
    """Id of the stream that made a micro-batch: kept over restarts, and new with
    a new checkpoint, whose batch numbers start again."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
