"""State that ends: the newest status of items that still move, and retries until due.

Both are keyed state with timers of event time. Rows older than the watermark are
dropped by Spark before they get here, so whatever is older than that need not be
remembered: nothing that arrives can be older still.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from cliptrack.functions.backoff import Backoff
from cliptrack.plans.ingest import retry_schedule
from cliptrack.schema import KEY

RETRY = "retry"
SPENT = "spent"
#: Groups of entries whose waiting attempts are kept together.
BUCKETS = 512


def _ms(micros: int) -> int:
    """The first millisecond that isn't before the moment."""
    return -(-micros // 1000)


class _Newest(StatefulProcessor):
    """Hands on what is newer than all before it; forgets what the watermark has passed."""

    def init(self, handle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "micros long, event_id long, status_fb string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        best = before = tuple(self.last.get()) if self.last.exists() else None
        for frame in rows:
            top = frame.sort_values(["micros", "event_id", "status_fb"], na_position="first").iloc[-1]
            status = None if pd.isna(top["status_fb"]) else str(top["status_fb"])
            found = int(top["micros"]), int(top["event_id"]), status
            if best is None or (*found[:2], found[2] or "") > (*best[:2], best[2] or ""):
                best = found
        if best == before:
            return
        if before is not None:
            self.handle.deleteTimer(_ms(before[0]) + 1)
        self.last.update(best)
        self.handle.registerTimer(_ms(best[0]) + 1)
        yield pd.DataFrame(
            {KEY: [key[0]], "micros": [best[0]], "event_id": [best[1]], "status_fb": [best[2]]}
        )

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if self.last.exists() and _ms(self.last.get()[0]) + 1 <= expiredTimerInfo.getExpiryTimeInMs():
            self.last.clear()
        return iter([])

    def close(self) -> None:
        pass


def newest_status(events: DataFrame, lateness: str) -> DataFrame:
    """Last status per item by event time, of items that moved; events as for
    `latest_status`, which gives the same for a batch.

    An event that reaches Spark more than `lateness` after the newest one is dropped.
    State holds the items that changed within that time, whatever their status: an item
    that the watermark has passed leaves it, since any event that may still come is newer.
    """
    moving = events.select(KEY, "status_fb", F.col("ts").cast("timestamp").alias("ts"), "event_id")
    return (
        moving.withWatermark("ts", lateness)
        .withColumn("micros", F.unix_micros("ts"))
        .groupBy(KEY)
        .transformWithStateInPandas(
            _Newest(), f"{KEY} string, micros long, event_id long, status_fb string", "Update", "eventTime"
        )
        .select(KEY, F.timestamp_micros("micros").alias("ts"), "event_id", "status_fb")
    )


class _Due(StatefulProcessor):
    """Holds failed attempts until their next one is due; a success forgets them.

    A key is a bucket of entries, which has one list of what waits and one timer, for the
    earliest of it. So a bucket calls its store some times a micro-batch, however many
    attempts come or fall due in it.
    """

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "entry_id string, attempt int, due long, failed_at long")
        self.timer = handle.getValueState("timer", "at long")

    def _held(self) -> pd.DataFrame:
        # An attempt that is told twice waits once.
        held = pd.DataFrame(list(self.waiting.get()), columns=_WAITING)
        return held.drop_duplicates(["entry_id", "attempt", "due"], keep="last")

    def _hold_only(self, held: pd.DataFrame) -> None:
        if len(held):
            self.waiting.put(_tuples(held))
        else:
            self.waiting.clear()

    def _wake(self, due: int) -> None:
        """Set the timer for the moment, unless it is set for an earlier one."""
        at = _ms(due)
        if self.timer.exists():
            before = self.timer.get()[0]
            if before <= at:
                return
            self.handle.deleteTimer(before)
        self.timer.update((at,))
        self.handle.registerTimer(at)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        for frame in rows:
            frame = frame.sort_values(["at", "attempt"], ignore_index=True)
            ok = frame["ok"].astype(bool)
            spent = frame[~ok & frame["due"].isna()]
            if len(spent):
                yield _outcomes(spent["entry_id"], spent["attempt"], None, SPENT)
            waits = frame[~ok & frame["due"].notna()]
            if ok.any():
                # What failed before a success waits no more.
                last = frame[ok].reset_index().groupby("entry_id")[["index", "at"]].max()
                waits = waits[~(waits.index < waits["entry_id"].map(last["index"]))]
                held = self._held()
                forgotten = held["failed_at"] <= held["entry_id"].map(last["at"])
                if forgotten.any():
                    self._hold_only(held[~forgotten])
            if len(waits):
                waits = waits.assign(failed_at=waits["at"])[_WAITING]
                self.waiting.appendList(_tuples(waits))
                self._wake(int(waits["due"].min()))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.timer.clear()
        held = self._held()
        now = timerValues.getCurrentWatermarkInMs()
        due = (held["due"] + 999) // 1000 <= now
        self._hold_only(held[~due])
        if not due.all():
            self._wake(int(held.loc[~due, "due"].min()))
        if due.any():
            out = held[due]
            yield _outcomes(out["entry_id"], out["attempt"] + 1, out["due"], RETRY)

    def close(self) -> None:
        pass


_WAITING = ["entry_id", "attempt", "due", "failed_at"]


def _tuples(waits: pd.DataFrame) -> list[tuple]:
    return list(waits.astype({"attempt": int, "due": int, "failed_at": int}).itertuples(index=False, name=None))


def _outcomes(entry, attempt, due, outcome: str) -> pd.DataFrame:
    frame = pd.DataFrame({"entry_id": entry, "attempt": attempt, "due": due, "outcome": outcome})
    return frame.astype({"attempt": "int32", "due": "Int64"})


def due_attempts(
    attempts: DataFrame,
    lateness: str,
    backoff: Backoff = Backoff(),
    seed: int = 0,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Attempts to make, each when it is due: entry_id, attempt, due_at, outcome.

    attempts: entry_id, attempt, failed_at (the moment it ended) and ok. A failed attempt
    with a retry left waits as `retry_schedule` says, and is then handed on as the next
    one (RETRY), once the watermark has reached its time; so what is handed on goes by
    due time from one micro-batch to the next. A failed attempt without a retry left is
    handed on at once (SPENT, no time). A success forgets what still waits for its entry.
    Rows without an entry id only move the time. State holds waiting attempts alone, in
    `buckets` of entries by a hash of their ids; a checkpoint goes with one such number.
    """
    timed = attempts.select(
        "entry_id", F.col("attempt").cast("int").alias("attempt"),
        F.col("failed_at").cast("timestamp").alias("failed_at"), F.coalesce("ok", F.lit(False)).alias("ok"),
    )
    scheduled = retry_schedule(timed.withWatermark("failed_at", lateness), "entry_id", backoff, seed)
    # The condition names the time, or Spark would drop ticks before they move it.
    real = F.when(F.col("failed_at").isNotNull(), F.col("entry_id").isNotNull())
    return (
        scheduled.filter(real)
        .withColumn("at", F.unix_micros("failed_at"))
        .withColumn("due", F.unix_micros("next_attempt_at"))
        .withColumn("bucket", F.pmod(F.xxhash64("entry_id"), F.lit(buckets)))
        .drop("wait_seconds", "next_attempt_at")
        .groupBy("bucket")
        .transformWithStateInPandas(
            _Due(), "entry_id string, attempt int, due long, outcome string", "Append", "eventTime"
        )
        .select("entry_id", "attempt", F.timestamp_micros("due").alias("due_at"), "outcome")
    )
