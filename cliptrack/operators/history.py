"""What states items were in, and for how long, from their transitions.

Transitions are rows (video_id, ts, event_id, status_fb); event_id decides between those
of one moment. An item may have a third of all transitions, so nothing is a window over
an item: time is cut into slices, windows run within an item's slice, and over the
slices runs a window with one row a slice. Slices are to be chosen so that an item's
share of one is bounded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cliptrack.schema import KEY

SLICE = 3600


def _slice(moment: str, seconds: int) -> Column:
    return F.floor(F.unix_micros(F.col(moment).cast("timestamp")) / (seconds * 1_000_000)).alias("slice")



def status_at(transitions: DataFrame, moments: DataFrame, seconds: int = SLICE) -> DataFrame:
    """moments (video_id, at, and any others) with status_fb and since: the last transition
    at or before the moment; null before the first. Rows with a null id or moment have null.

    An as-of join without an inequality join: transitions and moments are one table, in
    which a moment sees the last transition above it in its slice, or else the last one
    of the slices before.
    """
    others = [c for c in moments.columns if c not in (KEY, "at")]
    events = transitions.select(
        KEY, _slice("ts", seconds), F.col("ts").alias("time"),
        F.struct("ts", "event_id", "status_fb").alias("event"),
    )
    asked = moments.select(
        KEY, _slice("at", seconds), F.col("at").alias("time"), F.struct("at", *others).alias("asked")
    )
    # One row an item and slice, of either side, with what it ends in.
    ends = (
        events.groupBy(KEY, "slice")
        .agg(F.max("event").alias("event"))
        .unionByName(asked.select(KEY, "slice").distinct(), allowMissingColumns=True)
        .groupBy(KEY, "slice")
        .agg(F.max("event").alias("event"))
    )
    earlier = Window.partitionBy(KEY).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(KEY, "slice", F.max("event").over(earlier).alias("carried"))
    both = events.unionByName(asked, allowMissingColumns=True)
    # Transitions of the same moment come first.
    above = (
        Window.partitionBy(KEY, "slice")
        .orderBy("time", F.col("asked").isNotNull(), "event.event_id")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    seen = both.withColumn("found", F.max("event").over(above)).filter(F.col("asked").isNotNull())
    joined = seen.join(
        carried.select(F.col(KEY).alias("of"), F.col("slice").alias("in"), "carried"),
        (F.col(KEY) == F.col("of")) & (F.col("slice") == F.col("in")),
        "left",
    )
    found = F.when(F.col(KEY).isNotNull(), F.coalesce("found", "carried"))
    return joined.withColumn("found", found).select(
        KEY, "asked.at", *(f"asked.{c}" for c in others),
        F.col("found.status_fb").alias("status_fb"), F.col("found.ts").alias("since"),
    )


def intervals(transitions: DataFrame, seconds: int = SLICE) -> DataFrame:
    """Each transition with `until`, the moment of the item's next one; null for the last."""
    rows = transitions.select(KEY, "ts", "event_id", "status_fb").withColumn("slice", _slice("ts", seconds))
    first = rows.groupBy(KEY, "slice").agg(F.min("ts").alias("first"))
    over = Window.partitionBy(KEY).orderBy("slice")
    following = first.select(KEY, "slice", F.lead("first").over(over).alias("following"))
    within = Window.partitionBy(KEY, "slice").orderBy("ts", "event_id")
    return (
        rows.withColumn("next", F.lead("ts").over(within))
        .join(following, [KEY, "slice"])
        .select(KEY, "ts", "event_id", "status_fb", F.coalesce("next", "following").alias("until"))
    )


def time_in_state(transitions: DataFrame, seconds: int = SLICE) -> DataFrame:
    """video_id, status_fb, visits and seconds spent in each state that was left again."""
    spent = F.unix_micros(F.col("until").cast("timestamp")) - F.unix_micros(F.col("ts").cast("timestamp"))
    return (
        intervals(transitions, seconds)
        .withColumn("micros", spent)
        .groupBy(KEY, "status_fb")
        .agg(F.count("*").alias("visits"), F.coalesce(F.sum("micros"), F.lit(0)).alias("micros"))
        .select(KEY, "status_fb", "visits", (F.col("micros") / 1e6).alias("seconds"))
    )


def stuck_since(transitions: DataFrame) -> DataFrame:
    """video_id, status_fb and since: when each item entered the state that it is in.

    Aggregates only, which fold in every task: the last transition, the last one to
    another state, and the first after that.
    """
    by_state = transitions.groupBy(KEY, "status_fb").agg(F.max(F.struct("ts", "event_id")).alias("last"))
    now = by_state.groupBy(KEY).agg(F.max(F.struct("last", "status_fb")).alias("now"))
    other = (
        by_state.join(now, KEY)
        .filter(~F.col("status_fb").eqNullSafe(F.col("now.status_fb")))
        .groupBy(KEY)
        .agg(F.max("last").alias("other"))
    )
    ends = now.join(other, KEY, "left").select(KEY, F.col("now.status_fb").alias("status"), "other")
    after = F.col("other").isNull() | (F.struct("ts", "event_id") > F.col("other"))
    return (
        transitions.join(ends, KEY)
        .filter(after)
        .groupBy(KEY)
        .agg(F.min("ts").alias("since"), F.first("status").alias("status_fb"))
        .select(KEY, "status_fb", "since")
    )
