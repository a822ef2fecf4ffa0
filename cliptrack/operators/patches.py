"""Conditional updates: one item, a set of items, and patch tables.

A patch row names the item, the columns it sets and their values. Patches for
the same item are folded to one before they are applied, and patches for items
that do not exist are a result of their own, never lost.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime, timezone
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cliptrack.operators.keys import in_table, not_in_table
from cliptrack.schema import KEY, TOUCHED, UPDATABLE


class Updates(NamedTuple):
    known: dict[str, Any]
    ignored: list[str]


def check_updates(columns: Iterable[str], updates: Mapping[str, Any]) -> Updates:
    """Split updates into those for real columns and those that are ignored."""
    fixed = sorted({KEY, TOUCHED} & set(updates))
    if fixed:
        raise ValueError(f"cannot be set by an update: {fixed}")
    columns = set(columns)
    return Updates(
        {c: v for c, v in updates.items() if c in columns},
        [c for c in updates if c not in columns],
    )


def moment(at: datetime | None) -> Column:
    """A fixed time for the whole job, now in UTC unless given."""
    return F.lit(at or datetime.now(timezone.utc))


def _literal(table: DataFrame, column: str, value: Any) -> Column:
    return F.lit(value).cast(table.schema[column].dataType)


def update_where(
    table: DataFrame, condition: Column, updates: Mapping[str, Any], at: datetime | None = None
) -> DataFrame:
    """Set columns on the rows that meet a condition, and their touch time.

    One projection: every expression reads the old row. A null condition leaves
    the row alone. Unknown columns are ignored, the touch time moves anyway.
    """
    known = check_updates(table.columns, updates).known
    values = {c: _literal(table, c, v) for c, v in known.items()}
    values[TOUCHED] = moment(at).cast(table.schema[TOUCHED].dataType)
    return table.withColumns(
        {c: F.when(condition, v).otherwise(F.col(c)) for c, v in values.items()}
    )


def update_by_id(
    table: DataFrame, video_id: str, updates: Mapping[str, Any], at: datetime | None = None
) -> DataFrame:
    return update_where(table, F.col(KEY) == F.lit(video_id), updates, at)


def update_by_ids(
    table: DataFrame, ids: DataFrame, updates: Mapping[str, Any], at: datetime | None = None
) -> DataFrame:
    """The same update for every id of a table of ids, of any size."""
    return apply_patches(table, patch_for(ids, table, updates, at))


def patch_for(
    ids: DataFrame, table: DataFrame, updates: Mapping[str, Any], at: datetime | None = None
) -> DataFrame:
    """A patch that gives every id the same values; repeated ids count once."""
    known = check_updates(table.columns, updates).known
    return (
        ids.select(KEY)
        .filter(F.col(KEY).isNotNull())
        .distinct()
        .select(
            KEY,
            *(_literal(table, c, v).alias(c) for c, v in known.items()),
            F.array(*(F.lit(c) for c in known)).cast("array<string>").alias("set_cols"),
            moment(at).cast(table.schema[TOUCHED].dataType).alias("at"),
        )
    )


def patch_columns(patches: DataFrame) -> list[str]:
    return [c for c in patches.columns if c in UPDATABLE]


def is_set(column: str) -> Column:
    return F.array_contains("set_cols", F.lit(column))


def fold_patches(patches: DataFrame, order: Sequence[str] = ("at",)) -> DataFrame:
    """One patch per item: per column the last value that was really set.

    Null is a value like any other. The maxima fold map-side, so an item with
    most of the patches arrives as one row per task.
    """
    columns = patch_columns(patches)
    last = [
        F.max(F.when(is_set(c), F.struct(*order, F.col(c).alias("value")))).alias(c)
        for c in columns
    ]
    latest = F.max(F.struct(*order, F.col("at").alias("moment"))).alias("latest")
    set_cols = F.array_compact(
        F.array(*(F.when(F.col(c).isNotNull(), F.lit(c)) for c in columns))
    ).cast("array<string>")
    return (
        patches.groupBy(KEY)
        .agg(*last, latest)
        .select(
            KEY,
            *(F.col(f"{c}.value").alias(c) for c in columns),
            set_cols.alias("set_cols"),
            F.col("latest.moment").alias("at"),
        )
    )


def apply_patches(table: DataFrame, patches: DataFrame) -> DataFrame:
    """The table after its patches, in its own types; at most one patch per item."""
    columns = set(patch_columns(patches))

    def value(column: str) -> Column:
        old = F.col(f"t.{column}")
        if column == TOUCHED:
            chosen, new = F.col("p.at").isNotNull(), F.col("p.at")
        elif column in columns:
            chosen = F.array_contains("p.set_cols", F.lit(column))
            new = F.col(f"p.{column}")
        else:
            return old
        new = new.cast(table.schema[column].dataType)
        return F.when(chosen, new).otherwise(old).alias(column)

    joined = table.alias("t").join(
        patches.alias("p"), F.col(f"t.{KEY}") == F.col(f"p.{KEY}"), "left"
    )
    return joined.select(*(value(c) for c in table.columns))


def matched(patches: DataFrame, table: DataFrame) -> DataFrame:
    return in_table(patches, table, KEY)


def unmatched(patches: DataFrame, table: DataFrame) -> DataFrame:
    """Patches for items the table does not have: the update had no effect."""
    return not_in_table(patches, table, KEY)


def transitions(
    patches: DataFrame, table: DataFrame, run_id: str, keep: Sequence[str] = ()
) -> DataFrame:
    """Audit rows for the patches that took effect: item, columns, time, run."""
    return matched(patches, table).select(
        KEY, F.col("set_cols").alias("changes"), "at", F.lit(run_id).alias("run_id"), *keep
    )
