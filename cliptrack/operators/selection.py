"""Filters, projections and first-row queries over the inventory."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cliptrack.functions import queue_sort
from cliptrack.schema import KEY, PENDING, PROCESSED_MARK


def with_id(inventory: DataFrame, video_id: str) -> DataFrame:
    return inventory.filter(F.col(KEY) == F.lit(video_id))


def exists(rows: DataFrame, condition: Column) -> bool:
    """Whether any row meets the condition; stops at the first one found."""
    return not rows.filter(condition).isEmpty()


def any_match(rows: DataFrame, condition: Column, name: str = "any_match") -> DataFrame:
    """One row telling whether any row meets the condition; false on no rows."""
    return rows.agg(F.coalesce(F.bool_or(condition), F.lit(False)).alias(name))


def has_mark(path: Column) -> Column:
    """The mark may stand anywhere in the path, and is taken literally."""
    return F.contains(path, F.lit(PROCESSED_MARK))


def editable(inventory: DataFrame, exclude_processed: bool = False) -> DataFrame:
    """Pending rows that have a file path."""
    path = F.col("path_local")
    rows = inventory.filter((F.col("status_fb") == PENDING) & (path != ""))
    return rows.filter(~has_mark(path)) if exclude_processed else rows


def publishable(inventory: DataFrame, statuses: Iterable[str] = (PENDING,)) -> DataFrame:
    """Rows in one of the statuses whose path points at a processed file."""
    return inventory.filter(F.col("status_fb").isin(*statuses) & has_mark(F.col("path_local")))


def first_rows(rows: DataFrame, n: int | None = 1) -> DataFrame:
    """The n oldest rows (a top-k: no full sort), or all of them for None."""
    return rows if n is None else rows.orderBy(*queue_sort()).limit(n)


def next_publishable(
    inventory: DataFrame, n: int = 1, statuses: Iterable[str] = (PENDING,)
) -> DataFrame:
    """Id and path of the n oldest publishable rows, without a file check."""
    rows = publishable(inventory, statuses)
    return first_rows(rows.select(KEY, "path_local", "created_at"), n).drop("created_at")
