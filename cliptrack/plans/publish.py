"""Choice of what to publish next, and marks that come back from publishing."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cliptrack.operators.patches import apply_patches, patch_for, unmatched
from cliptrack.operators.sweep import FAIL, NEXT, sweep
from cliptrack.schema import FAILED, KEY, PENDING


class Publication(NamedTuple):
    """At most one row to publish, and patches for missing files before it."""

    chosen: DataFrame
    failures: DataFrame


def publication(swept: DataFrame, inventory: DataFrame, at: datetime | None) -> Publication:
    """What a sweep's outcomes mean for the inventory."""
    missing = swept.filter(F.col("outcome") == FAIL)
    return Publication(
        swept.filter(F.col("outcome") == NEXT).select(KEY, "path_local"),
        patch_for(missing, inventory, {"status_fb": FAILED}, at),
    )


def next_to_publish(
    inventory: DataFrame,
    files: DataFrame,
    at: datetime | None = None,
    statuses: Iterable[str] = (PENDING,),
) -> Publication:
    return publication(sweep(inventory, files, statuses), inventory, at)


class Marked(NamedTuple):
    """The inventory after the marks, and the marks for unknown ids."""

    inventory: DataFrame
    unmatched: DataFrame


def mark(
    inventory: DataFrame, ids: DataFrame, status: str, at: datetime | None = None
) -> Marked:
    """Set a status on every id. No transition is refused."""
    patches = patch_for(ids, inventory, {"status_fb": status}, at)
    return Marked(apply_patches(inventory, patches), unmatched(patches, inventory))
