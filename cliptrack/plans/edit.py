"""Planning of edits and recording of what became of them."""

from __future__ import annotations

from datetime import datetime
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cliptrack.functions import changes_picture, crop_box, edit_plan, output_path
from cliptrack.operators.files import flag_on_disk
from cliptrack.operators.patches import (
    apply_patches,
    fold_patches,
    moment,
    patch_for,
    unmatched,
)
from cliptrack.operators.selection import editable, first_rows
from cliptrack.schema import FAILED, KEY, READY


class EditPlan(NamedTuple):
    """Edits to render, and patches for rows whose source file is missing."""

    edits: DataFrame
    failures: DataFrame


def plan_edits(
    inventory: DataFrame,
    files: DataFrame,
    n: int | None = 1,
    seed: int = 0,
    run: str = "0",
    at: datetime | None = None,
    sizes: DataFrame | None = None,
    exclude_processed: bool = False,
) -> EditPlan:
    """Plans for the n oldest editable rows (None: all of them).

    A plan depends on item, seed and run only, so it is the same on every
    re-run and under any partitioning. With `sizes` (`video_id`, `width`,
    `height`) it also holds the box the zoom edit crops to.
    """
    rows = first_rows(editable(inventory, exclude_processed), n).select(KEY, "path_local")
    checked = flag_on_disk(rows, files)
    missing = checked.filter(~F.col("on_disk"))
    edits = checked.filter("on_disk").select(
        KEY,
        "path_local",
        output_path(F.col("path_local"), F.col(KEY), moment(at), run).alias("output_path"),
        edit_plan(F.col(KEY), seed).alias("edits"),
    )
    edits = edits.withColumn("effective", changes_picture(F.col("edits")))
    if sizes is not None:
        box = F.when(F.array_contains("edits", "zoom"), crop_box(F.col("width"), F.col("height")))
        edits = edits.join(sizes, KEY, "left").withColumn("crop", box).drop("width", "height")
    return EditPlan(edits, patch_for(missing, inventory, {"status_fb": FAILED}, at))


def edit_patches(results: DataFrame, at: datetime | None = None) -> DataFrame:
    """Rendered items become ready under their new path; the others fail."""
    ok = F.coalesce("ok", F.lit(False))
    return results.select(
        KEY,
        F.when(ok, F.col("path_local")).alias("path_local"),
        F.when(ok, READY).otherwise(FAILED).alias("status_fb"),
        F.when(ok, F.array(F.lit("path_local"), F.lit("status_fb")))
        .otherwise(F.array(F.lit("status_fb")))
        .alias("set_cols"),
        moment(at).alias("at"),
    )


class EditsRecorded(NamedTuple):
    """The inventory after the results, and the results for unknown items."""

    inventory: DataFrame
    unmatched: DataFrame


def folded_results(results: DataFrame, at: datetime | None = None) -> DataFrame:
    """One patch per item. Of several results for an item a success counts, and of
    several successes the last path."""
    return fold_patches(edit_patches(results, at), ("status_fb", "path_local"))


def apply_edit_results(
    inventory: DataFrame, results: DataFrame, at: datetime | None = None
) -> EditsRecorded:
    """Fold the results, apply them, and return those for unknown items."""
    patches = folded_results(results, at)
    return EditsRecorded(apply_patches(inventory, patches), unmatched(patches, inventory))
