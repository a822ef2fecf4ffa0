"""Checks of inventory paths against the files that really exist."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cliptrack.functions import file_name, is_filled, is_partial
from cliptrack.operators.keys import flag_known, in_table, not_in_table
from cliptrack.schema import RAW_DIR


def _as_paths(files: DataFrame) -> DataFrame:
    return files.select(F.col("path").alias("path_local"))


def flag_on_disk(rows: DataFrame, files: DataFrame) -> DataFrame:
    """All rows with `on_disk`. Meant for rows that have a path."""
    return flag_known(rows, _as_paths(files), "path_local", "on_disk")


def on_disk(rows: DataFrame, files: DataFrame) -> DataFrame:
    return in_table(rows, _as_paths(files), "path_local")


def missing_on_disk(rows: DataFrame, files: DataFrame) -> DataFrame:
    return not_in_table(rows, _as_paths(files), "path_local")


def unclaimed_files(files: DataFrame, inventory: DataFrame) -> DataFrame:
    """Files that no inventory row points at."""
    claimed = inventory.filter(is_filled(F.col("path_local")))
    claimed = claimed.select(F.col("path_local").alias("path")).distinct()
    return files.join(claimed, "path", "left_anti")


def file_for_id(
    files: DataFrame, folder: str = RAW_DIR, ids: DataFrame | None = None
) -> DataFrame:
    """Smallest path per id, for files called `<id>.<anything>` in the folder.

    With `ids`, only for those: other files are left out before anything is grouped.

    An id may hold dots itself, so a file counts for every part of its name
    that ends before a dot: `a.b.mp4` serves `a` and `a.b`. Partial downloads
    serve nobody.
    """
    parts = F.split(file_name(F.col("path")), r"\.")
    direct = F.col("path") == F.concat(F.lit(folder + "/"), file_name(F.col("path")))
    ends = F.sequence(F.lit(1), F.size(parts) - 1)
    stems = F.transform(ends, lambda n: F.array_join(F.slice(parts, F.lit(1), n), "."))
    named = files.filter(direct & ~is_partial(F.col("path")) & (F.size(parts) > 1)).select(
        "path", F.explode(stems).alias("video_id")
    )
    if ids is not None:
        named = in_table(named, ids, "video_id")
    return named.groupBy("video_id").agg(F.min("path").alias("path_local"))


#: What may become of a file between two manifests.
APPEARED, VANISHED, CHANGED = "appeared", "vanished", "changed"


def manifest_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """path, change, length and modified (of the newer side) of every file that differs.

    Both are manifests with one row a file. A file has changed if its length or its time
    is another one; nulls are equal to each other.
    """
    facts = ("length", "modified")
    old = before.select("path", F.struct(*facts).alias("old"))
    new = after.select("path", F.struct(*facts).alias("new"))
    change = (
        F.when(F.col("old").isNull(), APPEARED)
        .when(F.col("new").isNull(), VANISHED)
        .when(~F.col("old").eqNullSafe(F.col("new")), CHANGED)
    )
    now = F.coalesce("new", "old")
    return (
        old.join(new, "path", "full_outer")
        .select("path", change.alias("change"), *(now[f].alias(f) for f in facts))
        .filter(F.col("change").isNotNull())
    )


def recheck(rows: DataFrame, changes: DataFrame) -> DataFrame:
    """Rows that point at a file that differs, with what became of it: a file check that
    looks at the changed paths only. Every row has its answer as of the earlier check but
    these."""
    return rows.join(changes.select(F.col("path").alias("path_local"), "change"), "path_local").select(
        *rows.columns, "change"
    )
