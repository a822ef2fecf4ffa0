"""Reports that make the inventory traceable by state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cliptrack.functions import is_filled
from cliptrack.schema import KEY, PENDING, READY


def status_census(inventory: DataFrame) -> DataFrame:
    return inventory.groupBy("status_fb").agg(F.count("*").alias("items"))


def stuck_rows(inventory: DataFrame) -> DataFrame:
    """Rows no stage picks up: pending without a path, and ready ones, which the
    default publishing filter does not accept."""
    status, path = F.col("status_fb"), F.col("path_local")
    reason = F.when((status == PENDING) & ~is_filled(path), "no file").when(
        status == READY, "ready not accepted"
    )
    return inventory.select(KEY, "status_fb", reason.alias("reason")).filter(
        F.col("reason").isNotNull()
    )


def orphans(inventory: DataFrame, files: DataFrame) -> DataFrame:
    """Files without an inventory row, and rows whose file does not exist.

    One aggregate by path tells both, which holds a flag and a count a path; joins would
    sort both sides, twice.
    """
    rows = inventory.filter(is_filled(F.col("path_local")))
    sides = files.select("path", F.lit(1).alias("files"), F.lit(0).alias("claimed")).unionAll(
        rows.select(F.col("path_local").alias("path"), F.lit(0).alias("files"), F.lit(1).alias("claimed"))
    )
    one_sided = (
        sides.groupBy("path")
        .agg(F.sum("files").alias("files"), F.max("claimed").alias("claimed"))
        .filter((F.col("files") == 0) | (F.col("claimed") == 0))
    )
    # A path that is listed twice is found twice.
    found = F.when(F.col("files") == 0, F.lit(1)).otherwise(F.col("files")).cast("int")
    finding = F.when(F.col("files") == 0, "row without file").otherwise("file without row")
    return one_sided.select(
        "path", F.explode(F.array_repeat(finding, found)).alias("finding")
    )
