"""From fetched listings to the first entries that are not in the inventory."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cliptrack.functions import filled
from cliptrack.operators.keys import not_in_table
from cliptrack.schema import KEY

ENTRY_COLUMNS = ("source_url", "pos", "video_id", "url", "webpage_url")

#: Positions covered by one ranking group, which bounds what a single task sorts.
RANK_WIDTH = 1000
#: Parts that the rows without a position are cut into.
UNPLACED_PARTS = 4096


def listing_entries(listings: DataFrame) -> DataFrame:
    """One row per usable entry: an id and an address, in listing position.

    A listing without entries but with an id counts as its own single entry.
    """
    itself = F.array(F.struct("id", "url", "webpage_url"))
    entries = F.when(F.size(F.coalesce("entries", F.array())) > 0, F.col("entries")).when(
        F.col("id").isNotNull(), itself
    )
    return usable_entries(
        listings.select("source_url", F.posexplode(entries).alias("pos", "entry")).select(
            "source_url",
            F.col("pos").cast("bigint").alias("pos"),
            F.col("entry.id").alias(KEY),
            "entry.url",
            "entry.webpage_url",
        )
    )


def usable_entries(entries: DataFrame) -> DataFrame:
    """Drop entries without source, id or address; `url` becomes the address used.

    Takes listings that are stored flat already, one row per entry, which is
    the form for sources too long for one array.
    """
    return entries.withColumn("url", filled(F.col("url"), F.col("webpage_url"))).filter(
        (F.col("source_url") != "") & (F.col(KEY) != "") & F.col("url").isNotNull()
    ).select(*ENTRY_COLUMNS)


def new_entries(entries: DataFrame, inventory: DataFrame) -> DataFrame:
    """Entries whose id is not in the inventory: one anti-join, no lookups."""
    return not_in_table(entries, inventory, KEY)


def first_per_source(entries: DataFrame, per_source: int = 1) -> DataFrame:
    """The first entries of each source, each id once, in listing order.

    Both aggregates fold map-side, so a source holding most rows arrives as one
    row per task.
    """
    rest = [c for c in ENTRY_COLUMNS if c not in ("source_url", "pos")]
    earliest = F.min(F.struct("pos", *rest)).alias("e")
    if per_source == 1:
        return entries.groupBy("source_url").agg(earliest).select("source_url", "e.*")
    once = (
        entries.groupBy("source_url", KEY)
        .agg(F.min(F.struct("pos", "url", "webpage_url")).alias("e"))
        .select("source_url", "e.pos", KEY, "e.url", "e.webpage_url")
    )
    return first_in_group(once, "source_url", "pos", KEY, per_source).select(*ENTRY_COLUMNS)


def first_in_group(rows: DataFrame, group: str, position: str, tie: str, n: int) -> DataFrame:
    """The n rows of each group with the smallest position.

    A group is ranked in slices of positions: counts per slice give each slice its
    starting rank, slices that start beyond n are dropped, and each other slice is
    ranked by itself, so that no task sorts a whole group. A position repeats within
    a source only as often as the source was listed. Rows without a position come
    first, in a slice of their own, of which parts by hash pass on n rows each.
    """
    unplaced = F.col(position).isNull()
    part = Window.partitionBy(group, F.pmod(F.xxhash64(tie), F.lit(UNPLACED_PARTS))).orderBy(tie)
    few = rows.filter(unplaced).withColumn("inside", F.row_number().over(part)).filter(F.col("inside") <= n)
    placed = rows.filter(~unplaced).unionByName(few.drop("inside"))
    sliced = placed.withColumn("slice", F.floor(F.col(position) / F.lit(RANK_WIDTH)))
    before = Window.partitionBy(group).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        sliced.groupBy(group, "slice")
        .agg(F.count("*").alias("size"))
        .withColumn("start", F.coalesce(F.sum("size").over(before), F.lit(0)))
        .filter(F.col("start") < n)
        .select(F.col(group).alias("_group"), F.col("slice").alias("_slice"), "start")
    )
    same = F.col(group).eqNullSafe(F.col("_group")) & F.col("slice").eqNullSafe(F.col("_slice"))
    inside = Window.partitionBy(group, "slice").orderBy(position, tie)
    return (
        sliced.join(starts, same)
        .withColumn("inside", F.row_number().over(inside))
        .filter(F.col("inside") <= n)
        .withColumn("rank", F.col("start") + F.col("inside"))
        .filter(F.col("rank") <= n)
        .select(*rows.columns, "rank")
    )
