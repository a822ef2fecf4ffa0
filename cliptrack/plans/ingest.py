"""One ingest round for many sources at once.

The round has two halves, because downloading happens outside: `to_download`
says what to fetch, `ingest` takes what was fetched and makes inventory rows.
"""

from __future__ import annotations

from datetime import datetime
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cliptrack.functions import filled, is_filled, whole_seconds
from cliptrack.functions.backoff import Backoff, after_seconds
from cliptrack.operators.append import keep_first
from cliptrack.operators.candidates import first_per_source, listing_entries, new_entries
from cliptrack.operators.files import file_for_id
from cliptrack.operators.patches import moment, unmatched
from cliptrack.schema import FAILED, INVENTORY, KEY, PENDING

#: Columns that put the rows of a round in order, for the append.
ROUND_ORDER = ("listing", "pos")


class Ingest(NamedTuple):
    """Rows to append in ROUND_ORDER, results without an id, failed downloads."""

    rows: DataFrame
    rejects: DataFrame
    failures: DataFrame


def to_download(entries: DataFrame, inventory: DataFrame, per_source: int = 1) -> DataFrame:
    """The first new entries of each source."""
    return first_per_source(new_entries(entries, inventory), per_source)


def to_download_from_listings(
    listings: DataFrame, inventory: DataFrame, per_source: int = 1
) -> DataFrame:
    return to_download(listing_entries(listings), inventory, per_source)


def ingest(
    requested: DataFrame, downloads: DataFrame, files: DataFrame, at: datetime | None = None
) -> Ingest:
    """Inventory rows for what was requested and downloaded.

    The download's own id and address win over those of the entry; the file is
    the one named after the id, and the path stays empty where there is none.
    Where several sources brought the same id, the first in ROUND_ORDER stays,
    as the append would have it, before any join by id.
    """
    got = downloads.withColumnRenamed("source_url", "listing")
    return from_results(asked(requested).join(got, ["listing", "entry_id"]), files, at)


def asked(requested: DataFrame, *more: str) -> DataFrame:
    """What was requested, under the names that results have."""
    return requested.select(
        F.col("source_url").alias("listing"),
        "pos",
        F.col(KEY).alias("entry_id"),
        F.col("webpage_url").alias("entry_page"),
        *more,
    )


def from_results(results: DataFrame, files: DataFrame, at: datetime | None = None) -> Ingest:
    """Inventory rows for requests that have met their downloads, however they did."""
    results = results.withColumn(KEY, F.coalesce("id", "entry_id"))
    done = results.filter(F.col("error").isNull())
    first = keep_first(done.filter(is_filled(F.col(KEY))), KEY, ROUND_ORDER)
    return Ingest(
        rows=_inventory_rows(first.join(file_for_id(files, ids=first), KEY, "left"), at),
        rejects=done.filter(~is_filled(F.col(KEY))).select("listing", "pos", "entry_id"),
        failures=failure_patches(results.filter(F.col("error").isNotNull()), at),
    )


def _inventory_rows(results: DataFrame, at: datetime | None) -> DataFrame:
    absent = F.col("title").isNull() & ~F.coalesce("title_known", F.lit(False))
    values = {
        "source_url": filled(F.col("webpage_url"), F.col("entry_page"), F.col("listing")),
        "title": F.when(absent, "").otherwise(F.col("title")),
        "duration": whole_seconds(F.col("duration")),
        "path_local": F.coalesce("path_local", F.lit("")),
        "status_fb": F.lit(PENDING),
        "created_at": moment(at),
        "updated_at": moment(at),
    }
    return results.withColumns(values).select(*INVENTORY.names, *ROUND_ORDER)


def failure_patches(failed: DataFrame, at: datetime | None = None) -> DataFrame:
    """Patches that would mark failed downloads, one per entry id."""
    return (
        failed.select(F.col("entry_id").alias(KEY))
        .filter(F.col(KEY).isNotNull())
        .distinct()
        .select(
            KEY,
            F.lit(FAILED).alias("status_fb"),
            F.array(F.lit("status_fb")).alias("set_cols"),
            moment(at).alias("at"),
        )
    )


class Failures(NamedTuple):
    """Patches for failed downloads, those without an item, and when to retry."""

    patches: DataFrame
    unmatched: DataFrame
    retries: DataFrame


def record_download_failures(
    attempts: DataFrame,
    inventory: DataFrame,
    backoff: Backoff = Backoff(),
    seed: int = 0,
    at: datetime | None = None,
) -> Failures:
    """From failed attempts (`entry_id`, `attempt`, `failed_at`) to their effects.

    Attempts that still have a retry left get its time. An entry whose last
    attempt failed is marked failed; a new entry is not in the inventory yet,
    so its patch comes back as unmatched instead of vanishing.
    """
    spent = attempts.filter(F.col("attempt") >= backoff.retries)
    patches = failure_patches(spent, at)
    left = attempts.filter(F.col("attempt") < backoff.retries)
    return Failures(
        patches, unmatched(patches, inventory), retry_schedule(left, "entry_id", backoff, seed)
    )


def retry_schedule(
    attempts: DataFrame, item: str, backoff: Backoff = Backoff(), seed: int = 0
) -> DataFrame:
    """Wait and time of the next attempt, per failed attempt."""
    wait = backoff.spread_wait(F.col("attempt"), F.col(item), seed)
    return attempts.withColumn("wait_seconds", wait).withColumn(
        "next_attempt_at", after_seconds(F.col("failed_at"), F.col("wait_seconds"))
    )
