"""Small tables for the scenario tests."""

from datetime import datetime, timedelta, timezone

from cliptrack.schema import DOWNLOAD, EDIT_RESULT, INVENTORY, LISTING, MEDIA_FILE, PATCH
from cliptrack.sources.listings import rows_from_records

T0 = datetime(2025, 1, 1, tzinfo=timezone.utc)


def at(minutes: float) -> datetime:
    return T0 + timedelta(minutes=minutes)


def item(video_id, status="pending", path="videos/raw/dusk.mov", minutes=0, **more):
    created = None if minutes is None else at(minutes)
    row = {
        "video_id": video_id,
        "source_url": "https://clips.example.org/watch",
        "title": "Harbour at dusk",
        "duration": 318,
        "path_local": path,
        "status_fb": status,
        "created_at": created,
        "updated_at": created,
    }
    return {**row, **more}


def inventory(spark, *items):
    return rows_from_records(spark, items, INVENTORY)


def listings(spark, *records):
    return rows_from_records(spark, records, LISTING)


def downloads(spark, *records):
    return rows_from_records(spark, records, DOWNLOAD)


def results(spark, *records):
    return rows_from_records(spark, records, EDIT_RESULT)


def patches(spark, *records):
    return rows_from_records(spark, records, PATCH)


def files(spark, *paths):
    return rows_from_records(spark, [{"path": p, "length": 1} for p in paths], MEDIA_FILE)


def ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "video_id string")


def by_id(rows):
    return {r["video_id"]: r for r in rows.collect()}


def utc(moment):
    """Collected timestamps come back naive, in the local zone."""
    return moment.astimezone(timezone.utc)
