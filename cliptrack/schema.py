"""Tables and fixed values shared by every job."""

from pyspark.sql import types as T

# Item states. The column itself is a free string.
PENDING = "pending"
READY = "ready"
FAILED = "failed"
POSTED = "posted"
STATUSES = (PENDING, READY, FAILED, POSTED)

# The folders media files live in, relative to the project root.
RAW_DIR = "videos/raw"
PROCESSED_DIR = "videos/processed"
PROCESSED_MARK = "processed"

KEY = "video_id"
TOUCHED = "updated_at"

INVENTORY = T.StructType(
    [
        T.StructField("video_id", T.StringType(), False),
        T.StructField("source_url", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("duration", T.LongType()),
        T.StructField("path_local", T.StringType()),
        T.StructField("status_fb", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)

#: Columns a patch may set. The key is fixed and the touch time is set for you.
UPDATABLE = tuple(f.name for f in INVENTORY if f.name not in (KEY, TOUCHED))

_ENTRY = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("webpage_url", T.StringType()),
    ]
)

#: One fetched listing: either it has entries, or it is a single item itself.
LISTING = T.StructType(
    [T.StructField("source_url", T.StringType())]
    + _ENTRY.fields
    + [T.StructField("entries", T.ArrayType(_ENTRY))]
)

#: What the outside fetcher reports for one requested entry. `error` is set when
#: the download failed; `title_known` tells a null title from an absent one.
DOWNLOAD = T.StructType(
    [
        T.StructField("source_url", T.StringType()),
        T.StructField("entry_id", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("webpage_url", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("title_known", T.BooleanType()),
        T.StructField("duration", T.DoubleType()),
        T.StructField("error", T.StringType()),
    ]
)

MEDIA_FILE = T.StructType(
    [
        T.StructField("path", T.StringType(), False),
        T.StructField("length", T.LongType()),
        T.StructField("modified", T.TimestampType()),
    ]
)

#: What the outside renderer reports for one planned edit.
EDIT_RESULT = T.StructType(
    [
        T.StructField("video_id", T.StringType(), False),
        T.StructField("path_local", T.StringType()),
        T.StructField("ok", T.BooleanType()),
    ]
)

#: One change request: nullable values, and the names of those really set, so
#: that "set to null" and "leave alone" stay different.
PATCH = T.StructType(
    [T.StructField("video_id", T.StringType(), False)]
    + [INVENTORY[c] for c in UPDATABLE]
    + [
        T.StructField("set_cols", T.ArrayType(T.StringType())),
        T.StructField("at", T.TimestampType()),
    ]
)
