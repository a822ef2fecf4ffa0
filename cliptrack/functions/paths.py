"""Path rules: project-relative names, stems, suffixes and output names."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from cliptrack.functions.values import hashed
from cliptrack.schema import PROCESSED_DIR

# Endings of partial downloads, which are not media files yet.
PARTIAL_SUFFIXES = (".part", ".ytdl")


def below(base: str, path: Column) -> Column:
    """Path relative to `base`; an error for a path that doesn't lie below it.

    Listings write the same file as `/x`, `file:/x` or `file:///x`, and these are
    equal here on either side. A base without a scheme stands for itself in any file
    system; any other scheme and authority must be the base's.
    """
    local = r"^file:/+"
    root = re.sub(local, "/", base).rstrip("/")
    bare = F.regexp_replace(path, local, "/")
    if not re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", base):
        bare = F.regexp_replace(bare, r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    outside = F.raise_error(F.concat(F.lit(f"not below {base}: "), path))
    return F.when(
        F.startswith(bare, F.lit(root + "/")), F.substr(bare, F.lit(len(root) + 2))
    ).when(path.isNotNull(), outside)


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def file_suffix(path: Column) -> Column:
    """Last ending with its dot; empty for none, and for names like `.hidden`."""
    return F.regexp_extract(file_name(path), r"^.+(\.[^.]+)$", 1)


def file_stem(path: Column) -> Column:
    name = file_name(path)
    return F.substr(name, F.lit(1), F.length(name) - F.length(file_suffix(path)))


def is_partial(path: Column) -> Column:
    return F.lower(file_suffix(path)).isin(*PARTIAL_SUFFIXES)


def output_path(path: Column, video_id: Column, at: Column, run: str) -> Column:
    """Where the edited file goes: stem, UTC second and 8 hex digits.

    The digits come from item and run, so a task that runs again names the
    same file.
    """
    return F.concat(
        F.lit(PROCESSED_DIR + "/"),
        file_stem(path),
        F.lit("_"),
        F.date_format(at, "yyyyMMddHHmmss"),
        F.lit("_"),
        F.substring(hashed(video_id, F.lit(run)), 1, 8),
        file_suffix(path),
    )
