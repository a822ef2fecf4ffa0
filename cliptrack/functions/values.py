"""Scalar rules on column values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def filled(*columns: Column) -> Column:
    """First argument that is neither null nor empty, else null."""
    return F.coalesce(*(F.nullif(c, F.lit("")) for c in columns))


def is_filled(column: Column) -> Column:
    """True for a non-empty string, false for null and empty."""
    return F.coalesce(column != "", F.lit(False))


def whole_seconds(column: Column) -> Column:
    """Duration cut towards zero to a whole number; missing counts as 0."""
    return F.coalesce(column.cast("bigint"), F.lit(0).cast("bigint"))


def hashed_uniform(*parts: Column) -> Column:
    """Reproducible number in [0, 1) from the md5 of the parts.

    Unlike rand() it does not change when a task is run again.
    """
    return hashed_word(*parts) / F.lit(4294967296.0)


def hashed_word(*parts: Column) -> Column:
    """First 32 bits of the md5 of the parts, joined with ':', as a bigint."""
    return F.conv(F.substring(hashed(*parts), 1, 8), 16, 10).cast("bigint")


def hashed(*parts: Column) -> Column:
    return F.md5(F.concat_ws(":", *parts))


