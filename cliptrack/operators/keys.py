"""Membership by key, as plain semi, anti and left joins.

Spark picks the join: it broadcasts a side that its statistics show to be small,
cuts the other by a filter at run time, and splits a hot key of the rows. A null key
is never in a table; a repeated key of the table counts once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def in_table(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs in `table`."""
    return rows.join(table.select(key), key, "left_semi")


def not_in_table(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Rows whose key does not occur in `table`, also those without a key."""
    return rows.join(table.select(key), key, "left_anti")


def flag_known(rows: DataFrame, table: DataFrame, key: str, flag: str) -> DataFrame:
    """All rows, each once, with a boolean telling whether the key is in `table`."""
    # Grouped by a hash as well, so that the join shuffles the keys itself: Spark
    # splits a hot key only between shuffles that a join has asked for.
    known = table.filter(F.col(key).isNotNull()).groupBy(key, F.xxhash64(key)).agg(
        F.lit(True).alias(flag)
    )
    flagged = rows.join(known.select(key, flag), key, "left")
    return flagged.withColumn(flag, F.coalesce(flag, F.lit(False))).select(*rows.columns, flag)
