"""Append with keep-first deduplication: what is there stays, first come wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cliptrack.operators.keys import flag_known, not_in_table
from cliptrack.schema import KEY


class SchemaMismatch(ValueError):
    """The rows to append do not have the table's columns and types."""


def check_schema(rows: StructType, table: StructType) -> None:
    """Names and types must agree; nothing is inferred, widened or cast."""
    given = {f.name: f.dataType for f in rows}
    wrong = [
        f"{f.name}: {given[f.name].simpleString() if f.name in given else 'missing'}"
        f" instead of {f.dataType.simpleString()}"
        for f in table
        if given.get(f.name) != f.dataType
    ]
    if wrong:
        raise SchemaMismatch("; ".join(wrong))


def stack(first: DataFrame, second: DataFrame) -> DataFrame:
    """Vertical concat of two tables with the same columns and types."""
    check_schema(second.schema, first.schema)
    extra = set(second.columns) - set(first.columns)
    if extra:
        raise SchemaMismatch(f"unexpected columns: {sorted(extra)}")
    return first.unionByName(second)


def keep_first(rows: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per key, the one first in `order`; equal rows are one.

    An aggregate, not a ranking: a key that fills a third of the table is cut
    to one row per task before the shuffle. A null key is a key of its own.
    """
    rest = [c for c in rows.columns if c != key and c not in order]
    first = F.min(F.struct(*order, *rest)).alias("first")
    return rows.groupBy(key).agg(first).select(key, "first.*").select(*rows.columns)


def fresh_rows(existing: DataFrame, batch: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows of the batch that an append would add, in the table's columns.

    Existing rows always win, so the full table is never shuffled: only its
    keys meet the keys of the batch. Rows without a key are not appended, see
    `keyless_rows`.
    """
    check_schema(batch.schema, existing.schema)
    first = keep_first(batch.filter(F.col(KEY).isNotNull()), KEY, order)
    return not_in_table(first, existing, KEY).select(*existing.columns)


def keyless_rows(batch: DataFrame) -> DataFrame:
    return batch.filter(F.col(KEY).isNull())


def append(existing: DataFrame, batch: DataFrame, order: Sequence[str]) -> DataFrame:
    """The table after the append."""
    return stack(existing, fresh_rows(existing, batch, order))


def append_metrics(existing: DataFrame, batch: DataFrame) -> DataFrame:
    """One row: rows offered, inserted, skipped as duplicates, refused for no key."""
    offered = batch.groupBy(KEY).agg(F.count("*").alias("n"))
    is_new = ~F.col("known") & F.col(KEY).isNotNull()
    return (
        flag_known(offered, existing, KEY, "known")
        .agg(
            F.sum("n").alias("offered"),
            F.count_if(is_new).alias("inserted"),
            F.sum(F.when(F.col(KEY).isNull(), F.col("n"))).alias("refused"),
        )
        .select(
            F.coalesce("offered", F.lit(0)).alias("offered"),
            "inserted",
            F.coalesce("refused", F.lit(0)).alias("refused"),
        )
        .withColumn("duplicate", F.col("offered") - F.col("inserted") - F.col("refused"))
    )
