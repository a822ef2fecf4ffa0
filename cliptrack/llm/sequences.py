"""Rows of a group in order: their numbers, and one hash over all their texts.

A group may hold a third of all rows, so neither is a window over a group. Rows are
sorted by range, which cuts a long group over tasks, and numbered by the rows of the
group in earlier ranges. A hash over a group is one chain by its nature: its texts are
joined into pieces in parallel, and one task reads the pieces of a group in order with
nothing in memory but the hash's state.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cliptrack.llm.shared import written

#: Characters of joined texts in one piece, and texts in one.
PIECE = 1 << 14
MANY = 512


def laid_out(rows: DataFrame, group: str, order: Sequence[Column]) -> DataFrame:
    """The rows as a table sorted by range, with `_at`: each row's own number in that order."""
    # Equal rows have to spread over ranges too.
    spread = rows.withColumn("_at", F.monotonically_increasing_id())
    keys = [F.col(group).asc(), *order, F.col("_at").asc()]
    return written(
        spread.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_at", F.monotonically_increasing_id())
    )


def numbered(laid: DataFrame, group: str) -> DataFrame:
    """Rows that were laid out, with `pos`, from 0 within their group, and its size `len`.

    Ties in the order are numbered in some way. The group must not be null. The columns
    pos, len, n, _first, _before and _range must not be there yet. What the caller drops
    from the rows before does not move.
    """
    laid = laid.withColumn("_range", F.shiftright("_at", 33))
    runs = laid.groupBy(group, "_range").agg(F.min("_at").alias("_first"), F.count("*").alias("n"))
    # One row a range that the group reaches into.
    whole = Window.partitionBy(group)
    earlier = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        group,
        "_range",
        "_first",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before"),
        F.sum("n").over(whole).alias("len"),
    )
    return (
        laid.join(runs, [group, "_range"])
        .withColumn("pos", F.col("_at") - F.col("_first") + F.col("_before"))
        .drop("_range", "_first", "_before")
    )


def chained(rows: DataFrame, group: Sequence[str], order: str, text: str, joint: str) -> DataFrame:
    """(group columns, sha256): of a group's texts in order, with the joint between them.

    The order must be a number that no two rows of a group share; texts must not be null.
    """
    kept = rows.select(*group, F.col(order).alias("_order"), F.col(text).alias("_text"))
    names = [*group, "_order", "_text"]
    keys = [*group, "_order"]
    fields = [kept.schema[c] for c in names]
    schema = type(kept.schema)(fields)
    pieces = (
        kept.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .mapInArrow(lambda batches: _pieces(batches, len(group), joint), schema)
    )
    ends = type(kept.schema)([*fields[:-2], fields[-1]])
    return (
        pieces.repartition(*group)
        .sortWithinPartitions(*keys)
        .mapInArrow(lambda batches: _hashes(batches, len(group), joint), ends)
        .withColumnRenamed("_text", "sha256")
    )


def _rows(batch: pa.RecordBatch, many: int) -> Iterator[tuple]:
    columns = [c.to_pylist() for c in batch.columns]
    return zip(zip(*columns[:many], strict=True), *columns[many:], strict=True)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=schema.names)


def _pieces(batches: Iterator[pa.RecordBatch], many: int, joint: str) -> Iterator[pa.RecordBatch]:
    """Neighbours of one group joined, as long as they are short."""
    key, first, held, size, schema = None, None, [], 0, None
    for batch in batches:
        schema, out = batch.schema, []
        for own, order, text in _rows(batch, many):
            if held and (own != key or size + len(text) > PIECE or len(held) == MANY):
                out.append((*key, first, joint.join(held)))
                held, size = [], 0
            if not held:
                key, first = own, order
            held.append(text)
            size += len(text)
        yield _batch(out, schema)
    if held:
        yield _batch([(*key, first, joint.join(held))], schema)


def _hashes(batches: Iterator[pa.RecordBatch], many: int, joint: str) -> Iterator[pa.RecordBatch]:
    key, state, schema = None, None, None
    for batch in batches:
        out = []
        schema = pa.schema([*list(batch.schema)[:many], batch.schema.field(many + 1)])
        for own, _, text in _rows(batch, many):
            if own != key:
                if state is not None:
                    out.append((*key, state.hexdigest()))
                key, state = own, hashlib.sha256(text.encode("utf-8", "surrogatepass"))
            else:
                state.update((joint + text).encode("utf-8", "surrogatepass"))
        yield _batch(out, schema)
    if state is not None:
        yield _batch([(*key, state.hexdigest())], schema)
