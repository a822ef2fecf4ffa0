"""Near-equal embeddings through lattice hashing, verified by cosine.

Unit vectors are projected at random to eight dimensions, in several tables, and each
projection is decoded to the nearest point of the lattice E8, which names a cell. A
vector enters its own cell and the neighbouring one that its projection comes nearest
to; vectors that meet in a cell are compared. Equal vectors are one class from the
start. A pair that meets in several cells counts in the first of them only, and what
leaves a cell is a sum for each vector and a star for each linked group, never its
pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cliptrack.llm.rotated_codes import units, usable
from cliptrack.llm.shared import components, mix, written

COSINE = 0.95
#: At cosine 0.95 a pair meets in none of 12 tables in less than one of 1000 cases.
TABLES = 12
#: Lengths of unit vectors in units of the lattice; larger: smaller cells.
SCALE = 1.8
#: Vectors of a cell that one task compares with as many others.
BLOCK = 1024


def nearest_even(points: np.ndarray) -> np.ndarray:
    """The nearest points of D8: whole numbers whose sum is even."""
    whole = np.rint(points)
    odd = whole.sum(1).astype(np.int64) & 1 == 1
    off = points - whole
    worst, rows = np.abs(off).argmax(1), np.arange(len(points))
    other = whole.copy()
    other[rows, worst] += np.where(off[rows, worst] >= 0, 1, -1)
    return np.where(odd[:, None], other, whole)


def decoded(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest point of E8 to each, and the nearest one of the other half of E8.

    E8 is D8 and D8 moved by a half in every direction.
    """
    even, half = nearest_even(points), nearest_even(points - 0.5) + 0.5
    first = ((points - even) ** 2).sum(1) <= ((points - half) ** 2).sum(1)
    return np.where(first[:, None], even, half), np.where(first[:, None], half, even)


@lru_cache(256)
def projection(dim: int, table: int) -> tuple[np.ndarray, np.ndarray]:
    """Eight random directions, of equal length and at right angles if there is room."""
    rng = np.random.default_rng([11, dim, table])
    wide = rng.normal(size=(dim, 8))
    if dim >= 8:
        wide = np.linalg.qr(wide)[0] * math.sqrt(dim / 8)
    return wide * SCALE, rng.uniform(0, 1, 8)


def cells(vectors: np.ndarray) -> np.ndarray:
    """For each vector the numbers of the cells it enters, two a table."""
    dim = vectors.shape[1]
    unit = units(vectors)
    out = []
    for table in range(TABLES):
        directions, shift = projection(dim, table)
        for point in decoded(unit @ directions + shift):
            h = np.full(len(unit), np.uint64(dim * 1000 + table), np.uint64)
            for x in (point * 2).astype(np.int64).view(np.uint64).T:
                h = mix(h ^ x) + np.uint64(0x9E3779B97F4A7C15)
            out.append(mix(h).view(np.int64))
    return np.stack(out, axis=1)


def _entries(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for _, part in frame.groupby(frame["embedding"].map(len)):
            entered = cells(np.stack(part["embedding"]).astype(float))
            yield pd.DataFrame({"cid": part["cid"].to_numpy(), "cells": list(entered)})


def _group(cell: int, first: pd.DataFrame, second: pd.DataFrame | None, least: float):
    """Links of one cell's block with itself, or of two blocks with one another."""
    rows = first if second is None else pd.concat([first, second])
    unit = units(np.stack(rows["embedding"]).astype(float))
    ids, weight = rows["cid"].to_numpy(), rows["weight"].to_numpy()
    near = unit @ unit.T >= least
    np.fill_diagonal(near, False)
    if second is not None:
        near[: len(first), : len(first)] = near[len(first) :, len(first) :] = False
    linked = np.flatnonzero(near.any(1))
    if not len(linked):
        return None
    near = near[np.ix_(linked, linked)]
    ids, weight = ids[linked], weight[linked]
    # A pair counts in the smallest of the cells that both entered.
    a, b = np.nonzero(np.triu(near))
    own = rows["cells"].to_numpy()[linked]
    wide = max(map(len, own))
    held = np.full((len(own), wide), np.iinfo(np.int64).max)
    for i, x in enumerate(own):
        held[i, : len(x)] = np.sort(x)
    counts = np.zeros(len(ids), np.int64)
    for at in range(0, len(a), 1 << 16):
        x, y = a[at : at + (1 << 16)], b[at : at + (1 << 16)]
        earlier = np.zeros(len(x), bool)
        for k in range(wide):
            low = held[x, k]
            could = low < cell
            if not could.any():
                break
            w = np.flatnonzero(could & ~earlier)
            earlier[w] = (held[y[w]] == low[w, None]).any(1)
        x, y = x[~earlier], y[~earlier]
        counts += np.bincount(x, weight[y], len(ids)).astype(np.int64)
        counts += np.bincount(y, weight[x], len(ids)).astype(np.int64)
    # The smallest class that each can reach inside the group.
    top = ids.copy()
    while True:
        new = np.minimum(top, np.where(near, top[None, :], np.iinfo(np.int64).max).min(1))
        if (new == top).all():
            break
        top = new
    return pd.DataFrame({"cid": ids, "top": top, "links": counts})


def _links(least: float):
    """Rows come sorted by cell and block pair; a group may span the frames."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        key = ["cell", "i", "j"]

        def results(frame):
            out = []
            for (cell, i, j), group in frame.groupby(key, sort=False):
                if i == j:
                    got = _group(cell, group, None, least)
                else:
                    got = _group(cell, group[group["block"] == i], group[group["block"] == j], least)
                if got is not None:
                    out.append(got)
            return pd.concat(out) if out else pd.DataFrame({"cid": [], "top": [], "links": []})

        for frame in frames:
            frame = frame if rest is None else pd.concat([rest, frame])
            if not len(frame):
                continue
            last = (frame[key] == frame[key].iloc[-1]).all(axis=1).to_numpy()
            rest = frame[last]
            yield results(frame[~last])
        if rest is not None:
            yield results(rest)

    return run


def near_vectors(embeddings: DataFrame, least: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of embeddings.

    Vectors that are null, zero or hold null or non-finite components link with
    nothing, and so do vectors of different lengths. Rows that repeat a vector link
    with one another. Null ids are never the smallest of a component.
    """
    whole = F.when(usable("embedding"), F.col("embedding"))
    rows = embeddings.select("vec_id", whole.alias("embedding")).withColumn(
        "cid", F.when(F.col("embedding").isNotNull(), F.xxhash64("embedding"))
    )
    # Equal vectors fold in every task before they move. Zeros of either sign differ
    # here, and are linked like any near pair.
    classes = written(
        rows.where("cid is not null")
        .groupBy("cid")
        .agg(F.count("*").alias("weight"), F.first("embedding").alias("embedding"))
    )
    entered = written(classes.mapInPandas(_entries, "cid long, cells array<long>"))
    entries = entered.select("cid", F.explode("cells").alias("cell"))
    # A cell of one vector pairs nothing; of cells with the same members one will do.
    shared = (
        entries.groupBy("cell")
        .agg(
            F.count("*").alias("n"),
            F.sum(F.xxhash64("cid").bitwiseAND(F.lit((1 << 40) - 1))).alias("one"),
            F.bit_xor(F.xxhash64(F.lit(1), "cid")).alias("two"),
        )
        .where("n > 1")
        .groupBy("n", "one", "two")
        .agg(F.min("cell").alias("cell"))
        .select("cell", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    )
    kept = written(entries.join(shared, "cell"))
    own = kept.groupBy("cid").agg(F.collect_list("cell").alias("cells"))  # two a table at most
    full = own.join(classes, "cid")
    spread = (
        kept.join(full, "cid")
        .withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "cell", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
            "block", "cid", "weight", "embedding", "cells",
        )
    )
    found = written(
        spread.repartition("cell", "i", "j")
        .sortWithinPartitions("cell", "i", "j")
        .mapInPandas(_links(least), "cid long, top long, links long")
    )
    joined = components(found.select(F.col("cid").alias("a"), F.col("top").alias("b")))
    counted = found.groupBy("cid").agg(F.sum("links").alias("links"))
    placed = (
        rows.select("vec_id", "cid")
        .join(classes.select("cid", "weight"), "cid", "left")
        .join(counted, "cid", "left")
        .join(joined, F.col("cid") == F.col("id"), "left")
        .select(
            "vec_id",
            F.coalesce(F.col("weight") - 1 + F.coalesce("links", F.lit(0)), F.lit(0)).alias("n_links"),
            F.coalesce("component", "cid").alias("part"),
        )
    )
    least_ids = placed.where("part is not null").groupBy("part").agg(F.min("vec_id").alias("least"))
    return placed.join(least_ids, "part", "left").select(
        "vec_id",
        F.col("n_links").cast("long").alias("n_links"),
        F.when(F.col("part").isNotNull(), F.col("least")).otherwise(F.col("vec_id")).cast("long").alias("component_id"),
    ).withColumn("kept", F.expr("vec_id <=> component_id"))


def op10_lattice(spark, sf_dir: str) -> DataFrame:
    """Near-equal embeddings: links, components and the row that stays of each."""
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
