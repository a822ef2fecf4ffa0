"""Nearest neighbours through randomly rotated one-bit codes and their error bounds."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cliptrack.llm.shared import written

#: Rows of a data block and of a query block, on average. Larger blocks are copied
#: less often; a task holds one of each.
BLOCK = 8192
QUERIES = 4096
_AT_ONCE = 256  # queries that are compared with a block at a time
#: Width of the error bound; at 1.9 an estimate lies outside in a few of 100 cases.
WIDTH = 1.9
_PLANES = 4


def usable(embedding: str) -> Column:
    """Whether the vector is there, all its components are finite, and one isn't 0."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists(embedding, lambda x: x != 0)
    return F.coalesce(~bad & some, F.lit(False))


@lru_cache(8)
def rotation(dim: int) -> np.ndarray:
    """A random rotation of so many dimensions, always the same."""
    q, r = np.linalg.qr(np.random.default_rng([7, dim]).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def units(vectors: np.ndarray) -> np.ndarray:
    """Vectors over their lengths, through their largest part, so that none overflows."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _packed(bits: np.ndarray) -> np.ndarray:
    pad = -bits.shape[1] % 64
    return np.packbits(np.pad(bits, ((0, 0), (0, pad))), axis=1).view(np.uint64)


def codes(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed signs of the rotated unit vectors, and how well each code points along its own."""
    turned = units(vectors) @ rotation(vectors.shape[1])
    return _packed((turned > 0).astype(np.uint8)), np.abs(turned).sum(1) / math.sqrt(turned.shape[1])


def estimates(queries: np.ndarray, packed: np.ndarray, along: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated cosines (query, row) and half the width of their bounds.

    A query is rounded to 16 steps, whose four bit planes meet the codes by counts of
    common bits. The bound holds what the code loses and what the rounding does.
    """
    dim = queries.shape[1]
    turned = units(queries) @ rotation(dim)
    low = turned.min(1, keepdims=True)
    step = np.maximum((turned.max(1, keepdims=True) - low) / (2**_PLANES - 1), 1e-12)
    whole = np.rint((turned - low) / step).astype(np.uint8)
    common = np.zeros((len(queries), len(packed)))
    for plane in range(_PLANES):
        bits = _packed((whole >> plane) & 1)
        for word in range(packed.shape[1]):
            common += np.bitwise_count(bits[:, word, None] & packed[None, :, word]) * float(1 << plane)
    ones = np.bitwise_count(packed).sum(1)[None, :]
    met = (2 * step * common + 2 * low * ones - step * whole.sum(1, keepdims=True)) / math.sqrt(dim)
    met -= math.sqrt(dim) * low
    lost = np.sqrt(np.maximum(1 - along**2, 0)) / along * WIDTH / math.sqrt(max(dim - 1, 1))
    return met / along, lost + WIDTH * step / (math.sqrt(12) * along)


def _nearest(k: int):
    def run(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, float]] = []
        if len(rows) and len(asked):
            data, queries = np.stack(rows["embedding"]), np.stack(asked["embedding"])
            data, queries = data.astype(float), queries.astype(float)
            ids, query_ids = rows["vec_id"].to_numpy(), asked["vec_id"].to_numpy()
            packed = np.frombuffer(b"".join(rows["code"]), np.uint64).reshape(len(rows), -1)
            along, whole, last = rows["along"].to_numpy(), units(data), min(k, len(ids)) - 1
            for start in range(0, len(queries), _AT_ONCE):
                part = slice(start, start + _AT_ONCE)
                guess, bound = estimates(queries[part], packed, along)
                own = query_ids[part, None] == ids[None, :]
                low = np.where(own, -np.inf, guess - bound)
                # The k-th best lower bound; what can't reach it isn't among the k nearest.
                floor = -np.partition(-low, last, axis=1)[:, last]
                again = (guess + bound >= floor[:, None]) & ~own
                unit = units(queries[part])
                for q, query_id in enumerate(query_ids[part]):
                    at = np.flatnonzero(again[q])
                    # Row by row, so that equal vectors have equal scores anywhere.
                    score = (whole[at] * unit[q]).sum(axis=1)
                    best = np.lexsort((ids[at], -score))[:k]
                    out += zip([query_id] * len(best), ids[at[best]], score[best], strict=True)
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    return run


def nearest(embeddings: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of largest cosine to each query.

    Every query block meets every data block. In a block the codes' bounds leave the
    rows that can be among the k nearest there, and their cosines are taken from the
    vectors. Rows without id, and vectors that are null, zero or not finite take no
    part; vectors meet others of their own length only. A row isn't its own neighbour;
    rows that share an id count once as a query.
    """

    def indexed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for _, part in frame.groupby(frame["embedding"].map(len)):
                packed, along = codes(np.stack(part["embedding"]).astype(float))
                yield part.assign(code=[row.tobytes() for row in packed], along=along)

    rows = embeddings.where(F.col("vec_id").isNotNull() & usable("embedding")).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")
    )
    index = written(
        rows.mapInPandas(indexed, "vec_id long, embedding array<double>, code binary, along double")
    )
    asked = written(
        queries.where(F.col("vec_id").isNotNull() & usable("embedding"))
        .select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
        .dropDuplicates(["vec_id"])
    )
    data_blocks = max(1, math.ceil(index.count() / BLOCK))
    query_blocks = max(1, math.ceil(asked.count() / QUERIES))
    spread = lambda n, seed: F.pmod(F.xxhash64(F.lit(seed), "vec_id"), F.lit(n)).cast("int")
    dim = F.size("embedding").alias("dim")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = index.select("*", dim, spread(data_blocks, 1).alias("d"), every(query_blocks).alias("q"))
    right = asked.select("*", dim, spread(query_blocks, 2).alias("q"), every(data_blocks).alias("d"))
    found = (
        left.groupBy("dim", "d", "q")
        .cogroup(right.groupBy("dim", "d", "q"))
        .applyInPandas(_nearest(k), "query_id long, vec_id long, score double")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op7_nearest(spark, sf_dir: str) -> DataFrame:
    """The 5 nearest vectors to every fiftieth one, by cosine."""
    embeddings = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest(embeddings, embeddings.where("vec_id % 50 = 0"))
