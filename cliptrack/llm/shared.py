"""What several operators need: the shared folder, chunks of rows, hashed words."""

from __future__ import annotations

import atexit
import ctypes
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that are hashed at a time inside a task.
CHUNK = 1 << 20
#: Spark removes the shuffle files of a query at its end.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows that Spark hands to a Python worker at a time, at most.
BATCH = 1000
#: glibc gives back what it keeps of freed memory; other C libraries have no such call.
_trim = getattr(ctypes.CDLL(None), "malloc_trim", lambda _: 0)


def visible(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, and take rows
    in batches of BATCH at most, since a row here is a whole text.

    For a session that was started elsewhere. On a cluster without the same folder on
    each machine, send the package with --py-files.
    """
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(batch)) <= BATCH:
        spark.conf.set(batch, str(BATCH))
    root, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])


def tidy() -> None:
    """Give memory back at the end of a task: the worker lives on and may wait idle beside
    others."""
    pa.default_memory_pool().release_unused()
    _trim(0)


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; one of our own where a local session has none."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        named = tempfile.mkdtemp(prefix="shared-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def written(df: DataFrame) -> DataFrame:
    """The rows as a table in the shared folder, which cuts the lineage.

    Any executor can read it again, so that a lost one costs only its own tasks. What
    was shuffled for it has no other use and goes once it is written.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEAN, "false")
    spark.conf.set(_CLEAN, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEAN, before)
    return spark.read.schema(df.schema).parquet(path)


def crc(column: str, divisor: int):
    """crc32 of the column's value as text, modulo the divisor; null for null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % divisor


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in links (a, b); component is the smallest id.

    Alternating stars: each round hangs all larger neighbours of an id, then all
    smaller ones, below the smallest of them, until nothing moves. The smallest
    neighbour is an aggregate that folds in every task, so that an id with very
    many links arrives as one row a task; the join back can be split.
    """

    def hung(both: DataFrame, large: bool) -> DataFrame:
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        pairs = both.join(least, "a")
        if large:
            moved = pairs.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            moved = pairs.select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(
                least.select("a", F.col("m").alias("b"))
            )
        return moved.where("a <> b").distinct()

    down = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    edges = written(links.where("a <> b").select(*down).distinct())
    seen = None
    while True:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = hung(both, True).select(*down).distinct()
        edges = written(hung(large, False))
        now = edges.agg(
            F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.max(F.xxhash64("b", "a"))
        ).first()
        if now == seen:
            break
        seen = now
    hubs = edges.select(F.col("b").alias("id")).distinct()
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionAll(
        hubs.select("id", F.col("id").alias("component"))
    )


# Words of whole texts as 64-bit hashes. A word is a run of bytes other than
# space, tab, newline, vertical tab, form feed and return; A-Z are lowered.

_FOLD = bytes(
    32 if b in (9, 10, 11, 12, 13) else b + 32 if 65 <= b <= 90 else b for b in range(256)
)
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over all bits (splitmix64's last step)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(n, CHUNK + 4096)
        table = np.full(size, base, np.uint64)
        table[0] = 1
        have = _POWERS[base] = np.cumprod(table, dtype=np.uint64)
    return have


def folded(text: str | None) -> bytes:
    """The text's bytes with A-Z lowered and every white space a space; null: none."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD)


def _pieces(texts: Iterable[str | None]) -> Iterator[tuple[int, bytes]]:
    """(row, bytes); a long text in several pieces, cut at white space."""
    for row, text in enumerate(texts):
        raw = folded(text)
        at = 0
        while len(raw) - at > CHUNK and (cut := raw.find(b" ", at + CHUNK)) >= 0:
            yield row, raw[at:cut]
            at = cut
        yield row, raw[at:] if at else raw


def _hashed(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    joined = np.frombuffer(b" ".join([b"", *raws, b""]), np.uint8)
    blank = joined == 32
    first = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
    last = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
    sums = np.zeros(len(joined) + 1, np.uint64)
    np.cumsum(_BYTES[joined] * _powers(_BASE, len(joined))[: len(joined)], out=sums[1:])
    words = mix((sums[last] - sums[first]) * _powers(_BACK, len(joined))[first])
    starts = np.cumsum([1] + [len(r) + 1 for r in raws])
    return words, np.searchsorted(first, starts[:-1])


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and where each row's begin (one more at the end)."""
    found, count = [], np.zeros(len(texts) + 1, np.int64)
    rows, raws, size = [], [], 0

    def flush():
        words, begin = _hashed(raws)
        np.add.at(count, np.array(rows) + 1, np.diff(np.append(begin, len(words))))
        found.append(words)
        rows.clear()
        raws.clear()

    for row, raw in _pieces(texts):
        if raws and size + len(raw) > CHUNK:
            flush()
            size = 0
        rows.append(row)
        raws.append(raw)
        size += len(raw)
    if raws:
        flush()
    words = np.concatenate(found) if found else np.zeros(0, np.uint64)
    return words, np.cumsum(count)
