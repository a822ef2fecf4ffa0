"""The inventory as snapshots on plain Parquet, one folder a version, written once.

    root/rows/batch=<name>      all rows of the inventory at some version
    root/changes/batch=<name>   the folded patches a version brought, matched or not
    root/versions/number=<n>    one line of JSON: which folders make up version n

A step reads one folder, joins what is new to it and writes the next one, so plans stay
the same however many steps there were. It holds for the version that it was decided on:
if another writer made the next version first, it gets ConcurrentCommit, and
`repeat_on_conflict` lets it decide anew. Spark refuses to write a version that is there;
should two write one at the same moment, the file that is older counts, for all readers.

A step rewrites the table, as it suits tables that are written now and then, by large
steps. Where many small ones are wanted, keep the rows in a table format and use the
operators on them. Folders that no version you need names can be deleted.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field, replace
from datetime import datetime
from typing import Any, NamedTuple, TypeVar

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from cliptrack.operators.append import fresh_rows
from cliptrack.operators.keys import flag_known, in_table
from cliptrack.operators.patches import apply_patches, fold_patches, patch_for
from cliptrack.schema import INVENTORY, KEY, PATCH
from cliptrack.session import scratch_root

T = TypeVar("T")

#: Patches with the version that brought them, by whether the item existed.
CHANGES = StructType(
    [*PATCH, StructField("version", LongType()), StructField("matched", BooleanType())]
)
_RECORD = "rows string, changes string, batches map<string, bigint>"
#: Lets a lookup by id skip row groups without it.
FIND_BY_ID = {
    f"parquet.bloom.filter.enabled#{KEY}": "true",
    "parquet.bloom.filter.adaptive.enabled": "true",
}


class ConcurrentCommit(RuntimeError):
    """Another writer committed first; read again and repeat."""


def repeat_on_conflict(step: Callable[[], T], attempts: int = 5) -> T:
    """Run a step anew, against the newest version, when another writer was first."""
    for _ in range(attempts - 1):
        try:
            return step()
        except ConcurrentCommit:
            continue
    return step()


class AppendResult(NamedTuple):
    inserted: int
    version: int


class PatchResult(NamedTuple):
    matched: int
    unmatched: int
    version: int


@dataclass(frozen=True)
class Version:
    number: int
    #: Folder of the rows; None while there are none.
    rows: str | None = None
    #: Folder of the patches that this very version brought.
    changes: str | None = None
    #: Last batch taken of each numbered writer.
    batches: dict[str, int] = field(default_factory=dict)

    def taken(self, writer: str | None, number: int | None) -> bool:
        return None not in (writer, number) and self.batches.get(writer, -1) >= number

    def after(self, writer: str | None, number: int | None, **changes) -> Version:
        marks = {} if None in (writer, number) else {writer: number}
        batches = {**self.batches, **marks}
        return replace(self, **{"number": self.number + 1, "changes": None, "batches": batches, **changes})


class Inventory:
    """Reads and writes the inventory below one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # -- versions ---------------------------------------------------------

    def _versions(self) -> DataFrame | None:
        """One row a version; None where there is no table yet."""
        try:
            lines = self.spark.read.schema(f"{_RECORD}, number bigint").json(f"{self.root}/versions")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        first = F.struct("_metadata.file_modification_time", "_metadata.file_name")
        record = F.min_by(F.struct("rows", "changes", "batches"), first).alias("record")
        return lines.groupBy("number").agg(record).select("number", "record.*")

    def _found(self, number: int | None = None) -> Version | None:
        versions = self._versions()
        if versions is None:
            return None
        some = versions if number is None else versions.filter(F.col("number") == number)
        row = some.orderBy(F.desc("number")).first()
        return row and Version(row.number, row.rows, row.changes, row.batches or {})

    def latest(self) -> int | None:
        """Number of the newest version; None where there is no table yet."""
        found = self._found()
        return found and found.number

    def version(self, number: int | None = None) -> Version:
        found = self._found(number)
        if found is None:
            raise FileNotFoundError(f"no version {number or ''} of an inventory at {self.root}")
        return found

    def _commit(self, step: Version) -> int:
        record = self.spark.createDataFrame([(step.rows, step.changes, step.batches)], _RECORD)
        try:
            record.coalesce(1).write.json(f"{self.root}/versions/number={step.number}")
        except AnalysisException as there:
            if there.getCondition() != "PATH_ALREADY_EXISTS":
                raise
            raise ConcurrentCommit(f"version {step.number} exists") from there
        if self._found(step.number) != step:
            raise ConcurrentCommit(f"version {step.number} is another writer's")
        return step.number

    def create(self) -> int:
        """Make version 0 with no rows; leaves an existing table alone."""
        number = self.latest()
        return self._commit(Version(0)) if number is None else number

    # -- reading ----------------------------------------------------------

    def _rows(self, version: Version) -> DataFrame:
        if version.rows is None:
            return self.spark.createDataFrame([], INVENTORY)
        return self.spark.read.schema(INVENTORY).parquet(f"{self.root}/rows/batch={version.rows}")

    def read(self, version: int | None = None, statuses: Iterable[str] | None = None) -> DataFrame:
        """The inventory at a version, optionally only rows in some states. Rows lie by
        state in their files, so that a reader skips most of the others."""
        rows = self._rows(self.version(version))
        return rows if statuses is None else rows.filter(F.col("status_fb").isin(*statuses))

    def transitions(self, unmatched: bool = False) -> DataFrame:
        """Every patch ever committed, with the version that brought it.

        The folders meet the versions that name them in a join, so that those of writers
        that lost are left out.
        """
        names = [c for c in CHANGES.names if c != "matched"]
        versions = self._versions()
        brought = None if versions is None else versions.select(F.col("changes").alias("batch")).dropna()
        if brought is None or brought.isEmpty():
            return self.spark.createDataFrame([], CHANGES).select(*names)
        fields = StructType([*CHANGES, StructField("batch", StringType())])
        written = self.spark.read.schema(fields).parquet(f"{self.root}/changes")
        wanted = written.filter(F.col("matched") != F.lit(unmatched))
        return in_table(wanted, brought, "batch").select(*names)

    # -- writing ----------------------------------------------------------

    def _write(self, kind: str, rows: DataFrame, **options: str) -> str:
        name = uuid.uuid4().hex
        rows.write.options(**options).parquet(f"{self.root}/{kind}/batch={name}")
        return name

    def _write_rows(self, rows: DataFrame) -> str:
        return self._write("rows", rows.sortWithinPartitions("status_fb", KEY), **FIND_BY_ID)

    def append(
        self, batch: DataFrame, order: Sequence[str], writer: str | None = None, number: int | None = None
    ) -> AppendResult:
        """Add the rows whose id is new; the first in `order` per id wins.

        A batch that adds nothing makes no new version, unless it is numbered.
        A numbered batch of a writer is taken once, however often it is sent.
        """
        self.create()
        now = self.version()
        if now.taken(writer, number):
            return AppendResult(0, now.number)
        rows, step = self._rows(now), now.after(writer, number)
        with self.staged(fresh_rows(rows, batch, order)) as fresh:
            inserted = fresh.count()  # from the files' footers
            if inserted:
                step = replace(step, rows=self._write_rows(rows.unionByName(fresh)))
        if step.rows == now.rows and step.batches == now.batches:
            return AppendResult(0, now.number)
        return AppendResult(inserted, self._commit(step))

    def patch(
        self,
        patches: DataFrame,
        order: Sequence[str] = ("at",),
        writer: str | None = None,
        number: int | None = None,
        base: int | None = None,
    ) -> PatchResult:
        """Apply patches. Those for unknown ids are kept apart and never apply.

        Patches that follow from what was read name that version as `base`: if it isn't
        the newest any more, nothing is written and ConcurrentCommit tells the caller to
        decide anew.
        """
        now = self.version()
        if base is not None and now.number != base:
            raise ConcurrentCommit(f"decided on version {base}, newest is {now.number}")
        if now.taken(writer, number):
            return PatchResult(0, 0, now.number)
        rows, step = self._rows(now), now.after(writer, number)
        typed = _typed(fold_patches(patches, order)).withColumn("version", F.lit(step.number).cast("long"))
        with self.staged(flag_known(typed, rows, KEY, "matched")) as folded:
            seen = folded.agg(F.count_if("matched"), F.count_if(~F.col("matched"))).first()
            hits, misses = seen
            if hits:
                step = replace(step, rows=self._write_rows(apply_patches(rows, folded.filter("matched"))))
            if hits or misses:
                step = replace(step, changes=self._write("changes", folded))
        if step.changes is None and step.batches == now.batches:
            return PatchResult(0, 0, now.number)
        return PatchResult(hits, misses, self._commit(step))

    def set_values(
        self, ids: DataFrame | Iterable[str], updates: Mapping[str, Any], at: datetime | None = None
    ) -> PatchResult:
        """Give every id the same values; ids are a table, or a few at hand."""
        if not isinstance(ids, DataFrame):
            ids = self.spark.createDataFrame([(i,) for i in ids], f"{KEY} string")
        return self.patch(patch_for(ids, self.spark.createDataFrame([], INVENTORY), updates, at))

    def hand_over(self, kind: str, rows: DataFrame) -> DataFrame:
        """Rows written down below the root, for an outside step to read."""
        return self._kept(f"{self.root}/{kind}", rows)

    @contextmanager
    def staged(self, rows: DataFrame) -> Iterator[DataFrame]:
        """Rows written down in scratch space for a while, so that nothing upstream runs twice."""
        yield self._kept(f"{scratch_root(self.spark)}/cliptrack/incoming", rows)

    def _kept(self, folder: str, rows: DataFrame) -> DataFrame:
        path = f"{folder}/{uuid.uuid4().hex}"
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)


def _typed(patches: DataFrame) -> DataFrame:
    """Patches in the types they are stored in."""
    given = set(patches.columns)
    return patches.select(*(F.col(f.name).cast(f.dataType) for f in PATCH if f.name in given))
