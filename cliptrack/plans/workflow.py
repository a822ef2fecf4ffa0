"""The jobs run against a stored inventory: read, decide, commit."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from cliptrack.operators.selection import editable, first_rows
from cliptrack.operators.sweep import LEAVE, sweep
from cliptrack.plans import edit, ingest
from cliptrack.plans.publish import publication
from cliptrack.schema import FAILED, KEY, PENDING, POSTED
from cliptrack.sources.inventory import (
    AppendResult,
    Inventory,
    PatchResult,
    repeat_on_conflict,
)


class Workflow:
    """Ingest, edit and publish steps, each one or two commits."""

    def __init__(self, inventory: Inventory):
        self.inventory = inventory

    def _patch(self, patches: DataFrame) -> PatchResult:
        return repeat_on_conflict(lambda: self.inventory.patch(patches))

    def _mark(
        self, ids: DataFrame | Iterable[str], status: str, at: datetime | None
    ) -> PatchResult:
        items = ids if isinstance(ids, DataFrame) else list(ids)
        updates = {"status_fb": status}
        return repeat_on_conflict(lambda: self.inventory.set_values(items, updates, at))

    def to_download(self, listings: DataFrame, per_source: int = 1) -> DataFrame:
        """What the fetcher should download, written down for it."""
        self.inventory.create()
        known = self.inventory.read()
        wanted = ingest.to_download_from_listings(listings, known, per_source)
        return self.inventory.hand_over("requests", wanted)

    def ingest(
        self,
        requested: DataFrame,
        downloads: DataFrame,
        files: DataFrame,
        at: datetime | None = None,
    ) -> tuple[AppendResult, PatchResult]:
        """Record what was not downloaded and append what was.

        In this order: an item that failed at one source and came from another
        was not there yet when it failed.
        """
        self.inventory.create()
        result = ingest.ingest(requested, downloads, files, at)
        order = ingest.ROUND_ORDER
        failed = self._patch(result.failures)
        return repeat_on_conflict(lambda: self.inventory.append(result.rows, order)), failed

    def plan_edits(
        self, files: DataFrame, n: int | None = 1, exclude_processed: bool = False, **options
    ) -> DataFrame:
        """The edits to render, written down; rows without their file are failed.

        Reading, deciding and marking are one step, see `take_next`.
        """

        def step() -> DataFrame:
            now = self.inventory.version().number
            rows = editable(self.inventory.read(now, (PENDING,)), exclude_processed)
            with self.inventory.staged(first_rows(rows, n)) as chosen:
                plan = edit.plan_edits(chosen, files, None, **options)
                edits = self.inventory.hand_over("edits", plan.edits)
                self.inventory.patch(plan.failures, base=now)
            return edits

        return repeat_on_conflict(step)

    def record_edits(self, results: DataFrame, at: datetime | None = None) -> PatchResult:
        return self._patch(edit.folded_results(results, at))

    def take_next(
        self,
        files: DataFrame,
        at: datetime | None = None,
        statuses: Iterable[str] = (PENDING,),
    ) -> Row | None:
        """Id and path to publish, or None; missing files before it are failed.

        The decision and the marks belong to one version: if another writer commits
        in between, all of it is done anew on the newest version.
        """
        statuses = tuple(statuses)
        if self.inventory.latest() is None:
            return None

        def step() -> Row | None:
            now = self.inventory.version().number
            rows = self.inventory.read(now, statuses)
            queue = rows.select(KEY, "path_local", "status_fb", "created_at")
            swept = sweep(queue, files, statuses).filter(F.col("outcome") != LEAVE)
            with self.inventory.staged(swept) as touched:
                found = publication(touched, rows, at)
                chosen = found.chosen.first()
                self.inventory.patch(found.failures, base=now)
            return chosen

        return repeat_on_conflict(step)

    def mark_posted(
        self, ids: DataFrame | Iterable[str], at: datetime | None = None
    ) -> PatchResult:
        return self._mark(ids, POSTED, at)

    def mark_failed(
        self, ids: DataFrame | Iterable[str], at: datetime | None = None
    ) -> PatchResult:
        return self._mark(ids, FAILED, at)
