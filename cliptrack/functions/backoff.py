"""Retry schedule: exponential waits with a cap and a small spread."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from cliptrack.functions.values import hashed_uniform


@dataclass(frozen=True)
class Backoff:
    # Default schedule, 5, 15, 45 s and so on up to 90 s, +-10 %.
    retries: int = 3
    base: float = 5.0
    factor: float = 3.0
    max_wait: float = 90.0
    spread: float = 0.1

    def __post_init__(self):
        if self.retries < 1:
            raise ValueError("retries must be at least 1")

    def wait(self, attempt: Column) -> Column:
        """Seconds to wait after a failed attempt; null after the last one."""
        grown = F.lit(self.base) * F.pow(F.lit(self.factor), attempt - F.lit(1))
        return F.when(
            (attempt >= 1) & (attempt < self.retries), F.least(grown, F.lit(self.max_wait))
        )

    def spread_wait(self, attempt: Column, item: Column, seed: int) -> Column:
        """The wait moved by up to the spread, after the cap, never below 0."""
        wait = self.wait(attempt)
        draw = hashed_uniform(item, F.lit(str(seed)), attempt.cast("string"))
        shift = F.lit(-self.spread) + draw * F.lit(2 * self.spread)
        moved = wait + wait * shift
        return F.when(moved < 0, F.lit(0.0)).otherwise(moved)


def after_seconds(moment: Column, seconds: Column) -> Column:
    """Moment plus fractional seconds, at microsecond precision."""
    return F.timestamp_add("MICROSECOND", F.round(seconds * F.lit(1e6)).cast("bigint"), moment)
