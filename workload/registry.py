"""Collects the queries, their SQL and the views both sides share."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from cliptrack.session import SETTINGS
from workload import views


class Tables:
    """The test tables of one folder, and the views of them the queries use."""

    def __init__(self, spark: SparkSession, folder: str):
        for name, value in SETTINGS.items():  # whoever has started the session
            spark.conf.set(name, value)
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        if name in views.SPARK_VIEWS:
            return views.SPARK_VIEWS[name](self)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


class Query(NamedTuple):
    run: Callable[[Tables], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(sql: str | None, *needs: str, name: str | None = None):
    """Register a query, under its function name, with its SQL over some views."""

    def add(run: Callable[[Tables], DataFrame]):
        text = sql
        if sql is not None and needs:
            text = "with " + ",\n".join(views.SQL_VIEWS[n] for n in needs) + "\n" + sql
        QUERIES[name or run.__name__] = Query(run, text)
        return run

    return add
