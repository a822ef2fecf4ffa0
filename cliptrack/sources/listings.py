"""Tables handed in from outside, read with a fixed schema."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any, NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampNTZType

from cliptrack.operators.append import check_schema
from cliptrack.schema import DOWNLOAD, EDIT_RESULT, INVENTORY, LISTING


def _strict(spark: SparkSession, schema: StructType, path: str) -> DataFrame:
    """JSON lines; a line that is cut off or holds a value of another type is an error."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


class Lines(NamedTuple):
    """Rows of the lines that fit, and the others: file, line, as it stands."""

    rows: DataFrame
    rejects: DataFrame


def read_lines(spark: SparkSession, schema: StructType, path: str) -> Lines:
    """JSON lines of which some may be broken: cut off, or with a value of another type.

    A line is either a row or a reject, never both; a blank one is neither. For input of
    which a part may be bad; `read_listings` and its like stop at the first bad line.
    """
    bad = "_bad_line"
    whole = StructType([*schema.fields, StructField(bad, StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad}
    lines = spark.read.text(path).select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("file")
    )
    read = lines.filter(F.trim("line") != "").withColumn("row", F.from_json("line", whole, options))
    rows = read.filter(F.col(f"row.{bad}").isNull()).select(*(f"row.{n}" for n in schema.names))
    return Lines(rows, read.filter(F.col(f"row.{bad}").isNotNull()).select("file", "line"))


def read_listings(spark: SparkSession, path: str) -> DataFrame:
    """Fetched listings as JSON lines, one listing per line."""
    return _strict(spark, LISTING, path)


def read_downloads(spark: SparkSession, path: str) -> DataFrame:
    return _strict(spark, DOWNLOAD, path)


def read_edit_results(spark: SparkSession, path: str) -> DataFrame:
    return _strict(spark, EDIT_RESULT, path)


def rows_from_records(
    spark: SparkSession, records: Iterable[Mapping[str, Any]], schema: StructType = INVENTORY
) -> DataFrame:
    """A few records as a typed table. Absent keys are null, unknown keys an error."""
    names = schema.fieldNames()
    rows = []
    for record in records:
        unknown = set(record) - set(names)
        if unknown:
            raise ValueError(f"unknown columns: {sorted(unknown)}")
        rows.append(tuple(record.get(n) for n in names))
    return spark.createDataFrame(rows, schema)


def as_inventory(rows: DataFrame) -> DataFrame:
    """Rows with the inventory's columns and types; times without zone are UTC."""
    naive = [f.name for f in rows.schema if isinstance(f.dataType, TimestampNTZType)]
    if naive and rows.sparkSession.conf.get("spark.sql.session.timeZone") != "UTC":
        raise ValueError("times without zone need spark.sql.session.timeZone=UTC")
    typed = rows.withColumns({c: F.col(c).cast("timestamp") for c in naive})
    check_schema(typed.schema, INVENTORY)
    return typed.select(*INVENTORY.names)


def read_inventory_file(spark: SparkSession, path: str) -> DataFrame:
    """An inventory that was kept as plain Parquet, to append to a stored one."""
    return as_inventory(spark.read.parquet(path))
