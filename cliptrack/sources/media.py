"""Which media files exist: listed from storage, streamed as they appear, or read from a
manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from cliptrack.functions import below
from cliptrack.schema import MEDIA_FILE


def list_media(spark: SparkSession, base: str, *folders: str) -> DataFrame:
    """Files below the folders, by path relative to `base`. Contents are not read.
    Spark's reader passes over files of no bytes; a manifest may name them.

    The base is qualified by its file system, as the listed paths are, so that it may
    be given with or without scheme and authority.
    The driver lists folders (in parallel tasks once there are many), so this
    suits folders of up to some millions of files. Beyond that write a manifest
    where the files are produced and use `read_manifest`.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(base)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    base = system.makeQualified(path).toString()
    roots = [f"{base.rstrip('/')}/{f}" for f in folders] or [base]
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(roots)
        .select(
            below(base, F.col("path")).alias("path"),
            "length",
            F.col("modificationTime").alias("modified"),
        )
    )


def watch_media(
    spark: SparkSession, base: str, *folders: str, per_batch: int = 100_000
) -> DataFrame:
    """Files below the folders as a stream: each once, when it is first seen. Contents are
    not read. Files of no bytes are passed over, as by `list_media`.

    The checkpoint remembers what was seen, so a restart goes on from there. A micro-batch
    takes `per_batch` files of a folder at most and leaves the others to the next. Each
    micro-batch lists the folders named; where old ones are full and get no files any more,
    watch the new ones only and let the manifest remember the rest. Put files in place
    whole, by renaming: one that grows is seen with the length that it has when it is seen.
    """
    columns = "path string, modificationTime timestamp, length long, content binary"
    found = None
    for folder in folders or ("",):
        files = (
            spark.readStream.format("binaryFile")
            .schema(columns)
            .option("recursiveFileLookup", True)
            .option("maxFilesPerTrigger", per_batch)
            .load(f"{base.rstrip('/')}/{folder}")
            .select(
                below(base, F.col("path")).alias("path"),
                "length",
                F.col("modificationTime").alias("modified"),
            )
        )
        found = files if found is None else found.unionAll(files)
    return found


def manifest_into(files: DataFrame, manifest: str, checkpoint: str) -> DataStreamWriter:
    """A stream writer that adds files to a manifest. Spark's file sink takes each
    micro-batch once, and `read_manifest` sees whole ones only."""
    return (
        files.writeStream.format("parquet")
        .outputMode("append")
        .option("path", manifest)
        .option("checkpointLocation", checkpoint)
    )


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table with one row per media file, or per sighting of one."""
    return spark.read.schema(MEDIA_FILE).parquet(path)


def latest_sightings(manifest: DataFrame) -> DataFrame:
    """One row per file, the latest, of a manifest that may name a file several times."""
    last = F.max(F.struct("modified", "length")).alias("last")
    return manifest.groupBy("path").agg(last).select("path", "last.length", "last.modified")
