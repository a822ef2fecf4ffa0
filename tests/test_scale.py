"""Shapes of plans, and behaviour under a key that holds a third of all rows."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from cliptrack.operators import append, candidates, patches
from cliptrack.operators.files import flag_on_disk, missing_on_disk, on_disk
from cliptrack.operators.keys import not_in_table
from cliptrack.plans import ingest
from workload.registry import QUERIES

SMALL = "/root/testdata/sf0.001"

#: Queries that write a stored inventory first; what they return is a scan.
STORING = ("stored", "stream", "inventory_view", "listings_read")
LAZY = [n for n in QUERIES if not n.startswith(STORING)]


@pytest.fixture
def no_broadcast(spark):
    """Plans as they are where no side is small."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan_of(rows) -> str:
    rows.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "10000")
    return rows._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_plan_has_no_slow_operator(spark, no_broadcast, name):
    text = plan_of(entry.queries()[name](spark, SMALL))
    for word in ("CartesianProduct", "NestedLoop", "Python", "InMemoryTableScan"):
        assert word not in text
    # A whole table never meets in one task: only aggregates of one row do.
    for before in re.findall(r"Exchange SinglePartition.*\n.*?[+:]- (?:\*\(\d+\) )?(\w+)\(", text):
        assert before.endswith("Aggregate")
    for window in re.findall(r"Window(?:GroupLimit)? \[.*?\], \[(.*?)\]", text):
        assert window.strip()


def test_scans_read_only_what_they_need(spark):
    text = plan_of(entry.queries()["status_census"](spark, SMALL))
    assert "ReadSchema: struct<o_orderstatus:string,o_totalprice:double>" in text
    text = plan_of(entry.queries()["orphan_files"](spark, SMALL))
    assert "l_orderkey" in text and "l_extendedprice" not in text


def test_first_rows_is_a_top_k(spark):
    assert "TakeOrderedAndProject" in plan_of(entry.queries()["editable_first_n"](spark, SMALL))


def test_append_moves_only_keys_of_the_table(spark, no_broadcast):
    text = plan_of(entry.queries()["append_keep_first"](spark, SMALL))
    scans = re.findall(r"ReadSchema: struct<(o_orderkey[^>]*)>", text)
    # Once in full without any shuffle above it, once as bare keys.
    assert len(scans) == 2
    keys = [s for s in scans if "o_custkey" not in s]
    assert keys == ["o_orderkey:bigint"]


def test_a_lookup_is_one_join(spark, no_broadcast):
    text = plan_of(entry.queries()["new_candidates"](spark, SMALL))
    assert len(re.findall(r"SortMergeJoin.*LeftAnti", text)) == 1
    assert text.count("Generate explode") + text.count("Generate posexplode") == 2


def test_small_table_is_broadcast(spark):
    rows = spark.range(1000).select(F.col("id").cast("string").alias("video_id"))
    few = spark.range(10).select(F.col("id").cast("string").alias("video_id"))
    text = plan_of(not_in_table(rows, few, "video_id"))
    assert text.count("BroadcastHashJoin") == 1 and "Exchange hashpartitioning" not in text


@pytest.fixture
def hot(spark, no_broadcast):
    """Settings under which the test's hot key counts as skewed."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


ROWS = 90_000


def skewed(spark, key: str):
    """Rows of which a third share one key."""
    rows = spark.range(0, ROWS, 1, 16)
    hot_key = F.when(F.col("id") < ROWS // 3, "hot").otherwise(F.col("id").cast("string"))
    return rows.select("id", hot_key.alias(key), F.sha2(F.col("id").cast("string"), 256).alias("pad"))


def split(rows) -> bool:
    """Whether the plan that ran had split a skewed join partition."""
    return "skew=true" in rows._jdf.queryExecution().executedPlan().toString()


def test_hot_id_in_listings_is_split(spark, hot):
    entries = skewed(spark, "video_id").select(
        F.col("pad").alias("source_url"),
        F.lit(0).cast("bigint").alias("pos"),
        "video_id",
        F.col("pad").alias("url"),
        F.col("pad").alias("webpage_url"),
    )
    known = spark.range(0, ROWS, 2).select(F.col("id").cast("string").alias("video_id"))
    new = candidates.new_entries(entries, known)
    assert len(new.collect()) == ROWS // 3 + ROWS // 3
    assert split(new)


@pytest.mark.parametrize(
    "check, rows", [(on_disk, ROWS // 3 + 1), (missing_on_disk, ROWS - ROWS // 3 - 1), (flag_on_disk, ROWS)]
)
def test_hot_path_is_split(spark, hot, check, rows):
    files = spark.createDataFrame([("hot",), ("80001",), ("hot",)], "path string")
    checked = check(skewed(spark, "path_local"), files)
    assert len(checked.collect()) == rows
    assert split(checked)


def test_hot_result_is_split_or_folded(spark, hot):
    """Many sources that all brought the same item leave one row of it."""
    table = skewed(spark, "id_text")
    requested = table.select(
        F.col("pad").alias("source_url"),
        F.col("id").alias("pos"),
        F.col("pad").alias("video_id"),
        F.lit("u").alias("url"),
        F.lit("").alias("webpage_url"),
    )
    got = table.select(
        F.col("pad").alias("source_url"),
        F.col("pad").alias("entry_id"),
        F.col("id_text").alias("id"),
        *(F.lit(None).cast("string").alias(c) for c in ("webpage_url", "title", "error")),
        F.lit(True).alias("title_known"),
        F.lit(1.0).alias("duration"),
    )
    files = spark.createDataFrame([("videos/raw/hot.mp4",)], "path string")
    rows = ingest.ingest(requested, got, files).rows
    assert rows.count() == ROWS - ROWS // 3 + 1
    assert rows.filter("path_local = 'videos/raw/hot.mp4'").count() == 1


def nodes(node):
    """All operators of a plan that ran, also those inside finished stages."""
    yield node
    name = node.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        yield from nodes(node.executedPlan())
    elif name.endswith("QueryStageExec"):
        yield from nodes(node.plan())
    children = node.children()
    for i in range(children.size()):
        yield from nodes(children.apply(i))


def sent(rows) -> int:
    """Rows that left the map side of the largest shuffle."""
    rows.collect()
    metrics = [n.metrics() for n in nodes(rows._jdf.queryExecution().executedPlan())]
    name = "shuffleRecordsWritten"
    return max(m.apply(name).value() for m in metrics if m.contains(name))


def test_hot_source_leaves_each_task_as_one_row(spark, hot):
    entries = skewed(spark, "source_url").select(
        "source_url",
        F.col("id").alias("pos"),
        F.col("pad").alias("video_id"),
        F.col("pad").alias("url"),
        F.col("pad").alias("webpage_url"),
    )
    first = candidates.first_per_source(entries)
    assert first.count() == ROWS - ROWS // 3 + 1
    assert sent(first) <= ROWS - ROWS // 3 + 16


def test_hot_item_is_folded_before_the_shuffle(spark, hot):
    offered = skewed(spark, "video_id").withColumnRenamed("pad", "title")
    kept = append.keep_first(offered, "video_id", ("id",))
    assert sent(kept) <= ROWS - ROWS // 3 + 16
    changes = offered.select(
        "video_id",
        "title",
        F.array(F.lit("title")).alias("set_cols"),
        F.timestamp_seconds("id").alias("at"),
    )
    folded = patches.fold_patches(changes)
    assert sent(folded) <= ROWS - ROWS // 3 + 16
    assert kept.count() == folded.count() == ROWS - ROWS // 3 + 1
