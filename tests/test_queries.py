import pytest

import __spark_entry__ as entry
from oracle import differences, duck
from workload.registry import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(SMALL)


def test_every_query_has_its_sql():
    assert all(q.sql is not None for q in QUERIES.values())
    assert set(QUERIES) <= set(entry.queries()) and set(QUERIES) <= set(entry.oracle_sql())


def test_entry_runs(spark):
    rows = entry.entry(spark)
    assert rows.columns == ["source_url", "pos", "video_id", "url"]
    assert rows.count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, connection, name):
    assert differences(spark, connection, name, SMALL) is None


#: Queries that look keys up in a table; here as if no table were small.
LOOKUPS = [
    "already_exists",
    "append_keep_first",
    "append_metrics",
    "bulk_update",
    "failed_before_edit",
    "failed_downloads_unmatched",
    "files_for_edit",
    "files_for_publish",
    "first_new_per_source",
    "first_three_new_per_source",
    "get_next_sweep",
    "inventory_after_sweep",
    "mark_unknown",
    "missing_for_edit",
    "new_candidates",
    "next_to_publish",
    "orphan_files",
    "planned_edits",
    "rows_in_id_set",
    "stored_append",
    "stored_transitions",
    "transition_audit",
    "unmatched_updates",
    "update_by_set",
]


@pytest.mark.parametrize("name", LOOKUPS)
def test_lookups_are_right_without_broadcasts(spark, connection, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert differences(spark, connection, name, SMALL) is None
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
