import pytest

from cliptrack.operators import keys

TABLE = [("a",), ("b",), ("c",), (None,)]
ROWS = [("a", 1), ("a", 2), ("x", 3), (None, 4), ("c", 5)]


@pytest.fixture(params=["broadcast", "shuffle"])
def tables(spark, request):
    """A table and rows to look up, in the two ways a join may go."""
    if request.param != "broadcast":
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield (
        spark.createDataFrame(ROWS, "k string, n int"),
        spark.createDataFrame(TABLE, "k string"),
    )
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def numbers(rows):
    return sorted(r.n for r in rows.collect())


def test_lookups(tables):
    rows, table = tables
    assert numbers(keys.in_table(rows, table, "k")) == [1, 2, 5]
    assert numbers(keys.not_in_table(rows, table, "k")) == [3, 4]
    flagged = keys.flag_known(rows, table, "k", "known")
    assert flagged.columns == ["k", "n", "known"]
    assert sorted((r.n, r.known) for r in flagged.collect()) == [
        (1, True),
        (2, True),
        (3, False),
        (4, False),
        (5, True),
    ]


def test_repeated_and_missing_keys_in_the_table(tables):
    rows, table = tables
    twice = table.union(table)
    assert numbers(keys.flag_known(rows, twice, "k", "known")) == [1, 2, 3, 4, 5]
    assert numbers(keys.in_table(rows, twice, "k")) == [1, 2, 5]
    none = table.filter("k = 'nothing'")
    assert numbers(keys.in_table(rows, none, "k")) == []
    assert numbers(keys.not_in_table(rows, none, "k")) == [1, 2, 3, 4, 5]
