import random
from pathlib import PurePosixPath

import pytest
from pyspark.sql import functions as F

from cliptrack.functions import (
    Backoff,
    after_seconds,
    below,
    changes_picture,
    crop_box,
    edit_plan,
    file_stem,
    file_suffix,
    filled,
    is_filled,
    output_path,
    whole_seconds,
)
from cliptrack.functions.edits import EDITS
from helpers import T0


def values(spark, schema, rows, column):
    data = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, {schema}")
    return [r[1] for r in sorted(data.select("i", column).collect())]


def test_filled_takes_first_non_empty(spark):
    rows = [("a", "b"), ("", "b"), (None, "b"), ("", ""), (None, None), (" ", "b")]
    got = values(spark, "x string, y string", rows, filled(F.col("x"), F.col("y")))
    assert got == ["a", "b", "b", None, None, " "]


def test_is_filled_is_never_null(spark):
    got = values(spark, "x string", [("a",), ("",), (None,)], is_filled(F.col("x")))
    assert got == [True, False, False]


def test_duration_is_cut_not_rounded(spark):
    rows = [(2.7,), (0.0,), (None,), (-2.7,), (12.0,), (1e12 + 0.9,)]
    got = values(spark, "x double", rows, whole_seconds(F.col("x")))
    assert got == [2, 0, 0, -2, 12, 10**12]


def test_stem_and_suffix_agree_with_pathlib(spark):
    paths = [
        "videos/raw/a.mp4",
        "a.b.c.mkv",
        "videos/raw/none",
        "videos/.hidden",
        "videos/.hidden.mp4",
        "x/a b é.webm",
        "dir.d/plain",
        "videos/raw/id.mp4.part",
    ]
    rows = [(p,) for p in paths]
    assert values(spark, "p string", rows, file_stem(F.col("p"))) == [
        PurePosixPath(p).stem for p in paths
    ]
    assert values(spark, "p string", rows, file_suffix(F.col("p"))) == [
        PurePosixPath(p).suffix for p in paths
    ]


def test_path_below_a_base(spark):
    rows = [
        ("file:/srv/m/videos/raw/a.mp4",),
        ("file:///srv/m/videos/raw/a.mp4",),
        ("/srv/m/videos/raw/a.mp4",),
        (None,),
    ]
    for base in ("/srv/m", "/srv/m/", "file:/srv/m", "file:///srv/m/"):
        got = values(spark, "p string", rows, below(base, F.col("p")))
        assert got == ["videos/raw/a.mp4"] * 3 + [None]
    for outside in ("/srv/media/a.mp4", "videos/raw/a.mp4", "hdfs://name/srv/m/a.mp4"):
        with pytest.raises(Exception, match="not below"):
            values(spark, "p string", [(outside,)], below("file:/srv/m", F.col("p")))
    remote = [("hdfs://name:8020/m/videos/raw/a.mp4",)]
    assert values(spark, "p string", remote, below("hdfs://name:8020/m/", F.col("p"))) == [
        "videos/raw/a.mp4"
    ]


def test_output_path(spark):
    column = output_path(F.col("p"), F.col("v"), F.lit(T0), "run")
    rows = [("videos/raw/in.x.mp4", "a"), ("videos/raw/in.x.mp4", "b"), ("plain", "a")]
    got = values(spark, "p string, v string", rows, column)
    assert got[0].startswith("videos/processed/in.x_20250101000000_") and got[0].endswith(".mp4")
    assert len(got[0]) == len("videos/processed/in.x_20250101000000_12345678.mp4")
    assert got[0] != got[1]
    assert got[2].startswith("videos/processed/plain_2025") and "." not in got[2]
    assert got == values(spark, "p string, v string", rows, column)


def test_edit_plans_are_fair_and_stable(spark):
    items = spark.range(3000).select(F.col("id").cast("string").alias("video_id"))
    plan = edit_plan(F.col("video_id"), 7)
    once = dict(items.select("video_id", plan).collect())
    again = dict(items.repartition(13).select("video_id", plan).collect())
    assert once == again
    assert {len(p) for p in once.values()} == {2, 3, 4}
    assert all(len(set(p)) == len(p) and set(p) <= set(EDITS) for p in once.values())
    for size in (2, 3, 4):
        assert 800 < sum(len(p) == size for p in once.values()) < 1200
    for name in EDITS:
        assert 600 < sum(p[0] == name for p in once.values()) < 900
    other = dict(items.select("video_id", edit_plan(F.col("video_id"), 8)).collect())
    assert other != once
    idle = dict(items.select("video_id", changes_picture(plan)).collect())
    assert all(idle[v] == bool({"mirror", "zoom"} & set(p)) for v, p in once.items())


def test_crop_box(spark):
    rows = [(1920, 1080), (640, 360), (0, 0), (None, 10), (19, 20)]
    got = values(spark, "w int, h int", rows, crop_box(F.col("w"), F.col("h")))
    assert [tuple(b) for b in got] == [
        (96, 54, 1824, 1026),
        (32, 18, 608, 342),
        (0, 0, 0, 0),
        (0, 0, 0, 10),
        (0, 1, 19, 19),
    ]
    sizes = spark.range(10_000)
    wrong = sizes.filter(crop_box(F.col("id"), F.col("id"))["x1"] != F.floor(F.col("id") / 20))
    assert wrong.count() == 0


def test_backoff_waits(spark):
    attempts = [(n,) for n in (0, 1, 2, 3, 4, 5, 6, 1000)]
    got = values(spark, "n int", attempts, Backoff(retries=6).wait(F.col("n")))
    assert got == [None, 5.0, 15.0, 45.0, 90.0, 90.0, None, None]
    got = values(spark, "n int", attempts, Backoff().wait(F.col("n")))
    assert got == [None, 5.0, 15.0, None, None, None, None, None]
    huge = values(spark, "n int", [(1000,)], Backoff(retries=2000).wait(F.col("n")))
    assert huge == [90.0]
    flat = values(spark, "n int", [(3,)], Backoff(5, 2.0, 1.0, 9.0).wait(F.col("n")))
    assert flat == [2.0]


def test_backoff_needs_an_attempt():
    with pytest.raises(ValueError):
        Backoff(retries=0)


def test_spread_stays_within_a_tenth_and_repeats(spark):
    rows = [(str(i), random.Random(i).randint(1, 4)) for i in range(500)]
    column = Backoff(retries=9).spread_wait(F.col("n"), F.col("v"), 3)
    got = values(spark, "v string, n int", rows, column)
    nominal = [min(5.0 * 3 ** (n - 1), 90.0) for _, n in rows]
    assert all(0.9 * w <= g <= 1.1 * w for g, w in zip(got, nominal))
    assert len(set(got)) > 490
    assert got == values(spark, "v string, n int", rows, column)
    last = values(spark, "v string, n int", [("a", 9)], column)
    assert last == [None]


def test_after_seconds_keeps_microseconds(spark):
    moment = F.lit("2025-01-01 00:00:00").cast("timestamp_ntz")
    got = values(spark, "s double", [(5.25,), (None,)], after_seconds(moment, F.col("s")))
    assert str(got[0]) == "2025-01-01 00:00:05.250000" and got[1] is None
