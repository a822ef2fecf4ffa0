import random

import pytest
from pyspark.sql import functions as F

from cliptrack.operators import append, candidates
from cliptrack.operators.files import file_for_id
from cliptrack.plans import ingest
from cliptrack.schema import INVENTORY
from cliptrack.sources.listings import rows_from_records
from helpers import at, by_id, downloads, files, inventory, item, listings, utc


def entry(video_id, url=None, page=None):
    return {"id": video_id, "url": url, "webpage_url": page}


def test_entries_of_a_listing(spark):
    listed = listings(
        spark,
        {
            "source_url": "s",
            "id": "s-id",
            "entries": [
                entry("a", "u-a"),
                entry("b", "", "page-b"),
                entry("c", "", ""),
                entry(None, "u"),
                entry("", "u"),
                None,
                entry("d", None, "page-d"),
            ],
        },
    )
    rows = candidates.listing_entries(listed).orderBy("pos").collect()
    assert [(r.pos, r.video_id, r.url) for r in rows] == [
        (0, "a", "u-a"),
        (1, "b", "page-b"),
        (6, "d", "page-d"),
    ]


def test_listing_without_entries_is_its_own_entry(spark):
    listed = listings(
        spark,
        {"source_url": "one", "id": "x", "webpage_url": "page-x", "entries": []},
        {"source_url": "two", "id": "y", "url": "u-y", "entries": None},
        {"source_url": "three", "id": None, "url": "u", "entries": None},
        {"source_url": "", "id": "z", "url": "u", "entries": None},
        {"source_url": None, "id": "z", "url": "u", "entries": None},
        {"source_url": "four", "id": "q", "url": "u", "entries": [entry("e", "u-e")]},
    )
    rows = candidates.listing_entries(listed).collect()
    assert sorted((r.source_url, r.video_id, r.url) for r in rows) == [
        ("four", "e", "u-e"),
        ("one", "x", "page-x"),
        ("two", "y", "u-y"),
    ]


def test_first_new_entry_per_source(spark):
    listed = listings(
        spark,
        {"source_url": "s", "entries": [entry("a", "u"), entry("b", "u"), entry("c", "u")]},
        {"source_url": "t", "entries": [entry("a", "u")]},
        {"source_url": "u", "entries": [entry("z", "u"), entry("c", "u"), entry("c", "u")]},
    )
    known = inventory(spark, item("a"), item("z"))
    one = ingest.to_download_from_listings(listed, known)
    assert sorted((r.source_url, r.pos, r.video_id) for r in one.collect()) == [
        ("s", 1, "b"),
        ("u", 1, "c"),
    ]
    two = ingest.to_download_from_listings(listed, known, 2)
    assert sorted((r.source_url, r.video_id) for r in two.collect()) == [
        ("s", "b"),
        ("s", "c"),
        ("u", "c"),
    ]


@pytest.mark.parametrize("n", [1, 2, 7, 40, 10**6])
def test_first_in_group(spark, monkeypatch, n):
    """Some rows have no position, and some no group."""
    monkeypatch.setattr(candidates, "RANK_WIDTH", 5)
    draw = random.Random(n)
    rows = [
        (g, draw.choice([None, *range(-5, 60)]), str(i))
        for i in range(400)
        for g in [draw.choice(["a", "a", "b", None])]
    ]
    table = spark.createDataFrame(rows, "g string, pos bigint, tie string")
    got = candidates.first_in_group(table, "g", "pos", "tie", n).collect()
    low = lambda r: (r[0] or "", -(10**9) if r[1] is None else r[1], r[2])
    want = [r for g in ("a", "b", None) for r in sorted((x for x in rows if x[0] == g), key=low)[:n]]
    assert sorted(((r.g, r.pos, r.tie) for r in got), key=low) == sorted(want, key=low)
    ranks = [(*low(r), r["rank"]) for r in sorted(got, key=low)]
    assert [r[3] for r in ranks] == [
        i + 1 for g in ["", "a", "b"] for i in range(sum(r[0] == g for r in ranks))
    ]


def test_ingest_one_new_item(spark):
    listed = listings(
        spark, {"source_url": "https://feed.example.org/boats", "entries": [entry("tug-7", "u")]}
    )
    wanted = ingest.to_download_from_listings(listed, inventory(spark))
    got = downloads(
        spark,
        {
            "source_url": "https://feed.example.org/boats",
            "entry_id": "tug-7",
            "id": "tug-7",
            "webpage_url": "https://feed.example.org/boats/tug-7",
            "title": "Tug in the lock",
            "duration": 95.5,
        },
    )
    done = ingest.ingest(wanted, got, files(spark, "videos/raw/tug-7.mp4"), at(5))
    rows = append.append(inventory(spark), done.rows, ingest.ROUND_ORDER).collect()
    assert len(rows) == 1
    row = rows[0]
    assert (row.video_id, row.status_fb, row.path_local) == (
        "tug-7",
        "pending",
        "videos/raw/tug-7.mp4",
    )
    assert (row.source_url, row.title, row.duration) == (
        "https://feed.example.org/boats/tug-7",
        "Tug in the lock",
        95,
    )
    assert utc(row.created_at) == utc(row.updated_at) == at(5)
    assert done.rejects.isEmpty() and done.failures.isEmpty()


def test_row_defaults(spark):
    listed = listings(
        spark,
        {"source_url": "s1", "entries": [entry("a", "u", "page-a")]},
        {"source_url": "s2", "entries": [entry("b", "u")]},
        {"source_url": "s3", "entries": [entry("c", "u")]},
        {"source_url": "s4", "entries": [entry("d", "u")]},
        {"source_url": "s5", "entries": [entry("e", "u")]},
        {"source_url": "s6", "entries": [entry("f", "u")]},
    )
    wanted = ingest.to_download_from_listings(listed, inventory(spark))
    got = downloads(
        spark,
        {"source_url": "s1", "entry_id": "a", "webpage_url": ""},
        {"source_url": "s2", "entry_id": "b", "title_known": True, "duration": 2.9},
        {"source_url": "s3", "entry_id": "c", "id": ""},
        {"source_url": "s4", "entry_id": "d", "error": "403"},
        {"source_url": "s5", "entry_id": "e", "id": "other", "title": "T"},
        {"source_url": "s6", "entry_id": "not asked for", "id": "f"},
    )
    done = ingest.ingest(wanted, got, files(spark, "videos/raw/other.webm"), at(1))
    rows = by_id(done.rows)
    assert set(rows) == {"a", "b", "other"}
    assert (rows["a"].source_url, rows["a"].title, rows["a"].duration) == ("page-a", "", 0)
    assert rows["a"].path_local == ""
    assert (rows["b"].source_url, rows["b"].title, rows["b"].duration) == ("s2", None, 2)
    assert rows["other"].path_local == "videos/raw/other.webm"
    assert [r.entry_id for r in done.rejects.collect()] == ["c"]
    failed = done.failures.collect()
    assert [(r.video_id, r.status_fb, r.set_cols) for r in failed] == [
        ("d", "failed", ["status_fb"])
    ]


def test_file_for_id(spark):
    table = files(
        spark,
        "videos/raw/a.webm",
        "videos/raw/a.mp4",
        "videos/raw/b.mp4.part",
        "videos/raw/c.x.mp4",
        "videos/raw/noending",
        "videos/raw/sub/d.mp4",
        "videos/processed/e.mp4",
        "videos/raw/f[1].mp4",
        "videos/raw/g.ytdl",
        "videos/raw/h with space.mp4",
    )
    assert {v: r.path_local for v, r in by_id(file_for_id(table)).items()} == {
        "a": "videos/raw/a.mp4",
        "c": "videos/raw/c.x.mp4",
        "c.x": "videos/raw/c.x.mp4",
        "f[1]": "videos/raw/f[1].mp4",
        "h with space": "videos/raw/h with space.mp4",
    }


def test_append_keeps_what_is_there_and_first_come(spark):
    known = inventory(spark, item("a", "posted", minutes=1))
    batch = inventory(
        spark,
        item("a", minutes=2),
        item("b", minutes=4, title="late"),
        item("b", minutes=3, title="early"),
        item("c", minutes=1),
    )
    after = by_id(append.append(known, batch, ("created_at",)))
    assert set(after) == {"a", "b", "c"}
    assert after["a"].status_fb == "posted"
    assert after["b"].title == "early"
    numbers = append.append_metrics(known, batch).first().asDict()
    assert numbers == {"offered": 4, "inserted": 2, "duplicate": 2, "refused": 0}


def test_rows_without_id_are_refused(spark):
    batch = spark.createDataFrame(
        [(None, "x"), (None, "y"), ("a", "z")], "video_id string, title string"
    )
    table = spark.createDataFrame([], "video_id string, title string")
    assert [r.video_id for r in append.fresh_rows(table, batch, ("title",)).collect()] == ["a"]
    assert append.keyless_rows(batch).count() == 2
    numbers = append.append_metrics(table, batch).first().asDict()
    assert numbers == {"offered": 3, "inserted": 1, "duplicate": 0, "refused": 2}
    empty = append.append_metrics(table, table).first().asDict()
    assert empty == {"offered": 0, "inserted": 0, "duplicate": 0, "refused": 0}


def test_null_is_a_key_for_keep_first(spark):
    rows = spark.createDataFrame([(None, 2), (None, 1), ("a", 3)], "k string, n int")
    got = append.keep_first(rows, "k", ("n",)).collect()
    assert {(r.k, r.n) for r in got} == {(None, 1), ("a", 3)}


def test_append_matches_a_row_loop(spark):
    draw = random.Random(5)
    known = [item(str(i), minutes=i) for i in range(0, 40, 3)]
    batch = [
        item(str(draw.randint(0, 40)), minutes=100 + n, title=str(n)) for n in range(120)
    ]
    draw.shuffle(batch)
    want = {}
    for row in known + sorted(batch, key=lambda r: r["created_at"]):
        want.setdefault(row["video_id"], row["title"])
    got = append.append(
        inventory(spark, *known), inventory(spark, *batch).repartition(7), ("created_at",)
    )
    assert {v: r.title for v, r in by_id(got).items()} == want
    assert got.count() == len(want)


def test_schema_is_strict(spark):
    table = inventory(spark, item("a"))
    with pytest.raises(append.SchemaMismatch, match="duration"):
        append.stack(table, table.withColumn("duration", F.lit("x")))
    with pytest.raises(append.SchemaMismatch, match="title"):
        append.stack(table, table.drop("title"))
    with pytest.raises(append.SchemaMismatch, match="extra"):
        append.stack(table, table.withColumn("extra", F.lit(1)))
    with pytest.raises(append.SchemaMismatch):
        append.append(table, table.withColumn("duration", F.lit(1)), ("created_at",))
    with pytest.raises(ValueError, match="unknown"):
        rows_from_records(spark, [{"video_id": "a", "oops": 1}], INVENTORY)


def test_failed_downloads(spark):
    attempts = spark.createDataFrame(
        [("a", 1, at(0)), ("a", 2, at(1)), ("b", 3, at(2)), ("c", 3, at(2)), ("c", 4, at(3))],
        "entry_id string, attempt int, failed_at timestamp",
    )
    effect = ingest.record_download_failures(attempts, inventory(spark, item("b")), at=at(9))
    assert sorted(by_id(effect.patches)) == ["b", "c"]
    assert [r.video_id for r in effect.unmatched.collect()] == ["c"]
    left = sorted(effect.retries.collect(), key=lambda r: r.attempt)
    assert [r.entry_id for r in left] == ["a", "a"]
    assert 4.5 <= left[0].wait_seconds <= 5.5 and 13.5 <= left[1].wait_seconds <= 16.5
    for row in left:
        gap = (row.next_attempt_at - row.failed_at).total_seconds()
        assert abs(gap - row.wait_seconds) < 1e-5


