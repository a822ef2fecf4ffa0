"""Streams whose state ends: downloads that come, come late or never; retries; files."""

from datetime import timedelta
from random import Random
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.sql import functions as F

from cliptrack import Inventory
from cliptrack.functions.backoff import Backoff
from cliptrack.schema import DOWNLOAD
from cliptrack.sources.media import latest_sightings, manifest_into, read_manifest, watch_media
from cliptrack.streaming import arrivals, meetings, timed
from cliptrack.streaming.transitions import fold_into, latest_status
from helpers import T0, at, by_id, files, inventory, item, utc

REQUEST = "source_url string, pos long, video_id string, webpage_url string, requested_at timestamp"
FETCHED = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in DOWNLOAD) + ", fetched_at timestamp"
TICK = at(100_000)


class Feed:
    """A folder that a stream reads, to which rows are added."""

    def __init__(self, spark, path, schema):
        self.spark, self.path, self.schema = spark, f"{path}", schema

    def add(self, *rows):
        if rows:
            self.spark.createDataFrame(rows, self.schema).coalesce(1).write.mode("append").parquet(self.path)

    def stream(self):
        return self.spark.readStream.schema(self.schema).parquet(self.path)


def drain(writer):
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


# -- requests meet downloads -----------------------------------------------------


class Meeting:
    def __init__(self, spark, path):
        self.requests = Feed(spark, f"{path}/requests", REQUEST)
        self.downloads = Feed(spark, f"{path}/downloads", FETCHED)
        self.requests.add(("", None, "", None, at(0)))
        self.downloads.add(self.got("", 0, listing=""))
        self.inventory = Inventory(spark, f"file:{path}/inventory")
        self.inventory.create()
        self.checkpoint, self.spark = f"{path}/checkpoint", spark

    def asked(self, entry, minutes, listing="list"):
        return (listing, 0, entry, f"https://page/{entry}", at(minutes))

    def got(self, entry, minutes, error=None, listing="list", title="a title"):
        return (listing, entry, None, None, title, True, 4.5, error, at(minutes))

    def run(self, *media):
        pairs = meetings.met(self.requests.stream(), self.downloads.stream(), "1 hour", "5 minutes")
        found = files(self.spark, *media)
        return drain(meetings.ingest_into(pairs, self.inventory, lambda: found, self.checkpoint))

    def tick(self, moment):
        self.requests.add(("", None, "", None, moment))
        self.downloads.add(("", "", None, None, None, None, None, None, moment))

    def failed(self):
        return sorted(r.video_id for r in self.inventory.transitions(unmatched=True).collect())


@pytest.fixture
def meeting(spark, tmp_path):
    return Meeting(spark, tmp_path)


def test_downloads_that_come_late_or_never_are_failures(meeting):
    meeting.requests.add(*(meeting.asked(e, m) for e, m in [("a", 1), ("b", 2), ("c", 3), ("d", 4)]))
    meeting.downloads.add(
        meeting.got("a", 30), meeting.got("b", 2 + 61), meeting.got("d", 9, error="gone"), meeting.got("stray", 9)
    )
    meeting.run("videos/raw/a.mp4")
    assert by_id(meeting.inventory.read())["a"].path_local == "videos/raw/a.mp4"
    assert meeting.failed() == ["d"]  # b and c may still come
    meeting.tick(TICK)
    meeting.run()
    assert sorted(by_id(meeting.inventory.read())) == ["a"]
    assert meeting.failed() == ["b", "c", "d"]


def test_a_request_waits_over_restarts(meeting):
    meeting.requests.add(meeting.asked("a", 1), meeting.asked("b", 2))
    meeting.run()
    assert meeting.inventory.read().isEmpty() and meeting.failed() == []
    meeting.downloads.add(meeting.got("b", 10, title="first"))
    meeting.run()
    meeting.downloads.add(meeting.got("a", 20), meeting.got("b", 21, title="second"))
    meeting.run()
    found = by_id(meeting.inventory.read())
    assert sorted(found) == ["a", "b"] and found["b"].title == "first"
    meeting.run()
    assert meeting.inventory.read().count() == 2 and meeting.failed() == []


def test_requests_leave_the_state(meeting):
    meeting.requests.add(*(meeting.asked(f"e{i}", 1) for i in range(50)))
    meeting.downloads.add(*(meeting.got(f"e{i}", 2) for i in range(40)))
    waiting = meeting.run().lastProgress["stateOperators"][0]["numRowsTotal"]
    meeting.tick(TICK)
    assert waiting > 50
    assert meeting.run().lastProgress["stateOperators"][0]["numRowsTotal"] <= 4  # ticks
    assert len(meeting.failed()) == 10


# -- status by event time, with state that ends --------------------------------------

CHANGE = "video_id string, status_fb string, ts timestamp, event_id long"


def test_newest_status_equals_the_fold_of_all(spark, tmp_path):
    events = [(f"v{i * 7 % 23}", ["pending", "ready", None, "posted"][i % 4], at(i * 37 % 400), i) for i in range(300)]
    feed, store = Feed(spark, f"{tmp_path}/in", CHANGE), Inventory(spark, f"file:{tmp_path}/inv")
    store.append(inventory(spark, *(item(f"v{i}") for i in range(23))), ("created_at",))
    for part in range(3):
        feed.add(*events[part::3])
        drain(fold_into(feed.stream(), store, f"{tmp_path}/c", lateness="1 day"))
    want = {r.video_id: r.status_fb for r in latest_status(spark.createDataFrame(events, CHANGE)).collect()}
    assert {v: r.status_fb for v, r in by_id(store.read()).items()} == want


def test_items_leave_the_state_and_late_events_are_dropped(spark, tmp_path):
    feed, store = Feed(spark, f"{tmp_path}/in", CHANGE), Inventory(spark, f"file:{tmp_path}/inv")
    store.append(inventory(spark, *(item(f"v{i}") for i in range(60))), ("created_at",))

    def run():
        query = drain(fold_into(feed.stream(), store, f"{tmp_path}/c", lateness="10 minutes"))
        return query.lastProgress["stateOperators"][0]["numRowsTotal"]

    feed.add(*((f"v{i}", "posted", at(i / 10), i) for i in range(50)))
    held = run()
    feed.add(("v55", "ready", at(60), 100))
    run()
    feed.add(("v56", "ready", at(61), 101))
    left = run()
    assert 0 < left < held / 5
    feed.add(("v1", "failed", at(1), 200))  # older than the watermark
    feed.add(("v2", "failed", at(62), 201))
    run()
    now = by_id(store.read())
    assert (now["v1"].status_fb, now["v2"].status_fb, now["v3"].status_fb) == ("posted", "failed", "posted")


# -- retries when they are due --------------------------------------------------------

ATTEMPT = "entry_id string, attempt int, failed_at timestamp, ok boolean"


class Retries:
    def __init__(self, spark, path):
        self.feed, self.path, self.spark, self.batches = Feed(spark, f"{path}/in", ATTEMPT), path, spark, []

    def run(self, *rows, **options):
        self.feed.add(*rows)
        before = len(self.batches)
        due = timed.due_attempts(self.feed.stream(), "0 seconds", **options)

        def keep(batch, number):
            self.batches.append([tuple(r) for r in batch.collect()])

        drain(
            due.writeStream.outputMode("append").option("checkpointLocation", f"{self.path}/c").foreachBatch(keep)
        )
        return [r for batch in self.batches[before:] for r in batch]


def after(seconds):
    return T0 + timedelta(seconds=seconds)


@pytest.fixture
def retries(spark, tmp_path):
    return Retries(spark, tmp_path)


def test_an_attempt_comes_when_it_is_due(retries):
    steady = Backoff(spread=0.0)
    assert retries.run(("a", 1, after(0), False), ("b", 2, after(1), False), backoff=steady) == []
    found = retries.run((None, 1, after(10), False), backoff=steady)
    assert [(e, n, utc(d), o) for e, n, d, o in found] == [("a", 2, after(5), "retry")]
    found = retries.run(("c", 3, after(16.5), False), backoff=steady)
    assert sorted((e, n, o) for e, n, _, o in found) == [("b", 3, "retry"), ("c", 3, "spent")]
    assert retries.run((None, 1, after(1000), False), backoff=steady) == []


def test_a_success_ends_the_wait(retries):
    retries.run(("a", 1, after(0), False), ("b", 1, after(0), False), ("a", 1, after(3), True), ("a", 1, after(4), False))
    found = retries.run((None, 1, after(100), False))
    assert sorted((e, n) for e, n, _, _ in found) == [("a", 2), ("b", 2)]
    assert all(abs((utc(d) - after(9 if e == "a" else 5)).total_seconds()) <= 0.5 for e, _, d, _ in found)
    retries.run(("a", 2, after(101), False))
    retries.run(("a", 1, after(105), True))
    assert retries.run((None, 1, after(300), False)) == []


def test_due_attempts_go_by_time_over_micro_batches(retries):
    for start in range(0, 60, 12):
        retries.run(*((f"e{i}", 1 + i % 2, after(start + i % 12), False) for i in range(start, start + 12)))
    retries.run((None, 1, after(500), False))
    times = [sorted(utc(r[2]) for r in batch) for batch in retries.batches if batch]
    assert sum(map(len, times)) == 60 and len(times) > 3
    assert all(a[-1] <= b[0] for a, b in zip(times, times[1:]))


class Counted:
    """Stands in for a store: counts the calls that its states and timers get."""

    def __init__(self):
        self.calls, self.held, self.times = 0, [], set()

    def __getattr__(self, name):
        def call(*args):
            self.calls += 1
            if name.startswith("get") and name.endswith("State"):
                return self
            if name == "appendList":
                self.held += args[0]
            if name in ("registerTimer", "deleteTimer"):
                (set.add if name[0] == "r" else set.discard)(self.times, args[0])
            return iter(self.held) if name in ("get", "iterator") else False if name == "exists" else None

        return call


def test_many_attempts_take_few_calls_to_the_store():
    store, due = Counted(), timed._Due()
    due.init(store)
    micros = [1_000_000 * i for i in range(500)]
    names = [f"e{i % 7}" for i in range(500)]
    frame = pd.DataFrame({"entry_id": names, "attempt": 1, "at": micros, "due": [m + 5_000_000 for m in micros]})
    list(due.handleInputRows((1,), iter([frame.assign(ok=False, failed_at=None)]), None))
    assert store.times == {5000} and len(store.held) == 500
    now = SimpleNamespace(getCurrentWatermarkInMs=lambda: 250_000, getExpiryTimeInMs=lambda: 5000)
    out = pd.concat(due.handleExpiredTimer((1,), now, now))
    assert len(out) == 246 and set(out["attempt"]) == {2} and out["due"].max() == 250_000_000
    assert 251_000 in store.times and store.calls < 20


def test_attempts_wait_and_are_forgotten_as_told_one_by_one(retries):
    """Some 150 random rows of eight entries, told in three steps and in one bucket."""
    random, steady = Random(5), Backoff(spread=0.0)
    waits, want, found = {}, [], []
    for start in range(0, 36, 12):
        rows = [
            (random.choice("abcdefgh"), random.choice([1, 1, 2, 2, 3]), after(start + random.randrange(12)), random.random() < 0.15)
            for _ in range(50)
        ]
        for entry, attempt, when, ok in sorted(rows, key=lambda r: (r[2], r[1])):
            if ok:
                waits = {k: t for k, t in waits.items() if k[0] != entry or t > when}
            elif attempt == 3:
                want.append((entry, 3, "spent"))
            else:
                waits[entry, when + timedelta(seconds=5 * 3 ** (attempt - 1)), attempt] = when
        reached = after(start + 11.5)
        want += [(e, a + 1, "retry") for e, d, a in waits if d <= reached]
        waits = {k: t for k, t in waits.items() if k[1] > reached}
        found += retries.run(*rows, (None, 1, reached, False), backoff=steady, buckets=1)
    want += [(e, a + 1, "retry") for e, _, a in waits]
    found += retries.run((None, 1, after(500), False), backoff=steady, buckets=1)
    assert sorted((e, n, o) for e, n, _, o in found) == sorted(want)


# -- files as they appear ---------------------------------------------------------------


def test_files_reach_the_manifest_once(spark, tmp_path):
    base, manifest = tmp_path / "media", f"{tmp_path}/manifest"
    for folder in ("raw", "processed", "other"):
        (base / "videos" / folder).mkdir(parents=True)

    def run():
        found = watch_media(spark, f"file:{base}", "videos/raw", "videos/processed", per_batch=2)
        query = drain(manifest_into(found, manifest, f"{tmp_path}/c"))
        return sum(p["numInputRows"] for p in query.recentProgress)

    for i in range(5):
        (base / "videos" / "raw" / f"v{i}.mp4").write_bytes(b"x" * (i + 1))
    (base / "videos" / "other" / "no.mp4").write_bytes(b"x")
    assert run() == 5 and run() == 0
    (base / "videos" / "processed" / "é v.mp4").write_bytes(b"xyz")
    assert run() == 1
    rows = {r.path: r.length for r in read_manifest(spark, manifest).collect()}
    assert rows == {**{f"videos/raw/v{i}.mp4": i + 1 for i in range(5)}, "videos/processed/é v.mp4": 3}


def test_no_contents_are_read(spark, tmp_path):
    (tmp_path / "a.mp4").write_bytes(b"x" * 1000)
    found = watch_media(spark, f"file:{tmp_path}")
    query = drain(found.writeStream.format("memory").queryName("seen_media").outputMode("append"))
    assert spark.table("seen_media").columns == ["path", "length", "modified"]
    read = query._jsq.explainInternal(False).split("ReadSchema")[1]
    assert "length" in read and "content" not in read


def test_latest_sighting_of_each_file(spark):
    rows = [("a", 1, at(1)), ("a", 5, at(3)), ("a", 4, at(2)), ("b", None, None)]
    found = latest_sightings(spark.createDataFrame(rows, "path string, length long, modified timestamp"))
    assert {r.path: r.length for r in found.collect()} == {"a": 5, "b": None}


# -- counts of arrivals -----------------------------------------------------------------


def test_metrics_of_each_micro_batch(spark, tmp_path):
    rows = inventory(spark, item("a"), item("b"))
    store, metrics = Inventory(spark, f"file:{tmp_path}/inv"), arrivals.ArrivalMetrics()
    store.append(rows.filter("video_id = 'a'"), ("created_at",))
    feed = Feed(spark, f"{tmp_path}/in", rows.schema)

    def run():
        drain(arrivals.append_into(feed.stream(), store, f"{tmp_path}/c", ("created_at",), metrics))
        return metrics.taken()

    spark.streams.addListener(metrics)
    try:
        keyless = rows.withColumn("video_id", F.when(F.col("video_id") == "a", "c"))
        rows.unionAll(rows).unionAll(keyless).coalesce(1).write.parquet(feed.path)
        assert run() == [(0, 6, 2, 1, 3)]
        assert run() == []
    finally:
        spark.streams.removeListener(metrics)
