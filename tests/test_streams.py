import random

import pytest
from pyspark.sql import functions as F

from cliptrack import Inventory
from cliptrack.streaming.arrivals import append_into
from cliptrack.streaming.transitions import ARRIVAL, EVENT_TIME, fold_into, latest_status
from helpers import at, by_id, inventory, item, utc

EVENTS = "video_id string, status_fb string, ts timestamp, event_id bigint"
STATES = ["pending", "ready", "failed", "posted"]


@pytest.fixture
def stored(spark, tmp_path):
    made = Inventory(spark, f"file:{tmp_path}/inventory")
    made.append(inventory(spark, *(item(str(i)) for i in range(8))), ("created_at",))
    return made


def drop_file(spark, folder, name, events):
    """One file per call: with one file per trigger, one micro-batch each."""
    rows = spark.createDataFrame(events, EVENTS).coalesce(1)
    rows.write.mode("append").parquet(f"{folder}/{name}")


def run(spark, stored, tmp_path, by, checkpoint="checkpoint"):
    events = (
        spark.readStream.schema(EVENTS)
        .option("maxFilesPerTrigger", 1)
        .option("recursiveFileLookup", True)
        .parquet(f"{tmp_path}/events")
    )
    writer = fold_into(events, stored, f"{tmp_path}/{checkpoint}", by)
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def test_stream_equals_batch(spark, stored, tmp_path):
    draw = random.Random(2)
    events = [
        # One item holds a third of the events, some items are unknown.
        (
            "0" if draw.random() < 0.33 else str(draw.randint(0, 10)),
            draw.choice(STATES),
            at(draw.randint(0, 50)),
            n,
        )
        for n in range(300)
    ]
    for part in range(3):
        drop_file(spark, f"{tmp_path}/events", f"f{part}", events[part::3])
    run(spark, stored, tmp_path, EVENT_TIME)
    want = by_id(latest_status(spark.createDataFrame(events, EVENTS)))
    got = by_id(stored.read())
    assert len(got) == 8 and set(want) > set(got)
    for video_id, row in got.items():
        assert row.status_fb == want[video_id].status_fb
        assert row.updated_at == want[video_id].ts
    lost = stored.transitions(unmatched=True).select("video_id").distinct()
    assert {r.video_id for r in lost.collect()} == set(want) - set(got)
    assert list((tmp_path / "inventory" / "incoming").glob("[!.]*")) == []


@pytest.mark.parametrize("by, status", [(EVENT_TIME, "posted"), (ARRIVAL, "failed")])
def test_late_event(spark, stored, tmp_path, by, status):
    drop_file(spark, f"{tmp_path}/events", "a", [("1", "posted", at(9), 1)])
    run(spark, stored, tmp_path, by)
    drop_file(spark, f"{tmp_path}/events", "b", [("1", "failed", at(5), 2)])
    run(spark, stored, tmp_path, by)
    assert by_id(stored.read())["1"].status_fb == status


def test_restart_goes_on_and_repeats_nothing(spark, stored, tmp_path):
    drop_file(spark, f"{tmp_path}/events", "a", [("1", "ready", at(1), 1)])
    run(spark, stored, tmp_path, EVENT_TIME)
    version = stored.latest()
    run(spark, stored, tmp_path, EVENT_TIME)
    assert by_id(stored.read())["1"].status_fb == "ready"
    assert stored.latest() == version
    drop_file(spark, f"{tmp_path}/events", "b", [("2", "ready", at(2), 2)])
    run(spark, stored, tmp_path, EVENT_TIME)
    rows = by_id(stored.read())
    assert (rows["1"].status_fb, rows["2"].status_fb, rows["3"].status_fb) == (
        "ready",
        "ready",
        "pending",
    )
    assert utc(rows["2"].updated_at) == at(2)
    assert stored.transitions().count() == 2


def test_new_checkpoint_is_a_new_stream(spark, stored, tmp_path):
    drop_file(spark, f"{tmp_path}/events", "a", [("1", "ready", at(1), 1)])
    run(spark, stored, tmp_path, EVENT_TIME)
    drop_file(spark, f"{tmp_path}/events", "b", [("1", "failed", at(3), 2), ("2", "posted", at(2), 3)])
    run(spark, stored, tmp_path, EVENT_TIME, "another")
    rows = by_id(stored.read())
    assert (rows["1"].status_fb, rows["2"].status_fb) == ("failed", "posted")


def test_order_must_be_known(stored):
    with pytest.raises(ValueError, match="order"):
        fold_into(None, stored, "c", "guess")


def test_arrivals_keep_the_first(spark, stored, tmp_path):
    folder = f"{tmp_path}/rows"
    source = inventory(spark).schema

    def offer(name, *items):
        inventory(spark, *items).coalesce(1).write.parquet(f"{folder}/{name}")
        rows = (
            spark.readStream.schema(source)
            .option("maxFilesPerTrigger", 1)
            .option("recursiveFileLookup", True)
            .parquet(folder)
        )
        writer = append_into(rows, stored, f"{tmp_path}/check", ("created_at", "title"))
        writer.trigger(availableNow=True).start().awaitTermination()

    offer("a", item("1", title="late"), item("x", title="first", minutes=5))
    offer(
        "b",
        item("x", title="second", minutes=1),
        item("y", title="b", minutes=2),
        item("y", title="a", minutes=2),
    )
    offer("c", item("y", title="0", minutes=0), item("z"))
    rows = by_id(stored.read())
    assert rows["1"].title == "Harbour at dusk"
    assert (rows["x"].title, rows["y"].title, rows["z"].title) == ("first", "a", "Harbour at dusk")
    assert stored.read().count() == len(rows) == 11


def test_repeated_micro_batch_is_skipped(spark, stored):
    batch = inventory(spark, item("n"))
    assert stored.append(batch, ("created_at",), "rows", 3).inserted == 1
    version = stored.latest()
    assert stored.append(batch.withColumn("video_id", F.lit("m")), ("created_at",), "rows", 3).inserted == 0
    assert stored.latest() == version
