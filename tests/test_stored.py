import json
import os
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from cliptrack import ConcurrentCommit, Inventory, Workflow
from cliptrack.operators.append import fresh_rows
from cliptrack.operators.selection import with_id
from cliptrack.plans.edit import apply_edit_results
from cliptrack.plans.reports import orphans, status_census, stuck_rows
from cliptrack.schema import INVENTORY
from cliptrack.session import scratch_root
from cliptrack.sources.inventory import repeat_on_conflict
from cliptrack.sources.listings import (
    as_inventory,
    read_downloads,
    read_edit_results,
    read_inventory_file,
    read_listings,
)
from cliptrack.sources.media import list_media, read_manifest
from helpers import (
    T0,
    at,
    by_id,
    downloads,
    files,
    ids,
    inventory,
    item,
    listings,
    patches,
    results,
    utc,
)

ORDER = ("created_at", "title")


@pytest.fixture
def stored(spark, tmp_path):
    return Inventory(spark, f"file:{tmp_path}/inventory")


def statuses(rows):
    return {v: r.status_fb for v, r in by_id(rows).items()}


def test_create_once(stored):
    assert stored.latest() is None
    with pytest.raises(FileNotFoundError):
        stored.read()
    assert stored.latest() is None
    assert stored.create() == 0
    assert stored.create() == 0
    rows = stored.read()
    assert rows.isEmpty()
    assert [(f.name, f.dataType) for f in rows.schema] == [
        (f.name, f.dataType) for f in INVENTORY
    ]


def test_append_and_read_back(spark, stored):
    first = stored.append(inventory(spark, item("a"), item("b", "odd"), item("c", "")), ORDER)
    assert first == (3, 1)
    again = stored.append(inventory(spark, item("a", "posted"), item("d", None)), ORDER)
    assert again == (1, 2)
    assert statuses(stored.read()) == {"a": "pending", "b": "odd", "c": "", "d": None}
    assert statuses(stored.read(1)) == {"a": "pending", "b": "odd", "c": ""}
    assert utc(stored.read().filter("video_id = 'a'").first().created_at) == T0
    assert statuses(stored.read(statuses=("pending", "odd"))) == {"a": "pending", "b": "odd"}
    assert statuses(stored.read(statuses=("",))) == {"c": ""}


def test_append_of_nothing_makes_no_version(spark, stored):
    stored.append(inventory(spark, item("a")), ORDER)
    assert stored.append(inventory(spark, item("a")), ORDER) == (0, 1)
    assert stored.append(inventory(spark), ORDER) == (0, 1)


def test_reading_some_states_filters_in_the_files(spark, stored):
    stored.append(inventory(spark, item("a"), item("b", "posted")), ORDER)
    plan = stored.read(statuses=("pending",))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "EqualTo(status_fb,pending)" in plan


def test_states_after_marks(spark, stored):
    stored.append(inventory(spark, item("a"), item("b"), item("c", "ready")), ORDER)
    stored.set_values(ids(spark, "a"), {"status_fb": "posted"}, at(1))
    stored.set_values(ids(spark, "b"), {"title": "x"}, at(1))
    stored.set_values(ids(spark, "c", "ghost"), {"status_fb": "strange"}, at(1))
    assert statuses(stored.read(statuses=("pending",))) == {"b": "pending"}
    assert statuses(stored.read(statuses=("posted", "ready"))) == {"a": "posted"}
    assert statuses(stored.read(statuses=("strange", "pending"))) == {
        "b": "pending",
        "c": "strange",
    }
    stored.set_values(ids(spark, "c"), {"status_fb": None}, at(2))
    assert statuses(stored.read()) == {"a": "posted", "b": "pending", "c": None}
    assert statuses(stored.read(statuses=("posted",))) == {"a": "posted"}


def test_patches_apply(spark, stored):
    stored.append(inventory(spark, item("a"), item("b"), item("c")), ORDER)
    one = stored.set_values(ids(spark, "a", "b", "ghost"), {"status_fb": "posted"}, at(1))
    assert one == (2, 1, 2)
    two = stored.set_values(ids(spark, "b"), {"status_fb": "failed", "title": None}, at(2))
    assert two == (1, 0, 3)
    want = {"a": "posted", "b": "failed", "c": "pending"}
    assert statuses(stored.read()) == want
    assert statuses(stored.read(2)) == {"a": "posted", "b": "posted", "c": "pending"}
    assert statuses(stored.read(statuses=("posted",))) == {"a": "posted"}
    row = by_id(stored.read())["b"]
    assert row.title is None and utc(row.updated_at) == at(2) and utc(row.created_at) == at(0)
    log = stored.transitions().select("video_id", "version", "set_cols").collect()
    assert sorted((r.video_id, r.version, sorted(r.set_cols)) for r in log) == [
        ("a", 2, ["status_fb"]),
        ("b", 2, ["status_fb"]),
        ("b", 3, ["status_fb", "title"]),
    ]
    assert [r.video_id for r in stored.transitions(unmatched=True).collect()] == ["ghost"]


def test_plans_do_not_grow_with_commits(spark, stored):
    def shape(rows):
        text = rows._jdf.queryExecution().executedPlan().toString()
        return text.count("FileScan"), text.count("Join"), text.count("Exchange")

    def offered(rows):
        return shape(fresh_rows(stored.read(), rows, ORDER))

    more = inventory(spark, *(item(f"x{i}") for i in range(40)))
    stored.append(inventory(spark, *(item(f"v{i}") for i in range(40))), ORDER)
    first = offered(more)
    for n in range(5):
        stored.append(inventory(spark, *(item(f"w{n}-{i}", "ready") for i in range(10))), ORDER)
        stored.set_values([f"v{n}", f"w{n}-3"], {"status_fb": "posted"}, at(n))
    assert shape(stored.read()) == shape(stored.read(statuses=("ready",))) == (1, 0, 0)
    assert offered(more) == first
    assert len(by_id(stored.read(statuses=("posted",)))) == 10 and stored.read().count() == 90


def test_another_session_goes_on(spark, stored):
    stored.append(inventory(spark, item("a"), item("b", "ready")), ORDER)
    stored.set_values(["a"], {"status_fb": "posted"}, at(1))
    again = Inventory(spark.newSession(), stored.root)
    assert statuses(again.read()) == {"a": "posted", "b": "ready"}
    again.append(inventory(spark, item("a"), item("c")), ORDER)
    assert statuses(again.read(statuses=("pending",))) == {"c": "pending"}


def test_few_ids_are_looked_up_by_filter(spark, stored):
    stored.append(inventory(spark, *(item(f"v{i}") for i in range(50))), ORDER)
    done = stored.set_values(["v3", "v4", "v3", "ghost"], {"status_fb": "posted"}, at(1))
    assert (done.matched, done.unmatched) == (2, 1)
    assert {v for v, s in statuses(stored.read()).items() if s == "posted"} == {"v3", "v4"}
    assert stored.set_values([], {"status_fb": "posted"}, at(1)) == (0, 0, 2)
    plan = with_id(stored.read(1), "v7")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(video_id,v7)" in plan
    patched = with_id(stored.read(), "v3")
    text = patched._jdf.queryExecution().executedPlan().toString()
    assert text.count("EqualTo(video_id,v3)") == 1
    assert patched.first().status_fb == "posted"


def test_patch_for_an_absent_item_does_not_wait_for_it(spark, stored):
    stored.create()
    assert stored.set_values(ids(spark, "new"), {"status_fb": "failed"}, at(1)) == (0, 1, 1)
    stored.append(inventory(spark, item("new")), ORDER)
    assert statuses(stored.read()) == {"new": "pending"}


def test_patches_are_stored_in_the_table_types(spark, stored):
    stored.append(inventory(spark, item("a")), ORDER)
    patch = spark.createDataFrame(
        [("a", 17, "kept out", ["duration", "extra"], at(1))],
        "video_id string, duration int, extra string, set_cols array<string>, at timestamp",
    )
    assert stored.patch(patch).matched == 1
    assert stored.read().first().duration == 17
    assert stored.transitions().first().set_cols == ["duration"]


def test_later_commit_wins_over_clock(spark, stored):
    stored.append(inventory(spark, item("a")), ORDER)
    stored.set_values(ids(spark, "a"), {"status_fb": "posted"}, at(9))
    stored.set_values(ids(spark, "a"), {"status_fb": "failed"}, at(1))
    assert statuses(stored.read()) == {"a": "failed"}


def test_two_writers_from_one_version(spark, stored):
    stored.append(inventory(spark, item("a")), ORDER)
    now = stored.version()
    other = Inventory(spark, stored.root)
    other.append(inventory(spark, item("b")), ORDER)
    stored.version = lambda number=None: now
    with pytest.raises(ConcurrentCommit):
        stored.append(inventory(spark, item("c")), ORDER)
    assert statuses(other.read()) == {"a": "pending", "b": "pending"}
    del stored.version
    assert stored.append(inventory(spark, item("c")), ORDER) == (1, 3)


def test_a_step_is_repeated_when_another_writer_was_first(spark, stored):
    stored.append(inventory(spark, item("a")), ORDER)
    other, tries = Inventory(spark, stored.root), []
    read = stored.version

    def interfere(number=None):
        now = read(number)
        if not tries:
            other.set_values(ids(spark, "a"), {"status_fb": "posted"}, at(1))
        tries.append(now.number)
        return now

    stored.version = interfere
    done = repeat_on_conflict(
        lambda: stored.patch(
            patches(
                spark, {"video_id": "a", "title": "x", "set_cols": ["title"], "at": at(2)}
            )
        )
    )
    assert done.version == 3 and tries == [1, 2]
    row = by_id(other.read())["a"]
    assert (row.status_fb, row.title) == ("posted", "x")


def test_crash_before_the_commit_is_invisible(spark, stored, monkeypatch):
    stored.append(inventory(spark, item("a")), ORDER)

    def crash(version):
        raise RuntimeError("lost")

    monkeypatch.setattr(stored, "_commit", crash)
    with pytest.raises(RuntimeError):
        stored.append(inventory(spark, item("b")), ORDER)
    with pytest.raises(RuntimeError):
        stored.set_values(ids(spark, "a"), {"status_fb": "posted"})
    monkeypatch.undo()
    assert statuses(stored.read()) == {"a": "pending"}
    assert stored.latest() == 1


def test_numbered_batches_are_taken_once(spark, stored):
    stored.create()
    assert stored.append(inventory(spark, item("a")), ORDER, "w", 0) == (1, 1)
    assert stored.append(inventory(spark, item("b")), ORDER, "w", 0) == (0, 1)
    assert stored.append(inventory(spark, item("b")), ORDER, "v", 0) == (1, 2)
    patch = patches(
        spark, {"video_id": "a", "status_fb": "x", "set_cols": ["status_fb"], "at": at(1)}
    )
    assert stored.patch(patch, writer="p", number=4).matched == 1
    assert stored.patch(patch, writer="p", number=4).matched == 0
    assert stored.patch(patch, writer="p", number=3).matched == 0


def test_corrupt_file_is_an_error(spark, tmp_path):
    broken = tmp_path / "broken.parquet"
    broken.write_bytes(b"not parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        read_inventory_file(spark, str(broken)).collect()


def test_plain_inventory_file(spark, tmp_path):
    rows = inventory(spark, item("a"), item("b"))
    zoned, naive = str(tmp_path / "zoned"), str(tmp_path / "naive")
    rows.write.parquet(zoned)
    rows.withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in ("created_at", "updated_at")}
    ).write.parquet(naive)
    for path in (zoned, naive):
        read = read_inventory_file(spark, path)
        assert utc(read.first().created_at) == T0
        assert dict(read.dtypes)["created_at"] == "timestamp"
    with pytest.raises(ValueError):
        as_inventory(rows.drop("title"))
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        with pytest.raises(ValueError, match="UTC"):
            read_inventory_file(spark, naive)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_media_listing(spark, tmp_path):
    for name in ("raw/a.mp4", "raw/b c.mp4", "processed/x/y.mp4"):
        path = tmp_path / "videos" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"data")
    for base in (f"{tmp_path}", f"{tmp_path}/", f"file:{tmp_path}", f"file://{tmp_path}"):
        media = list_media(spark, base, "videos/raw", "videos/processed")
        assert sorted(r.path for r in media.collect()) == [
            "videos/processed/x/y.mp4",
            "videos/raw/a.mp4",
            "videos/raw/b c.mp4",
        ]
    assert {r.length for r in media.collect()} == {4}
    plan = media._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]
    media.write.parquet(str(tmp_path / "manifest"))
    assert read_manifest(spark, str(tmp_path / "manifest")).count() == 3


def lines(path, *records):
    path.write_text("\n".join(json.dumps(r) for r in records))
    return str(path)


def test_whole_workflow(spark, stored, tmp_path):
    """Listing to posted, with everything handed over as files."""
    flow = Workflow(stored)
    found = files(spark, "videos/raw/v1.mp4", "videos/raw/v2.mp4")
    assert flow.take_next(found) is None

    listed = lines(
        tmp_path / "listings.json",
        {"source_url": "s", "id": "s", "entries": [{"id": "v1", "url": "u1"}, {"id": "v2", "url": "u2"}]},
        {"source_url": "t", "id": "v3", "webpage_url": "p3"},
    )
    read = read_listings(spark, listed)
    wanted = flow.to_download(read)
    assert sorted(r.video_id for r in wanted.collect()) == ["v1", "v3"]
    got = lines(
        tmp_path / "downloads.json",
        {"source_url": "s", "entry_id": "v1", "id": "v1", "title": "One", "duration": 9.7},
        {"source_url": "t", "entry_id": "v3", "error": "403"},
    )
    appended, failed = flow.ingest(wanted, read_downloads(spark, got), found, at(0))
    assert appended.inserted == 1 and (failed.matched, failed.unmatched) == (0, 1)
    assert by_id(stored.read())["v1"].path_local == "videos/raw/v1.mp4"

    # The next round goes on to the next entry of the source.
    assert sorted(r.video_id for r in flow.to_download(read).collect()) == ["v2", "v3"]

    edits = flow.plan_edits(found, seed=3, at=at(1)).collect()
    assert [r.video_id for r in edits] == ["v1"]
    rendered = lines(
        tmp_path / "results.json",
        {"video_id": "v1", "path_local": edits[0].output_path, "ok": True},
    )
    assert flow.record_edits(read_edit_results(spark, rendered), at(2)).matched == 1
    row = by_id(stored.read())["v1"]
    assert row.status_fb == "ready" and row.path_local.startswith("videos/processed/v1_")

    done = files(spark, edits[0].output_path)
    assert flow.take_next(done) is None
    chosen = flow.take_next(done, statuses=("ready",))
    assert tuple(chosen) == ("v1", edits[0].output_path)
    assert flow.mark_posted(["v1"], at(3)).matched == 1
    assert flow.mark_posted(["nobody"]).unmatched == 1
    assert statuses(stored.read()) == {"v1": "posted"}
    assert flow.mark_failed(ids(spark, "v1"), at(4)).matched == 1
    row = by_id(stored.read())["v1"]
    assert row.status_fb == "failed" and utc(row.updated_at) == at(4)


def test_failure_at_one_source_does_not_spoil_success_at_another(spark, stored):
    flow = Workflow(stored)
    listed = listings(
        spark,
        *({"source_url": s, "entries": [{"id": "v", "url": "u", "webpage_url": None}]} for s in "ab"),
    )
    wanted = flow.to_download(listed)
    got = downloads(
        spark,
        {"source_url": "a", "entry_id": "v", "error": "403"},
        {"source_url": "b", "entry_id": "v", "title": "V"},
    )
    appended, failed = flow.ingest(wanted, got, files(spark), at(0))
    assert (appended.inserted, failed.matched, failed.unmatched) == (1, 0, 1)
    assert statuses(stored.read()) == {"v": "pending"}


def test_missing_files_fail_in_the_store(spark, stored):
    flow = Workflow(stored)
    stored.append(
        inventory(
            spark,
            item("m1", path="videos/processed/missing.mp4", minutes=0),
            item("e1", path="videos/processed/exists.mp4", minutes=1),
            item("raw", path="videos/raw/gone.mp4", minutes=2),
        ),
        ORDER,
    )
    chosen = flow.take_next(files(spark, "videos/processed/exists.mp4"), at(3))
    assert chosen.video_id == "e1"
    assert statuses(stored.read()) == {"m1": "failed", "e1": "pending", "raw": "pending"}
    none = flow.plan_edits(files(spark), n=None, at=at(4))
    assert none.isEmpty()
    assert statuses(stored.read()) == {"m1": "failed", "e1": "failed", "raw": "failed"}


def test_a_decision_is_made_anew_when_another_writer_was_first(spark, stored, monkeypatch):
    """An item that is marked between the decision and the commit keeps its mark."""
    flow, other = Workflow(stored), Inventory(spark, stored.root)
    rows = [item(f"v{i}", path=f"videos/processed/v{i}.mp4", minutes=i) for i in range(3)]
    stored.append(inventory(spark, *rows), ORDER)
    found = files(spark, "videos/processed/v2.mp4")
    patch, done = stored.patch, []

    def interfere(*args, **options):
        if not done:
            done.append(other.set_values(["v0"], {"status_fb": "posted"}, at(5)).matched)
        return patch(*args, **options)

    monkeypatch.setattr(stored, "patch", interfere)
    assert flow.take_next(found, at(9)).video_id == "v2"
    assert statuses(stored.read()) == {"v0": "posted", "v1": "failed", "v2": "pending"}
    done.clear()
    stored.append(inventory(spark, item("v3", minutes=0), item("v4", minutes=1)), ORDER)
    edits = flow.plan_edits(files(spark), n=None, at=at(10))
    assert edits.isEmpty()
    assert statuses(stored.read())["v0"] == "posted"


def test_folders_of_steps_without_a_commit_are_not_read(spark, stored, monkeypatch):
    stored.append(inventory(spark, item("a")), ORDER)
    root = Path(stored.root.removeprefix("file:"))
    assert stored.append(inventory(spark, item("a")), ORDER).inserted == 0
    assert stored.set_values([], {"status_fb": "x"}) == (0, 0, 1)
    assert len(list((root / "rows").glob("batch=*"))) == 1 and not (root / "changes").exists()
    now = stored.version()
    other = Inventory(spark, stored.root)
    other.append(inventory(spark, item("b")), ORDER)
    monkeypatch.setattr(stored, "version", lambda number=None: now)
    with pytest.raises(ConcurrentCommit):
        stored.append(inventory(spark, item("c")), ORDER)
    ghost = {"video_id": "ghost", "status_fb": "x", "set_cols": ["status_fb"], "at": at(1)}
    with pytest.raises(ConcurrentCommit):
        stored.patch(patches(spark, ghost))
    with pytest.raises(ConcurrentCommit):
        stored.patch(patches(spark, {"video_id": "a", "set_cols": [], "at": at(1)}), base=0)
    assert statuses(other.read()) == {"a": "pending", "b": "pending"}
    assert other.transitions(unmatched=True).isEmpty() and other.transitions().isEmpty()


def test_of_two_commits_at_one_moment_the_older_file_counts(spark, stored):
    stored.append(inventory(spark, item("a")), ORDER)
    folder = Path(stored.root.removeprefix("file:")) / "versions" / "number=1"
    mine = next(folder.glob("part-*"))
    other = json.loads(mine.read_text()) | {"rows": "lost"}
    (folder / "part-other.json").write_text(json.dumps(other))
    os.utime(folder / "part-other.json", (2**31, 2**31))
    assert statuses(stored.read()) == {"a": "pending"}
    found = stored.version()
    os.utime(mine, (2**31 + 9, 2**31 + 9))
    assert stored.version().rows == "lost" != found.rows


def test_bad_input_is_an_error(spark, tmp_path):
    good = json.dumps({"source_url": "s", "id": "v", "url": "u"})
    for read, text in (
        (read_listings, good + "\n" + good[:-9]),
        (read_downloads, json.dumps({"source_url": "s", "entry_id": "v", "duration": "12.5"})),
        (read_edit_results, json.dumps({"video_id": "v", "ok": "yes"})),
    ):
        path = tmp_path / read.__name__
        path.write_text(text)
        with pytest.raises(Exception, match="(?i)malformed"):
            read(spark, str(path)).collect()


def test_repeated_edit_results_are_one(spark):
    table = inventory(spark, item("a"), item("b"), item("c"))
    done = results(
        spark,
        {"video_id": "a", "path_local": "x", "ok": False},
        {"video_id": "a", "path_local": "videos/processed/a1.mp4", "ok": True},
        {"video_id": "a", "path_local": "videos/processed/a2.mp4", "ok": True},
        {"video_id": "b", "ok": False},
        {"video_id": "b", "ok": None},
        {"video_id": "ghost", "ok": True, "path_local": "g"},
    )
    after, lost = apply_edit_results(table, done, at(1))
    assert after.count() == 3
    assert {v: (r.status_fb, r.path_local) for v, r in by_id(after).items()} == {
        "a": ("ready", "videos/processed/a2.mp4"),
        "b": ("failed", "videos/raw/dusk.mov"),
        "c": ("pending", "videos/raw/dusk.mov"),
    }
    assert [r.video_id for r in lost.collect()] == ["ghost"]


def test_failed_edit(spark, stored):
    flow = Workflow(stored)
    stored.append(inventory(spark, item("lost-1")), ORDER)
    flow.record_edits(results(spark, {"video_id": "lost-1", "ok": False}), at(1))
    row = by_id(stored.read())["lost-1"]
    assert (row.status_fb, row.path_local) == ("failed", "videos/raw/dusk.mov")


def test_reports(spark):
    table = inventory(
        spark,
        item("a", path=""),
        item("b", path=None),
        item("c", "ready", path="videos/processed/c.mp4"),
        item("d", "posted", path="videos/processed/d.mp4"),
        item("e"),
    )
    assert {r.status_fb: r["items"] for r in status_census(table).collect()} == {
        "pending": 3,
        "ready": 1,
        "posted": 1,
    }
    assert {(r.video_id, r.reason) for r in stuck_rows(table).collect()} == {
        ("a", "no file"),
        ("b", "no file"),
        ("c", "ready not accepted"),
    }
    found = files(spark, "videos/processed/c.mp4", "videos/raw/extra.mp4")
    assert {tuple(r) for r in orphans(table, found).collect()} == {
        ("videos/raw/extra.mp4", "file without row"),
        ("videos/processed/d.mp4", "row without file"),
        ("videos/raw/dusk.mov", "row without file"),
    }


class Session:
    """Just enough of a session to ask for its settings."""

    def __init__(self, master, **settings):
        self.sparkContext = SimpleNamespace(master=master)
        self.conf = settings


def test_scratch_folder_is_the_one_the_session_names(tmp_path):
    named = Session("yarn", **{"spark.checkpoint.dir": "hdfs://shared/folder/"})
    assert scratch_root(named) == "hdfs://shared/folder"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(Session("yarn"))
    local = Session("local[2]")
    assert scratch_root(local) == scratch_root(local)


def test_orphans_take_one_aggregate_and_no_join(spark):
    """Joins would sort both sides; a path that is listed twice is found twice."""
    table = inventory(spark, item("a", path_local="videos/raw/a.mp4"), item("b", path_local="videos/raw/b.mp4"))
    found = spark.createDataFrame(
        [("videos/raw/a.mp4",), ("videos/raw/x.mp4",), ("videos/raw/x.mp4",), (None,)], "path string"
    )
    result = orphans(table.unionAll(table), found)
    assert sorted(result.collect(), key=str) == sorted(
        [
            (None, "file without row"),
            ("videos/raw/b.mp4", "row without file"),
            ("videos/raw/x.mp4", "file without row"),
            ("videos/raw/x.mp4", "file without row"),
        ],
        key=str,
    )
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Sort" not in plan
