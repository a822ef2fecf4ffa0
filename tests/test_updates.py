import random

import pytest
from pyspark.sql import functions as F

from cliptrack.operators import patches as ops
from cliptrack.operators import selection
from cliptrack.plans import edit, publish
from cliptrack.schema import UPDATABLE
from helpers import at, by_id, files, ids, inventory, item, patches, results, utc


def test_update_by_id(spark):
    table = inventory(spark, item("a"), item("b", title="B"))
    after = by_id(
        ops.update_by_id(table, "b", {"status_fb": "posted", "title": None, "nope": 1}, at(3))
    )
    assert (after["b"].status_fb, after["b"].title) == ("posted", None)
    assert utc(after["b"].updated_at) == at(3) and utc(after["b"].created_at) == at(0)
    assert after["a"].asDict() == by_id(table)["a"].asDict()


def test_unknown_columns_still_touch_the_row(spark):
    table = inventory(spark, item("a"))
    after = by_id(ops.update_by_id(table, "a", {"nope": 1}, at(3)))
    assert utc(after["a"].updated_at) == at(3)
    assert after["a"].status_fb == "pending"
    assert ops.check_updates(table.columns, {"nope": 1, "title": "x"}) == ({"title": "x"}, ["nope"])


@pytest.mark.parametrize("column", ["updated_at", "video_id"])
def test_fixed_columns_cannot_be_set(spark, column):
    with pytest.raises(ValueError, match=column):
        ops.update_by_id(inventory(spark), "a", {column: "x"})


def test_update_keeps_the_types(spark):
    table = inventory(spark, item("a"))
    after = ops.update_by_id(table, "a", {"duration": "17"}, at(1))
    assert [f.dataType for f in after.schema] == [f.dataType for f in table.schema]
    assert after.first().duration == 17


def test_patches_do_not_widen_the_table(spark):
    table = inventory(spark, item("a")).withColumn("updated_at", F.col("updated_at").cast("timestamp_ntz"))
    patch = spark.createDataFrame(
        [("a", "17", ["duration"], at(1))],
        "video_id string, duration string, set_cols array<string>, at timestamp",
    )
    after = ops.apply_patches(table, patch)
    assert after.dtypes == table.dtypes
    assert after.first().duration == 17


def test_update_by_ids(spark):
    table = inventory(spark, item("a"), item("b"), item("c"))
    some = ids(spark, "a", "c", "c", None, "x")
    after = by_id(ops.update_by_ids(table, some, {"status_fb": "failed"}, at(1)))
    assert {v: r.status_fb for v, r in after.items()} == {
        "a": "failed",
        "b": "pending",
        "c": "failed",
    }
    assert utc(after["b"].updated_at) == at(0) and utc(after["c"].updated_at) == at(1)


def test_null_id_is_never_updated(spark):
    table = spark.createDataFrame(
        [(None, "pending", at(0)), ("a", "pending", at(0))],
        "video_id string, status_fb string, updated_at timestamp",
    )
    after = ops.update_by_ids(table, ids(spark, "a", None), {"status_fb": "failed"}, at(1))
    assert {(r.video_id, r.status_fb) for r in after.collect()} == {
        (None, "pending"),
        ("a", "failed"),
    }


def test_null_is_a_value_and_absence_is_not(spark):
    table = inventory(spark, item("a"), item("b"))
    patch = patches(
        spark,
        {"video_id": "a", "title": None, "set_cols": ["title"], "at": at(1)},
        {"video_id": "b", "title": None, "set_cols": ["status_fb"], "status_fb": "x", "at": at(1)},
    )
    after = by_id(ops.apply_patches(table, patch))
    assert (after["a"].title, after["a"].status_fb) == (None, "pending")
    assert (after["b"].title, after["b"].status_fb) == ("Harbour at dusk", "x")


def test_fold_equals_updates_one_by_one(spark):
    draw = random.Random(11)
    names = [str(i) for i in range(12)]
    kinds = {f: "status title path url".split() for f in ("status_fb", "title", "path_local")}
    log = []
    for n in range(400):
        # One item holds most of the patches.
        target = "0" if draw.random() < 0.4 else draw.choice(names)
        chosen = draw.sample(sorted(kinds) + ["duration"], draw.randint(0, 3))
        values = {
            c: draw.choice([None, n if c == "duration" else f"{c}{n}"]) for c in chosen
        }
        log.append((target, values, at(n)))
    want = {v: item(v) for v in names[:10]}
    for target, values, moment in log:
        if target in want:
            want[target].update(values, updated_at=moment)
    records = [
        {"video_id": t, **values, "set_cols": sorted(values), "at": moment}
        for t, values, moment in log
    ]
    draw.shuffle(records)
    folded = ops.fold_patches(patches(spark, *records).repartition(9))
    table = inventory(spark, *(item(v) for v in names[:10]))
    got = by_id(ops.apply_patches(table, folded))
    assert len(got) == 10
    for video_id, row in got.items():
        for column in UPDATABLE[:5]:
            assert row[column] == want[video_id][column], (video_id, column)
        assert utc(row.updated_at) == want[video_id]["updated_at"]
    assert {r.video_id for r in ops.unmatched(folded, table).collect()} == {"10", "11"}


def test_marks(spark):
    table = inventory(spark, item("a", "ready"), item("b", "posted"))
    done = publish.mark(table, ids(spark, "a", "ghost"), "posted", at(1))
    assert {v: r.status_fb for v, r in by_id(done.inventory).items()} == {
        "a": "posted",
        "b": "posted",
    }
    assert [r.video_id for r in done.unmatched.collect()] == ["ghost"]
    # No transition is refused.
    back = publish.mark(done.inventory, ids(spark, "a"), "failed", at(2))
    row = by_id(back.inventory)["a"]
    assert row.status_fb == "failed" and utc(row.updated_at) == at(2)


def test_audit_lists_what_took_effect(spark):
    table = inventory(spark, item("a"))
    patch = patches(
        spark,
        {"video_id": "a", "status_fb": "ready", "set_cols": ["status_fb"], "at": at(1)},
        {"video_id": "x", "status_fb": "ready", "set_cols": ["status_fb"], "at": at(1)},
    )
    rows = ops.transitions(patch, table, "run-9").collect()
    assert [(r.video_id, r.changes, r.run_id) for r in rows] == [("a", ["status_fb"], "run-9")]


def test_selection_rules(spark):
    table = inventory(
        spark,
        item("late", minutes=9),
        item("no date", minutes=None),
        item("empty", path="", minutes=0),
        item("null", path=None, minutes=0),
        item("done", "ready", minutes=0),
        item("b", path="videos/processed/b.mp4", minutes=1),
        item("a", path="unprocessed.mp4", minutes=1),
        item("regex", path="videos/process.d/b.mp4", minutes=1),
    )
    first = selection.first_rows(selection.editable(table), 99).collect()
    assert [r.video_id for r in first] == ["a", "b", "regex", "late", "no date"]
    assert selection.first_rows(selection.editable(table)).first().video_id == "a"
    assert selection.first_rows(selection.editable(table), None).count() == 5
    raw = selection.editable(table, exclude_processed=True)
    assert {r.video_id for r in raw.collect()} == {"late", "no date", "regex"}
    assert selection.next_publishable(table).collect() == [("a", "unprocessed.mp4")]
    assert selection.next_publishable(table, statuses=("ready",)).isEmpty()
    assert selection.exists(table, F.col("video_id") == "a")
    assert not selection.exists(table, F.col("video_id") == "z")
    assert selection.any_match(inventory(spark), F.lit(True)).first()[0] is False
    assert selection.any_match(table, F.lit(None).cast("boolean")).first()[0] is False
    assert selection.any_match(table, F.col("path_local").isNull()).first()[0] is True


def swept(table, found, **options):
    done = publish.next_to_publish(table, found, at(9), **options)
    chosen = [tuple(r) for r in done.chosen.collect()]
    return chosen, sorted(r.video_id for r in done.failures.collect())


def processed(video_id, minutes, **more):
    return item(video_id, path=f"videos/processed/{video_id}.mp4", minutes=minutes, **more)


def test_next_file_is_returned(spark):
    table = inventory(spark, processed("p1", 0))
    assert swept(table, files(spark, "videos/processed/p1.mp4")) == (
        [("p1", "videos/processed/p1.mp4")],
        [],
    )


def test_missing_files_before_the_hit_fail_and_later_ones_stay(spark):
    table = inventory(
        spark,
        processed("m2", 2),
        processed("e1", 3),
        processed("m1", 1),
        processed("m3", 4),
        processed("e2", 5),
        processed("undated", None),
        item("other", path="videos/raw/x.mp4", minutes=0),
        processed("gone", 0, status="ready"),
    )
    found = files(spark, "videos/processed/e1.mp4", "videos/processed/e2.mp4")
    assert swept(table, found) == ([("e1", "videos/processed/e1.mp4")], ["m1", "m2"])


def test_all_missing_all_fail(spark):
    table = inventory(spark, processed("m1", 1), processed("m2", None))
    assert swept(table, files(spark)) == ([], ["m1", "m2"])


def test_nothing_to_publish(spark):
    assert swept(inventory(spark), files(spark, "x")) == ([], [])
    assert swept(inventory(spark, item("a")), files(spark, "videos/raw/dusk.mov")) == ([], [])


def test_statuses_are_a_choice(spark):
    table = inventory(spark, processed("r", 1, status="ready"), processed("m", 0))
    found = files(spark, "videos/processed/r.mp4")
    assert swept(table, found, statuses=("ready",)) == ([("r", "videos/processed/r.mp4")], [])


@pytest.mark.parametrize("seed", range(4))
def test_sweep_equals_a_row_loop(spark, seed):
    draw = random.Random(seed)
    rows = []
    for n in range(200):
        minutes = None if draw.random() < 0.1 else draw.randint(0, 30)
        rows.append(processed(str(n), minutes, status=draw.choice(["pending", "ready"])))
    share = (0.0, 0.02, 0.1, 0.9)[seed]
    paths = [r["path_local"] for r in rows if draw.random() < share]
    order = sorted(
        (r for r in rows if r["status_fb"] == "pending"),
        key=lambda r: (r["created_at"] is None, r["created_at"] or at(0), r["video_id"]),
    )
    chosen, failed = [], []
    for row in order:
        if row["path_local"] in paths:
            chosen.append((row["video_id"], row["path_local"]))
            break
        failed.append(row["video_id"])
    table = inventory(spark, *rows).repartition(5)
    assert swept(table, files(spark, *paths)) == (chosen, sorted(failed))


def test_edit_planning(spark):
    table = inventory(
        spark,
        item("vid1", path="videos/raw/one.mp4", minutes=1),
        item("vid0", path="videos/raw/gone.mp4", minutes=0),
        item("vid2", path="videos/raw/two.mp4", minutes=2),
        item("vid3", "ready", minutes=0),
    )
    found = files(spark, "videos/raw/one.mp4", "videos/raw/two.mp4")
    oldest = edit.plan_edits(table, found, 1, seed=1, at=at(0))
    assert oldest.edits.isEmpty()
    assert [(r.video_id, r.status_fb) for r in oldest.failures.collect()] == [("vid0", "failed")]
    sizes = spark.createDataFrame(
        [("vid1", 1920, 1080)], "video_id string, width int, height int"
    )
    for seed in range(6):
        plan = edit.plan_edits(table, found, 2, seed=seed, at=at(0), sizes=sizes)
        rows = plan.edits.collect()
        assert [r.video_id for r in rows] == ["vid1"]
        row = rows[0]
        assert row.output_path.startswith("videos/processed/one_20250101000000_")
        assert 2 <= len(row.edits) <= 4
        assert (row.crop is not None) == ("zoom" in row.edits)
        if row.crop:
            assert tuple(row.crop) == (96, 54, 1824, 1026)
    everything = edit.plan_edits(table, found, None, seed=1, at=at(0))
    assert {r.video_id for r in everything.edits.collect()} == {"vid1", "vid2"}


def test_two_rows_may_share_a_file(spark):
    table = inventory(spark, item("a"), item("b"))
    plan = edit.plan_edits(table, files(spark, "videos/raw/dusk.mov"), None)
    assert sorted(r.video_id for r in plan.edits.collect()) == ["a", "b"]
    assert plan.failures.isEmpty()


def test_a_file_listed_twice_counts_once(spark):
    table = inventory(spark, item("a"), item("b", path="videos/raw/gone.mp4"))
    found = files(spark, *["videos/raw/dusk.mov"] * 3)
    plan = edit.plan_edits(table, found, None)
    assert [r.video_id for r in plan.edits.collect()] == ["a"]
    assert [r.video_id for r in plan.failures.collect()] == ["b"]


def test_edit_results(spark):
    table = inventory(spark, item("a"), item("b"), item("c"))
    done = results(
        spark,
        {"video_id": "a", "path_local": "videos/processed/a.mp4", "ok": True},
        {"video_id": "b", "path_local": "videos/processed/b.mp4", "ok": False},
        {"video_id": "c", "path_local": "x", "ok": None},
    )
    after = by_id(ops.apply_patches(table, edit.edit_patches(done, at(2))))
    assert {v: (r.status_fb, r.path_local) for v, r in after.items()} == {
        "a": ("ready", "videos/processed/a.mp4"),
        "b": ("failed", "videos/raw/dusk.mov"),
        "c": ("failed", "videos/raw/dusk.mov"),
    }


def test_nothing_to_edit(spark):
    for table in (inventory(spark), inventory(spark, item("quay-4", "ready"))):
        plan = edit.plan_edits(table, files(spark, "videos/raw/dusk.mov"))
        assert plan.edits.isEmpty() and plan.failures.isEmpty()
