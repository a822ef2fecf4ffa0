"""States over time, changed files and broken lines, against plain Python."""

import random
from bisect import bisect_right
from collections import defaultdict

import pytest

from cliptrack.operators import history
from cliptrack.operators.files import manifest_changes, recheck
from cliptrack.schema import DOWNLOAD, LISTING
from cliptrack.sources.listings import read_lines
from helpers import at, inventory, item, utc

CHANGE = "video_id string, ts timestamp, event_id long, status_fb string"


def some_changes(rng, n, hot):
    """A third of the changes are those of one item; some share a moment."""
    return [
        ("hot" if rng.random() < hot else f"v{rng.randrange(9)}", at(rng.randrange(300)), i, rng.choice("prfx"))
        for i in range(n)
    ]


def by_item(rows):
    found = defaultdict(list)
    for video, ts, event, status in rows:
        found[video].append((ts, event, status))
    return {v: sorted(rows) for v, rows in found.items()}


@pytest.mark.parametrize("seconds", [60, 3600, 10**6])
def test_status_at_any_moment(spark, seconds):
    rng = random.Random(4)
    rows = some_changes(rng, 400, 0.4)
    asked = [(rng.choice(["hot", "v1", "v2", "never", None]), at(rng.randrange(-5, 310)), i) for i in range(300)]
    asked += [("hot", None, 900), asked[0]]
    moments = spark.createDataFrame(asked, "video_id string, at timestamp, n long")
    got = history.status_at(spark.createDataFrame(rows, CHANGE), moments, seconds).collect()
    items = by_item(rows)
    want = []
    for video, moment, n in asked:
        seen = [e for e in items.get(video, []) if moment is not None and e[0] <= moment]
        want.append((video, moment, n, seen[-1][2] if seen else None, seen[-1][0] if seen else None))
    found = [(r.video_id, r.at and utc(r.at), r.n, r.status_fb, r.since and utc(r.since)) for r in got]
    assert sorted(found, key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("seconds", [60, 10**6])
def test_time_in_state(spark, seconds):
    rows = some_changes(random.Random(5), 300, 0.4)
    spent, visits = defaultdict(float), defaultdict(int)
    for video, events in by_item(rows).items():
        for (ts, _, status), after in zip(events, [*events[1:], None]):
            visits[video, status] += 1
            spent[video, status] += (after[0] - ts).total_seconds() if after else 0
    got = history.time_in_state(spark.createDataFrame(rows, CHANGE), seconds).collect()
    assert {(r.video_id, r.status_fb): (r.visits, r.seconds) for r in got} == {
        k: (visits[k], spent[k]) for k in visits
    }


def test_stuck_since(spark):
    rows = some_changes(random.Random(6), 300, 0.4) + [("one", at(5), 1, None), ("one", at(6), 2, None)]
    want = {}
    for video, events in by_item([(v, t, e, s or "") for v, t, e, s in rows]).items():
        run = [e for e in events]
        while len(run) > 1 and any(e[2] != run[-1][2] for e in run):
            run = run[1:] if all(e[2] == run[-1][2] for e in run[1:]) else run[1:]
        want[video] = (run[-1][2] or None, run[0][0])
    got = history.stuck_since(spark.createDataFrame(rows, CHANGE)).collect()
    assert {r.video_id: (r.status_fb, utc(r.since)) for r in got} == want


def test_windows_see_one_slice_of_a_hot_item(spark):
    rows = [("hot", at(i), i, "p") for i in range(4000)] + [(f"v{i}", at(i), i, "r") for i in range(100)]
    df = spark.createDataFrame(rows, CHANGE)
    counts = df.groupBy("video_id", history._slice("ts", 3600)).count().agg({"count": "max"}).first()[0]
    assert counts == 60
    plan = history.intervals(df)._jdf.queryExecution().executedPlan().toString()
    assert "slice" in plan and plan.count("Window") >= 2


# -- changed files -------------------------------------------------------------------------

FILE = "path string, length long, modified timestamp"


def test_changes_between_two_manifests(spark):
    old = [("same", 1, at(1)), ("longer", 1, at(1)), ("touched", 1, at(1)), ("gone", 3, None), ("null", None, None)]
    new = [("same", 1, at(1)), ("longer", 2, at(1)), ("touched", 1, at(2)), ("new", 4, at(4)), ("null", None, None)]
    found = manifest_changes(spark.createDataFrame(old, FILE), spark.createDataFrame(new, FILE))
    assert {r.path: (r.change, r.length) for r in found.collect()} == {
        "longer": ("changed", 2),
        "touched": ("changed", 1),
        "gone": ("vanished", 3),
        "new": ("appeared", 4),
    }
    rows = inventory(spark, item("a", path="gone"), item("b", path="same"), item("c", path="new"))
    assert {r.video_id: r.change for r in recheck(rows, found).collect()} == {"a": "vanished", "c": "appeared"}
    assert manifest_changes(spark.createDataFrame(old, FILE), spark.createDataFrame(old, FILE)).isEmpty()


# -- broken lines ----------------------------------------------------------------------------


def test_broken_lines_are_rejects(spark, tmp_path):
    lines = ['{"source_url":"a","id":"1"}', '{"source_url":"b","entr', "", "  ", "[1]", "{}", '{"source_url":"é"}']
    (tmp_path / "one.json").write_text("\n".join(lines), encoding="utf-8")
    (tmp_path / "two.json").write_text('{"source_url":"c","entries":[{"id":"x","url":"u"}]}\nnot json')
    read = read_lines(spark, LISTING, f"file:{tmp_path}")
    assert [f.name for f in read.rows.schema] == LISTING.names
    assert sorted(map(str, (r.source_url for r in read.rows.collect()))) == ["None", "a", "c", "é"]
    rejects = {(r.file.rpartition("/")[2], r.line) for r in read.rejects.collect()}
    assert rejects == {("one.json", '{"source_url":"b","entr'), ("one.json", "[1]"), ("two.json", "not json")}


def test_values_of_another_type_are_rejects(spark, tmp_path):
    (tmp_path / "d.json").write_text('{"source_url":"a","duration":1.5}\n{"source_url":"b","duration":"long"}')
    read = read_lines(spark, DOWNLOAD, f"file:{tmp_path}")
    assert [r.source_url for r in read.rows.collect()] == ["a"] and read.rejects.count() == 1
