"""The stored workflow against a plain model of the same rules, step by step."""

import random

import pytest

from cliptrack import Inventory, Workflow
from helpers import at, by_id, files, ids, inventory, item, patches, utc


class Model:
    """Rows in a dict, one change after the other."""

    def __init__(self):
        self.rows = {}

    def queue(self, status, part):
        rows = [
            r
            for r in self.rows.values()
            if r["status_fb"] in status and part in (r["path_local"] or "") and r["path_local"]
        ]
        return sorted(
            rows, key=lambda r: (r["created_at"] is None, r["created_at"] or at(0), r["video_id"])
        )

    def set(self, video_id, moment, **values):
        if video_id in self.rows:
            self.rows[video_id].update(values, updated_at=moment)

    def take_next(self, found, moment, status):
        for row in self.queue(status, "processed"):
            if row["path_local"] in found:
                return row["video_id"]
            self.set(row["video_id"], moment, status_fb="failed")
        return None

    def plan(self, found, moment, n):
        taken = []
        for row in self.queue(["pending"], "")[:n]:
            if row["path_local"] in found:
                taken.append(row["video_id"])
            else:
                self.set(row["video_id"], moment, status_fb="failed")
        return sorted(taken)


@pytest.mark.parametrize("seed", [1, 2])
def test_workflow_follows_the_model(spark, tmp_path, seed):
    draw = random.Random(seed)
    stored = Inventory(spark, f"file:{tmp_path}/inventory")
    flow, model = Workflow(stored), Model()
    stored.create()
    names = [f"v{i}" for i in range(24)]

    def some(k):
        return [draw.choice(names) for _ in range(k)]

    def append(moment):
        rows = [
            item(
                v,
                status=draw.choice(["pending", "pending", "ready"]),
                path=draw.choice(["", f"videos/raw/{v}.mp4", f"videos/processed/{v}.mp4"]),
                minutes=draw.choice([None, draw.randint(0, 9)]),
                title=f"{moment}-{i}",
            )
            for i, v in enumerate(some(8))
        ]
        draw.shuffle(rows)
        for row in sorted(rows, key=lambda r: r["title"]):
            model.rows.setdefault(row["video_id"], dict(row))
        stored.append(inventory(spark, *rows), ("title",))

    def mark(moment):
        chosen, status = some(3), draw.choice(["posted", "failed", "pending", "strange"])
        flow.inventory.set_values(ids(spark, *chosen), {"status_fb": status}, moment)
        for v in chosen:
            model.set(v, moment, status_fb=status)

    def patch(moment):
        records = []
        for n, v in enumerate(some(5)):
            values = {c: draw.choice([None, f"{c}{n}"]) for c in draw.sample(["title", "path_local"], 1)}
            # A patch has its own time, which orders the patches of one batch.
            records.append({"video_id": v, **values, "set_cols": list(values), "at": at(100 + n)})
            model.set(v, at(100 + n), **values)
        stored.patch(patches(spark, *records))

    def found():
        paths = [r["path_local"] for r in model.rows.values() if r["path_local"]]
        return [p for p in paths if draw.random() < 0.3]

    def take_next(moment):
        paths, status = found(), draw.choice([("pending",), ("ready",), ("ready", "pending")])
        got = flow.take_next(files(spark, *paths), moment, status)
        want = model.take_next(paths, moment, status)
        assert (got.video_id if got else None) == want

    def plan(moment):
        paths, n = found(), draw.choice([1, 3, None])
        got = flow.plan_edits(files(spark, *paths), n, at=moment)
        assert sorted(r.video_id for r in got.collect()) == model.plan(paths, moment, n)

    steps = [append, append, mark, patch, take_next, plan]
    for number in range(18):
        step = append if number == 0 else draw.choice(steps)
        step(at(1000 + number))
        if number % 3 == 2:
            got = by_id(stored.read())
            assert set(got) == set(model.rows)
            for v, row in got.items():
                want = model.rows[v]
                for column in ("title", "path_local", "status_fb"):
                    assert row[column] == want[column], (number, step.__name__, v, column)
                if want["updated_at"] is None:
                    assert row.updated_at is None
                else:
                    assert utc(row.updated_at) == want["updated_at"]
