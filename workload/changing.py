"""Updates, file checks, sweeps, edits, schedules and reports."""

from datetime import datetime, timezone

from pyspark.sql import functions as F

from cliptrack.functions import Backoff, crop_box, edit_plan, output_path
from cliptrack.operators import files, patches, selection, sweep
from cliptrack.plans import edit, ingest, publish, reports
from cliptrack.streaming.transitions import latest_status
from workload.registry import query
from workload.views import SCATTERED, scattered

AT = datetime(2025, 3, 1, 12, 30, 15, tzinfo=timezone.utc)
AT_SQL = "timestamp '2025-03-01 12:30:15'"
SEED = 42

PICKED = f"""
picked as (select distinct {SCATTERED} as video_id from lineitem)
"""


def _picked(t):
    return t.lineitem.select(scattered(t.lineitem).alias("video_id"))


@query(
    f"""select video_id, source_url, case when video_id = '77' then null else title end as title,
               duration, path_local,
               case when video_id = '77' then 'posted' else status_fb end as status_fb, created_at,
               case when video_id = '77' then {AT_SQL} else updated_at end as updated_at
        from inv""",
    "inv",
)
def update_by_id(t):
    updates = {"status_fb": "posted", "title": None, "no_such_column": 1}
    return patches.update_by_id(t.inv, "77", updates, AT)


@query(
    f""", {PICKED}
        select i.video_id, case when p.video_id is null then status_fb else 'failed' end as status_fb,
               case when p.video_id is null then updated_at else {AT_SQL} end as updated_at
        from inv i left join picked p on p.video_id = i.video_id""",
    "inv",
)
def update_by_set(t):
    updated = patches.update_by_ids(t.inv, _picked(t), {"status_fb": "failed"}, AT)
    return updated.select("video_id", "status_fb", "updated_at")


@query(
    """select i.video_id, i.source_url,
              case when f.set_title then f.title else i.title end as title,
              case when f.set_duration then f.duration else i.duration end as duration,
              case when f.set_status then f.path_local else i.path_local end as path_local,
              case when f.set_status then f.status_fb else i.status_fb end as status_fb,
              i.created_at, coalesce(f."at", i.updated_at) as updated_at
       from inv i left join folded f on f.video_id = i.video_id""",
    "inv",
    "patches",
)
def bulk_update(t):
    return patches.apply_patches(t.inv, patches.fold_patches(t.patches, ("at", "event_id")))


@query(
    """select video_id, status_fb, title, path_local, duration, "at",
              concat_ws(',', case when set_status then 'status_fb' end,
                             case when set_title then 'title' end,
                             case when set_status then 'path_local' end,
                             case when set_duration then 'duration' end) as changes
       from folded""",
    "patches",
)
def fold_patches(t):
    folded = patches.fold_patches(t.patches, ("at", "event_id"))
    return folded.withColumn("changes", F.concat_ws(",", "set_cols")).drop("set_cols")


@query(
    """select video_id, "at" from folded
       where video_id not in (select video_id from spread)""",
    "inv",
    "spread",
    "patches",
)
def unmatched_updates(t):
    folded = patches.fold_patches(t.patches, ("at", "event_id"))
    return patches.unmatched(folded, t.spread).select("video_id", "at")


@query(
    """select video_id, event_id, "at", 'run-1' as run_id,
              case event_type when 'click' then 'status_fb,path_local'
                              when 'error' then 'status_fb,path_local'
                              when 'view' then 'title'
                              when 'purchase' then 'duration' else '' end as changes
       from patches where video_id in (select video_id from spread)""",
    "inv",
    "spread",
    "patches",
)
def transition_audit(t):
    taken = patches.transitions(t.patches, t.spread, "run-1", ("event_id",))
    return taken.withColumn("changes", F.concat_ws(",", "changes"))


@query(
    """select video_id, status_fb, ts, event_id from changes
       qualify row_number() over (partition by video_id order by ts desc, event_id desc) = 1""",
    "changes",
)
def transition_fold(t):
    return latest_status(t.changes)


@query(
    f""", {PICKED}
        select i.video_id, case when p.video_id is null then status_fb else 'posted' end as status_fb
        from inv i left join picked p on p.video_id = i.video_id""",
    "inv",
)
def mark_posted(t):
    return publish.mark(t.inv, _picked(t), "posted", AT).inventory.select("video_id", "status_fb")


@query(
    f""", {PICKED}
        select video_id from picked
        where video_id not in (select video_id from inv)""",
    "inv",
)
def mark_unknown(t):
    return publish.mark(t.inv, _picked(t), "failed", AT).unmatched.select("video_id")


RESULTS = f"""
results as (
  select {SCATTERED} as video_id, bool_or(l_quantity < 20) as ok,
         max('videos/processed/' || {SCATTERED} || '_' || cast(l_linenumber as varchar) || '.mp4')
           filter (l_quantity < 20) as path_local
  from lineitem group by 1)
"""


def _results(t):
    """A result for every line, several for many items, some for unknown ones."""
    key = scattered(t.lineitem)
    number = F.col("l_linenumber").cast("string")
    return t.lineitem.select(
        key.alias("video_id"),
        (F.col("l_quantity") < 20).alias("ok"),
        F.concat(F.lit("videos/processed/"), key, F.lit("_"), number, F.lit(".mp4")).alias("path_local"),
    )


@query(
    f""", {RESULTS}
        select i.video_id,
               case when r.ok is null then i.status_fb when r.ok then 'ready'
                    else 'failed' end as status_fb,
               case when r.ok then r.path_local else i.path_local end as path_local,
               case when r.ok is null then i.updated_at else {AT_SQL} end as updated_at
        from inv i left join results r on r.video_id = i.video_id""",
    "inv",
)
def edit_results(t):
    done = edit.apply_edit_results(t.inv, _results(t), AT).inventory
    return done.select("video_id", "status_fb", "path_local", "updated_at")


@query(
    f""", {RESULTS}
        select video_id, case when ok then 'ready' else 'failed' end as status_fb, path_local
        from results where video_id not in (select video_id from inv)""",
    "inv",
)
def edit_results_unmatched(t):
    lost = edit.apply_edit_results(t.inv, _results(t), AT).unmatched
    return lost.select("video_id", "status_fb", "path_local")


EDITABLE = "status_fb = 'pending' and path_local <> ''"


@query(
    f"""select video_id, path_local, path_local in (select path from files) as on_disk
        from inv where {EDITABLE}""",
    "inv",
    "files",
)
def files_for_edit(t):
    rows = selection.editable(t.inv).select("video_id", "path_local")
    return files.flag_on_disk(rows, t.files)


@query(
    f"""select video_id, path_local from inv
        where {EDITABLE} and path_local not in (select path from files)""",
    "inv",
    "files",
)
def missing_for_edit(t):
    rows = selection.editable(t.inv).select("video_id", "path_local")
    return files.missing_on_disk(rows, t.files)


@query(
    """select video_id, path_local from inv
       where status_fb = 'pending' and contains(path_local, 'processed')
         and path_local in (select path from files)""",
    "inv",
    "files",
)
def files_for_publish(t):
    rows = selection.publishable(t.inv).select("video_id", "path_local")
    return files.on_disk(rows, t.files)


def _sweep_sql(statuses: str) -> str:
    return f"""
, cand as (
  select video_id, path_local, path_local in (select path from files) as on_disk,
         row_number() over (order by created_at nulls last, video_id) as turn
  from inv where status_fb in ({statuses}) and contains(path_local, 'processed')),
swept as (
  select c.video_id, c.path_local,
         case when h.turn is null or c.turn < h.turn then 'failed'
              when c.turn = h.turn then 'next' else 'untouched' end as outcome
  from cand c left join (select min(turn) as turn from cand where on_disk) h on true)
"""


@query(_sweep_sql("'pending'") + "select * from swept", "inv", "files")
def get_next_sweep(t):
    return sweep.sweep(t.inv, t.files)


@query(_sweep_sql("'ready', 'pending'") + "select * from swept", "inv", "files")
def get_next_sweep_ready(t):
    return sweep.sweep(t.inv, t.files, ("ready", "pending"))


@query(
    _sweep_sql("'pending'") + "select video_id, path_local from swept where outcome = 'next'",
    "inv",
    "files",
)
def next_to_publish(t):
    return publish.next_to_publish(t.inv, t.files, AT).chosen


@query(
    _sweep_sql("'pending'")
    + f"""select i.video_id,
                 case when s.video_id is null then i.status_fb else 'failed' end as status_fb,
                 case when s.video_id is null then i.updated_at else {AT_SQL} end as updated_at
          from inv i left join (select * from swept where outcome = 'failed') s
            on s.video_id = i.video_id""",
    "inv",
    "files",
)
def inventory_after_sweep(t):
    failed = publish.next_to_publish(t.inv, t.files, AT).failures
    return patches.apply_patches(t.inv, failed).select("video_id", "status_fb", "updated_at")


PLAN = f"""
array_to_string(list_transform(list_sort(list_transform(['mirror', 'zoom', 'color', 'speed'],
    lambda e: {{'draw': md5(video_id || ':{SEED}:' || e), 'name': e}})), lambda d: d.name)
  [1:(2 + ('0x' || substr(md5(video_id || ':{SEED}:k'), 1, 8))::ubigint % 3)::int], ',')
"""
OUTPUT = """
'videos/processed/' || regexp_replace(regexp_extract(path_local, '[^/]*$'), '\\.[^.]*$', '')
  || '_20250301123015_' || substr(md5(video_id || ':run-1'), 1, 8)
  || regexp_extract(path_local, '\\.[^./]*$')
"""


@query(f"select video_id, {PLAN} as edits from inv", "inv", name="edit_plan")
def edit_plans(t):
    return t.inv.select(
        "video_id", F.concat_ws(",", edit_plan(F.col("video_id"), SEED)).alias("edits")
    )


@query(
    f"select video_id, {OUTPUT} as output_path from inv where path_local <> ''",
    "inv",
    name="output_path",
)
def output_paths(t):
    rows = t.inv.filter("path_local <> ''")
    path = output_path(F.col("path_local"), F.col("video_id"), F.lit(AT), "run-1")
    return rows.select("video_id", path.alias("output_path"))


@query(
    """select p_partkey, cast(trunc(p_size * 37 * 0.05) as bigint) as x1,
              cast(trunc(p_size * 21 * 0.05) as bigint) as y1,
              p_size * 37 - cast(trunc(p_size * 37 * 0.05) as bigint) as x2,
              p_size * 21 - cast(trunc(p_size * 21 * 0.05) as bigint) as y2
       from part""",
    name="crop_box",
)
def crop_boxes(t):
    box = crop_box(F.col("p_size") * 37, F.col("p_size") * 21)
    return t.part.select("p_partkey", box.alias("box")).select("p_partkey", "box.*")


@query(
    f"""select video_id, path_local, {OUTPUT} as output_path, {PLAN} as edits,
               {PLAN} like '%mirror%' or {PLAN} like '%zoom%' as effective,
               case when {PLAN} like '%zoom%' then cast(trunc(duration // 1000 * 0.05) as bigint) end as x1,
               case when {PLAN} like '%zoom%' then cast(trunc(duration // 500 * 0.05) as bigint) end as y1,
               case when {PLAN} like '%zoom%' then duration // 1000
                 - cast(trunc(duration // 1000 * 0.05) as bigint) end as x2,
               case when {PLAN} like '%zoom%' then duration // 500
                 - cast(trunc(duration // 500 * 0.05) as bigint) end as y2
        from inv where {EDITABLE} and path_local in (select path from files)""",
    "inv",
    "files",
)
def planned_edits(t):
    width, height = (F.floor(F.col("duration") / n) for n in (1000, 500))
    sizes = t.inv.select("video_id", width.alias("width"), height.alias("height"))
    plan = edit.plan_edits(t.inv, t.files, None, SEED, "run-1", AT, sizes).edits
    return plan.withColumn("edits", F.concat_ws(",", "edits")).select("*", "crop.*").drop("crop")


@query(
    f"""select video_id, 'failed' as status_fb, {AT_SQL} as "at"
        from inv where {EDITABLE} and path_local not in (select path from files)""",
    "inv",
    "files",
)
def failed_before_edit(t):
    plan = edit.plan_edits(t.inv, t.files, None, SEED, "run-1", AT)
    return plan.failures.drop("set_cols")


@query(
    """select cast(l_orderkey as varchar) as video_id, l_linenumber as attempt,
              case when l_linenumber < 7
                   then least(5.0 * power(3.0, l_linenumber - 1), 90.0) end as wait_seconds
       from lineitem"""
)
def backoff_schedule(t):
    wait = Backoff(retries=7).wait(F.col("l_linenumber"))
    return t.lineitem.select(
        F.col("l_orderkey").cast("string").alias("video_id"),
        F.col("l_linenumber").alias("attempt"),
        wait.alias("wait_seconds"),
    )


def _attempts(t):
    return t.lineitem.select(
        F.col("l_orderkey").cast("string").alias("entry_id"),
        F.col("l_linenumber").alias("attempt"),
        F.col("l_shipdate").alias("failed_at"),
    )


JITTERED = """
least(5.0 * power(3.0, l_linenumber - 1), 90.0) as wait,
(('0x' || substr(md5(cast(l_orderkey as varchar) || ':42:' || cast(l_linenumber as varchar)), 1, 8))
   ::ubigint / 4294967296.0) * 0.2 - 0.1 as shift
"""


@query(
    f"""select entry_id, attempt, failed_at, round(wait + wait * shift, 6) as wait_seconds,
               date_trunc('second', failed_at + to_microseconds(
                 cast(round((wait + wait * shift) * 1000000) as bigint))) as next_attempt_second
        from (select cast(l_orderkey as varchar) as entry_id, l_linenumber as attempt,
                     l_shipdate as failed_at, {JITTERED}
              from lineitem where l_linenumber < 3)"""
)
def retry_schedule(t):
    left = ingest.record_download_failures(_attempts(t), t.labelled, seed=SEED).retries
    second = F.date_trunc("second", F.col("next_attempt_at")).cast("timestamp_ntz")
    return left.withColumns(
        {"wait_seconds": F.round("wait_seconds", 6), "next_attempt_second": second}
    ).drop("next_attempt_at")


@query(
    """select distinct cast(l_orderkey as varchar) as video_id, 'failed' as status_fb
       from lineitem where l_linenumber >= 3
         and cast(l_orderkey as varchar) not in (select video_id from labelled)""",
    "labelled",
)
def failed_downloads_unmatched(t):
    failures = ingest.record_download_failures(_attempts(t), t.labelled, at=AT)
    return failures.unmatched.select("video_id", "status_fb")


@query("select status_fb, count(*) as items from inv group by 1", "inv")
def status_census(t):
    return reports.status_census(t.inv)


@query(
    """select video_id, status_fb,
              case when status_fb = 'ready' then 'ready not accepted' else 'no file' end as reason
       from inv where status_fb = 'ready' or (status_fb = 'pending' and path_local = '')""",
    "inv",
)
def stuck_rows(t):
    return reports.stuck_rows(t.inv)


@query(
    """select path, 'file without row' as finding from files
       where path not in (select path_local from inv)
       union all
       select path_local, 'row without file' from inv
       where path_local <> '' and path_local not in (select path from files)""",
    "inv",
    "files",
)
def orphan_files(t):
    return reports.orphans(t.inv, t.files)
