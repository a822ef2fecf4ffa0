"""Histories, changed files and broken lines."""

import uuid

from pyspark.sql import functions as F

from cliptrack.operators import candidates, files, history
from cliptrack.schema import LISTING
from cliptrack.session import scratch_root
from cliptrack.sources.listings import read_lines
from workload.registry import query

# -- histories -------------------------------------------------------------------

#: Moments in and around the time of the events, for some items that have none.
MOMENTS = """
moments as (
  select cast(l_partkey % 200 as varchar) as video_id, l_orderkey, l_linenumber,
         timestamp '2023-12-31' + to_seconds((l_orderkey * 7919 + l_linenumber * 104729) % 2764800) as at
  from lineitem)"""


def _moments(t):
    moved = (F.col("l_orderkey") * 7919 + F.col("l_linenumber") * 104729) % 2764800
    return t.lineitem.select(
        (F.col("l_partkey") % 200).cast("string").alias("video_id"),
        "l_orderkey",
        "l_linenumber",
        F.expr("timestamp_ntz '2023-12-31 00:00:00'").alias("begin"),
        moved.alias("moved"),
    ).select(
        "video_id", "l_orderkey", "l_linenumber",
        F.expr("begin + make_interval(0, 0, 0, 0, 0, 0, moved)").alias("at"),
    )


@query(
    f""", {MOMENTS}
       select m.video_id, m.l_orderkey, m.l_linenumber, m.at, c.status_fb, c.ts as since
       from moments m asof left join changes c on m.video_id = c.video_id and m.at >= c.ts""",
    "changes",
)
def status_at_moments(t):
    return history.status_at(t.changes, _moments(t))


@query(
    """select video_id, status_fb, count(*) as visits,
              coalesce(sum(epoch_us(until) - epoch_us(ts)), 0) / 1e6 as seconds
       from (select *, lead(ts) over (partition by video_id order by ts, event_id) as until from changes)
       group by 1, 2""",
    "changes",
)
def time_in_state(t):
    return history.time_in_state(t.changes)


@query(
    """, ranked as (
         select *, last_value(status_fb) over (partition by video_id order by ts, event_id
                     rows between unbounded preceding and unbounded following) as final
         from changes),
       others as (select video_id, max(ts) as other from ranked where status_fb <> final group by 1)
       select r.video_id, r.final as status_fb, min(r.ts) as since
       from ranked r left join others o on o.video_id = r.video_id
       where o.other is null or r.ts > o.other group by 1, 2""",
    "changes",
)
def stuck_since(t):
    return history.stuck_since(t.changes)


# -- changed files -----------------------------------------------------------------

#: The files as they were: some are not there yet, some are there no more or differ.
EARLIER = """
earlier as (
  select path, case when length % 11 = 3 then length - 1 else length end as length,
         case when length % 13 = 5 then modified - interval 1 day else modified end as modified
  from files where length % 7 <> 0
  union all
  select 'videos/old/' || substr(path, 8), length, modified from files where length % 5 = 0),
differing as (
  select coalesce(a.path, e.path) as path,
         case when e.path is null then 'appeared' when a.path is null then 'vanished' else 'changed' end as change,
         case when a.path is null then e.length else a.length end as length,
         case when a.path is null then e.modified else a.modified end as modified
  from earlier e full join files a on a.path = e.path
  where e.path is null or a.path is null or a.length <> e.length or a.modified <> e.modified)"""


def _earlier(t):
    length = F.col("length")
    there = t.files.where(length % 7 != 0).select(
        "path",
        F.when(length % 11 == 3, length - 1).otherwise(length).alias("length"),
        F.when(length % 13 == 5, F.expr("modified - interval 1 day")).otherwise(F.col("modified")).alias("modified"),
    )
    gone = t.files.where(length % 5 == 0).select(
        F.concat(F.lit("videos/old/"), F.substr("path", F.lit(8))).alias("path"), "length", "modified"
    )
    return there.unionAll(gone)


@query(f", {EARLIER} select path, change, length, modified from differing", "files")
def manifest_changes(t):
    return files.manifest_changes(_earlier(t), t.files)


@query(
    f""", {EARLIER}
       select i.video_id, i.status_fb, i.path_local, d.change from inv i join differing d on d.path = i.path_local""",
    "inv",
    "files",
)
def rows_to_recheck(t):
    changes = files.manifest_changes(_earlier(t), t.files)
    return files.recheck(t.inv.select("video_id", "status_fb", "path_local"), changes)


# -- broken lines ------------------------------------------------------------------


@query(
    """, broken as (select url as page from pages where page_id % 7 = 3)
       select 'entry' as kind, source_url as page, video_id as line from entries
       where source_url not in (select page from broken)
       union all
       select 'cut off', page, '{"source_url":"' || page from broken""",
    "entries",
)
def listing_lines(t):
    """Listings as JSON lines, of which some end behind their first value's start."""
    listings = t.listings
    whole = F.to_json(F.struct(*listings.columns))
    cut = F.concat(F.lit('{"source_url":"'), F.col("source_url"))
    lines = listings.select(F.when(F.col("id").cast("long") % 7 == 3, cut).otherwise(whole).alias("value"))
    path = f"{scratch_root(t.spark)}/cliptrack/{uuid.uuid4().hex}/lines"
    lines.write.text(path)
    read = read_lines(t.spark, LISTING, path)
    entries = candidates.listing_entries(read.rows)
    return entries.select(
        F.lit("entry").alias("kind"), F.col("source_url").alias("page"), F.col("video_id").alias("line")
    ).unionAll(
        read.rejects.select(F.lit("cut off").alias("kind"), F.substr("line", F.lit(16)).alias("page"), "line")
    )
