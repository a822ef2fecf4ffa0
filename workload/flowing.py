"""Streams whose state ends, run for real over tables that come in parts."""

from pyspark.sql import functions as F

from cliptrack.operators import candidates
from cliptrack.operators.keys import not_in_table
from cliptrack.sources.inventory import Inventory
from cliptrack.sources.media import (
    latest_sightings,
    list_media,
    manifest_into,
    read_manifest,
    watch_media,
)
from cliptrack.streaming import arrivals, meetings, timed
from workload.registry import query
from workload import views
from workload.storing import PARTS, _in_parts, _scratch, _stored, _Streamed, _typed
from workload.views import ARRIVAL_ORDER

#: Each part lies wholly behind the one before it in time.
APART = "make_interval(0, 0, 0, 4000 * part)"
BEGIN = "timestamp '2025-01-01 00:00:00'"


def _drain(reader, start) -> None:
    start(reader).trigger(availableNow=True).start().awaitTermination()


# -- requests and downloads -----------------------------------------------------

INGESTED = f"""
, asked as (
  select l.*, d.n_chars, d.doc_id % {PARTS} as part
  from documents_listed l join documents d on d.doc_id = l.pos
  where l.video_id not in (select video_id from labelled)),
results as (
  select a.source_url as listing, a.pos, a.part, a.video_id as entry_id, a.webpage_url as entry_page,
         coalesce(d.id, a.video_id) as video_id, d.webpage_url, d.title, d.title_known, d.duration,
         case when a.n_chars % 10 < 2 then '{meetings.MISSING}' else d.error end as error
  from asked a join downloads d on d.source_url = a.source_url and d.entry_id = a.video_id),
first_results as (
  select * from results where error is null and video_id <> ''
  qualify row_number() over (partition by video_id order by part, listing, pos) = 1)
select r.video_id,
       coalesce(nullif(r.webpage_url, ''), nullif(r.entry_page, ''), r.listing) as source_url,
       case when r.title is null and not coalesce(r.title_known, false) then '' else r.title end as title,
       coalesce(cast(trunc(r.duration) as bigint), 0) as duration,
       coalesce(s.path_local, '') as path_local, 'pending' as status_fb
from first_results r left join document_stems s on s.video_id = r.video_id
union all
select distinct entry_id, null, null, null, null, 'failed' from results where error is not null
"""


@query(INGESTED, "documents_listed", "labelled", "downloads", "document_files")
def stream_requests_meet_downloads(t):
    """Of ten downloads one never comes and one comes too late; a tick ends the wait."""
    entries = candidates.usable_entries(t.documents_listed)
    part = F.pmod(F.col("pos"), F.lit(PARTS)).cast("int")
    asked = f"{BEGIN} + {APART} + make_interval(0, 0, 0, 0, 0, 0, pos)"
    requests = (
        not_in_table(entries, t.labelled, "video_id")
        .withColumn("part", part)
        .withColumn("requested_at", F.expr(asked))
    )
    wait = F.expr("make_interval(0, 0, 0, 0, 0, if(n_chars % 10 = 1, 120, n_chars % 60), 0)")
    chars = t.documents.select(F.col("doc_id").cast("string").alias("entry_id"), F.col("doc_id").alias("pos"), "n_chars")
    downloads = (
        t.downloads.join(chars, "entry_id")
        .where("n_chars % 10 <> 0")
        .withColumn("part", part)
        .withColumn("fetched_at", F.expr(asked) + wait)
        .drop("pos", "n_chars")
    )
    # Ticks: empty ids, behind everything.
    end = F.expr(f"{BEGIN} + make_interval(0, 0, 0, 4000 * {PARTS + 1})")
    tick = t.spark.range(1).withColumn("part", F.lit(PARTS))
    ticks = {
        "requests": tick.select(
            "part", end.alias("requested_at"), *(F.lit("").alias(c) for c in ("source_url", "video_id"))
        ),
        "downloads": tick.select(
            "part", end.alias("fetched_at"), *(F.lit("").alias(c) for c in ("source_url", "entry_id"))
        ),
    }
    where = _scratch(t)
    inventory, checkpoint = Inventory(t.spark, f"{where}/inventory"), f"{where}/checkpoint"
    inventory.create()
    given = {"requests": requests, "downloads": downloads}
    for k in range(PARTS + 1):
        readers = {}
        for name, rows in given.items():
            own = rows.where(F.col("part") == k)
            if k == PARTS:
                own = own.unionByName(ticks[name], allowMissingColumns=True)
            own.drop("part").write.mode("append").parquet(f"{where}/{name}")
            schema = rows.drop("part").schema
            readers[name] = t.spark.readStream.schema(schema).parquet(f"{where}/{name}")
        pairs = meetings.met(readers["requests"], readers["downloads"], "1 hour", "2 hours")
        _drain(pairs, lambda p: meetings.ingest_into(p, inventory, lambda: t.document_files, checkpoint))
    columns = ["video_id", "source_url", "title", "duration", "path_local", "status_fb"]
    failed = inventory.transitions(unmatched=True).select("video_id", "status_fb").distinct()
    return inventory.read().select(*columns).unionByName(failed, allowMissingColumns=True)


# -- retries when they are due ----------------------------------------------------

SEED = 42

DUE = f"""
with attempts as (
  select cast(user_id as varchar) as entry_id, cast(1 + event_id % 3 as int) as attempt, ts as failed_at,
         least((extract(day from ts)::int - 1) // 10, {PARTS - 1}) as part
  from events),
waits as (
  select *, least(5.0 * power(3.0, attempt - 1), 90.0) as wait,
         (('0x' || substr(md5(entry_id || ':{SEED}:' || cast(attempt as varchar)), 1, 8))
            ::ubigint / 4294967296.0) * 0.2 - 0.1 as shift
  from attempts),
scheduled as (
  select *, failed_at + to_microseconds(cast(round((wait + wait * shift) * 1000000) as bigint)) as due_at
  from waits where attempt < 3),
reached as (select part, max(failed_at) over (order by part) as upto
            from (select part, max(failed_at) as failed_at from attempts group by part))
select entry_id, cast(attempt + 1 as int) as attempt, date_trunc('second', due_at) as due_second, '{timed.RETRY}' as outcome,
       cast(coalesce((select min(part) from reached where upto >= due_at), {PARTS}) as int) as wave
from scheduled
union all
select entry_id, attempt, null, '{timed.SPENT}', cast(part as int) from attempts where attempt = 3
"""


@query(DUE)
def stream_due_retries(t):
    """Failed attempts in ten-day parts; each retry comes out in the wave that it is due in."""
    attempts = t.events.select(
        F.col("user_id").cast("string").alias("entry_id"),
        (1 + F.col("event_id") % 3).cast("int").alias("attempt"),
        F.col("ts").cast("timestamp").alias("failed_at"),
        F.lit(False).alias("ok"),
        F.least(F.floor((F.dayofmonth("ts") - 1) / 10), F.lit(PARTS - 1)).cast("int").alias("part"),
    )
    tick = t.spark.sql(
        f"select cast(null as string) as entry_id, 1 as attempt, timestamp '2030-01-01' as failed_at,"
        f" false as ok, {PARTS} as part"
    )
    where, wave = _scratch(t), 0

    def keep(batch, number):
        batch.withColumn("wave", F.lit(wave)).write.mode("append").parquet(f"{where}/due")

    for wave in range(PARTS + 1):
        own = attempts if wave < PARTS else tick
        own.where(F.col("part") == wave).drop("part").write.mode("append").parquet(f"{where}/attempts")
        reader = t.spark.readStream.schema(attempts.drop("part").schema).parquet(f"{where}/attempts")
        due = timed.due_attempts(reader, "0 seconds", seed=SEED)
        _drain(
            due,
            lambda d: d.writeStream.outputMode("append")
            .option("checkpointLocation", f"{where}/checkpoint")
            .foreachBatch(keep),
        )
    second = F.date_trunc("second", F.col("due_at")).cast("timestamp_ntz").alias("due_second")
    return t.spark.read.parquet(f"{where}/due").select("entry_id", "attempt", second, "outcome", "wave")


# -- files as they appear -----------------------------------------------------------


@query(
    """select case when l_linestatus = 'F' then 'processed' else 'raw' end as folder,
              l_linenumber % 3 as part, strftime(l_shipdate, '%Y-%m') as month,
              sum(length(cast(l_orderkey as varchar)) + 5)::bigint as length
       from lineitem group by all"""
)
def stream_files_into_manifest(t):
    """Real files below two folders, some of them added after each run of the stream."""
    where = _scratch(t)
    rows = t.lineitem.select(
        F.when(F.col("l_linestatus") == "F", "processed").otherwise("raw").alias("folder"),
        (F.col("l_linenumber") % PARTS).cast("int").alias("part"),
        F.date_format("l_shipdate", "yyyy-MM").alias("month"),
        F.concat(F.col("l_orderkey").cast("string"), F.lit(".mp4")).alias("line"),
    )
    base, manifest = f"{where}/videos", f"{where}/manifest"
    for part in range(PARTS):
        own = rows.where(F.col("part") == part)
        own.repartition("folder", "part", "month").write.partitionBy("folder", "part", "month").mode("append").text(base)
        files = watch_media(t.spark, base, "folder=raw", "folder=processed", per_batch=40)
        _drain(files, lambda f: manifest_into(f, manifest, f"{where}/checkpoint"))
    seen = latest_sightings(read_manifest(t.spark, manifest)).where(F.endswith("path", F.lit(".txt")))
    name = lambda k: F.regexp_extract("path", rf"{k}=([^/]+)/", 1)
    return seen.groupBy(
        name("folder").alias("folder"), name("part").cast("long").alias("part"), name("month").alias("month")
    ).agg(F.sum("length").alias("length"))


# -- what becomes of arrivals ---------------------------------------------------------


@query(
    f"""
, parted as (
  select cast(split_part(title, '-', 2) as bigint) % {PARTS} as part,
         case when duration % 50 <> 0 then video_id end as video_id
  from arrivals),
firsts as (select video_id, min(part) as part from parted
           where video_id is not null and video_id not in (select video_id from spread) group by video_id),
counted as (
  select p.part, count(*) as offered, count(*) filter (p.video_id is null) as refused,
         (select count(*) from firsts f where f.part = p.part) as inserted
  from parted p group by p.part)
select part::int as part, offered, inserted, refused, offered - inserted - refused as duplicate from counted""",
    "inv",
    "spread",
    "arrivals",
)
def stream_arrival_metrics(t):
    """Counts of each micro-batch, some rows without id among them; one part each."""
    inventory, checkpoint = _stored(t, t.spread), f"{_scratch(t)}/checkpoint"
    told, metrics = [], arrivals.ArrivalMetrics()

    def start(lines):
        offered = _typed(views.arrivals(_Streamed(lineitem=lines)))
        some = F.when(F.col("duration") % 50 != 0, F.col("video_id")).alias("video_id")
        offered = offered.select(some, *offered.columns[1:])
        return arrivals.append_into(offered, inventory, checkpoint, ARRIVAL_ORDER, metrics)

    t.spark.streams.addListener(metrics)
    try:
        _in_parts(t, "lineitem", "l_linenumber", start, lambda part: told.extend(metrics.taken()))
    finally:
        t.spark.streams.removeListener(metrics)
    names = "part int, offered long, inserted long, refused long, duplicate long"
    return t.spark.createDataFrame(told, names)


@query(
    """select case when l_linestatus = 'F' then 'processed' else 'raw' end as folder,
              strftime(l_shipdate, '%Y-%m') as month,
              sum(length(cast(l_orderkey as varchar)) + 5)::bigint as length
       from lineitem group by all"""
)
def media_listed(t):
    """Real files below two folders, listed at once; folders elsewhere are not."""
    rows = t.lineitem.select(
        F.when(F.col("l_linestatus") == "F", "processed").otherwise("raw").alias("folder"),
        F.date_format("l_shipdate", "yyyy-MM").alias("month"),
        F.concat(F.col("l_orderkey").cast("string"), F.lit(".mp4")).alias("line"),
    )
    base = f"{_scratch(t)}/videos"
    elsewhere = rows.where("month = '1995-01'").withColumn("folder", F.lit("other"))
    rows.unionByName(elsewhere).repartition("folder", "month").write.partitionBy("folder", "month").text(base)
    found = list_media(t.spark, base, "folder=raw", "folder=processed")
    name = lambda k: F.regexp_extract("path", rf"{k}=([^/]+)/", 1).alias(k)
    return found.groupBy(name("folder"), name("month")).agg(F.sum("length").alias("length"))
