"""Filters, first rows, candidates and appends."""

from pyspark.sql import functions as F

from cliptrack.functions import below, whole_seconds
from cliptrack.operators import append, candidates, files, keys, selection
from cliptrack.plans import ingest
from cliptrack.sources.listings import as_inventory
from workload.registry import query
from workload.views import ARRIVAL_ORDER

INVENTORY = "video_id, source_url, title, duration, path_local, status_fb, created_at, updated_at"


@query("select video_id, status_fb, path_local from inv where video_id = '77'", "inv")
def lookup_by_id(t):
    return selection.with_id(t.inv, "77").select("video_id", "status_fb", "path_local")


@query(
    """select distinct a.video_id, i.video_id is not null as already_exists
       from arrivals a left join spread i on i.video_id = a.video_id""",
    "inv",
    "spread",
    "arrivals",
)
def already_exists(t):
    offered = t.arrivals.select("video_id").distinct()
    return keys.flag_known(offered, t.spread, "video_id", "already_exists")


@query(
    """select coalesce(bool_or(video_id = '77'), false) as has_id,
              coalesce(bool_or(path_local like '%nowhere%'), false) as has_path from inv""",
    "inv",
)
def any_match(t):
    has_id = selection.any_match(t.inv, F.col("video_id") == "77", "has_id")
    has_path = selection.any_match(t.inv, F.contains("path_local", F.lit("nowhere")), "has_path")
    return has_id.withColumn("has_path", has_path.scalar())


@query(
    """select a.video_id, a.title from arrivals a
       where a.video_id in (select video_id from inv where status_fb = 'pending')""",
    "inv",
    "arrivals",
)
def rows_in_id_set(t):
    pending = t.inv.filter("status_fb = 'pending'")
    return keys.in_table(t.arrivals, pending, "video_id").select("video_id", "title")


@query(f"select {INVENTORY} from inv where status_fb = 'pending' and path_local <> ''", "inv")
def editable_rows(t):
    return selection.editable(t.inv)


@query(
    """select video_id, path_local, created_at from inv
       where status_fb = 'pending' and path_local <> ''
         and not contains(path_local, 'processed')""",
    "inv",
)
def editable_raw_rows(t):
    rows = selection.editable(t.inv, exclude_processed=True)
    return rows.select("video_id", "path_local", "created_at")


@query(
    """select video_id, path_local from inv where status_fb = 'pending' and path_local <> ''
       order by created_at nulls last, video_id limit 1""",
    "inv",
)
def first_editable(t):
    return selection.first_rows(selection.editable(t.inv)).select("video_id", "path_local")


@query(
    """select video_id, path_local from inv where status_fb = 'pending' and path_local <> ''
       order by created_at nulls last, video_id limit 50""",
    "inv",
)
def editable_first_n(t):
    return selection.first_rows(selection.editable(t.inv), 50).select("video_id", "path_local")


@query(
    """select video_id, path_local from inv
       where status_fb = 'pending' and contains(path_local, 'processed')""",
    "inv",
)
def processed_pending(t):
    return selection.publishable(t.inv).select("video_id", "path_local")


@query(
    """select video_id, path_local from inv
       where status_fb in ('pending', 'ready') and contains(path_local, 'processed')""",
    "inv",
)
def processed_pending_or_ready(t):
    rows = selection.publishable(t.inv, ("pending", "ready"))
    return rows.select("video_id", "path_local")


@query(
    """select video_id, path_local from inv
       where status_fb = 'pending' and contains(path_local, 'processed')
       order by created_at nulls last, video_id limit 1""",
    "inv",
)
def next_processed(t):
    return selection.next_publishable(t.inv)


@query("select source_url, pos, video_id, url, webpage_url from entries", "entries")
def listing_normalise(t):
    return candidates.listing_entries(t.listings)


@query(
    """select source_url, pos, video_id, url, webpage_url from entries
       where source_url like 'https:%'
         and video_id not in (select video_id from entries where source_url like 'http:%')""",
    "entries",
)
def new_candidates(t):
    entries = candidates.listing_entries(t.listings)
    secure = F.startswith("source_url", F.lit("https:"))
    known = entries.filter(~secure).select("video_id").distinct()
    return candidates.new_entries(entries.filter(secure), known)


@query(
    """select source_url, pos, video_id, url from documents_listed
       where video_id not in (select video_id from labelled)
       qualify row_number() over (partition by source_url order by pos) = 1""",
    "documents_listed",
    "labelled",
)
def first_new_per_source(t):
    entries = candidates.usable_entries(t.documents_listed)
    return ingest.to_download(entries, t.labelled).drop("webpage_url")


@query(
    """select source_url, pos, video_id, url from (
         select * from entries
         where source_url like 'https:%'
           and video_id not in (select video_id from entries where source_url like 'http:%')
         qualify row_number() over (partition by source_url, video_id order by pos) = 1)
       qualify row_number() over (partition by source_url order by pos) <= 3""",
    "entries",
)
def first_three_new_per_source(t):
    entries = candidates.listing_entries(t.listings)
    secure = F.startswith("source_url", F.lit("https:"))
    known = entries.filter(~secure).select("video_id").distinct()
    wanted = ingest.to_download(entries.filter(secure), known, 3)
    return wanted.drop("webpage_url")


@query(
    """select o_orderpriority as source_url, o_orderkey as pos from orders
       qualify row_number() over (partition by o_orderpriority order by o_orderkey) <= 2500"""
)
def long_batch_per_source(t):
    entries = t.orders.select(
        F.col("o_orderpriority").alias("source_url"),
        F.col("o_orderkey").alias("pos"),
        F.col("o_orderkey").cast("string").alias("video_id"),
        F.lit("https://src.example/").alias("url"),
        F.lit("").alias("webpage_url"),
    )
    return candidates.first_per_source(entries, 2500).select("source_url", "pos")


@query(
    """select n, source_url, pos, video_id from (
         select *, row_number() over (partition by source_url order by pos nulls first, video_id) as turn
         from (select source_url, case when url like 'https://www%' then null else pos end as pos, video_id
               from documents_listed)),
       (select unnest([3, 2500]) as n) where turn <= n""",
    "documents_listed",
)
def first_new_per_source_nulls(t):
    """Entries of which some have no position; few and many of each source."""
    entries = candidates.usable_entries(t.documents_listed)
    entries = entries.withColumn(
        "pos", F.when(~F.startswith("url", F.lit("https://www")), F.col("pos"))
    )
    few, many = (
        candidates.first_per_source(entries, n).select(F.lit(n).alias("n"), "source_url", "pos", "video_id")
        for n in (3, 2500)
    )
    return few.unionByName(many)


FIRST_ARRIVALS = """
first_arrivals as (
  select * from arrivals
  qualify row_number() over (partition by video_id
                             order by created_at, title, source_url, duration) = 1),
known as (select * from spread)
"""


@query(
    f""", {FIRST_ARRIVALS}
       select {INVENTORY} from known
       union all
       select {INVENTORY} from first_arrivals
       where video_id not in (select video_id from known)""",
    "inv",
    "spread",
    "arrivals",
)
def append_keep_first(t):
    return append.append(t.spread, t.arrivals, ARRIVAL_ORDER)


@query(
    """, known as (select video_id from spread)
       select count(*) as offered,
              count(distinct a.video_id) filter (where k.video_id is null) as inserted,
              count(*) filter (where a.video_id is null) as refused,
              count(*) - count(distinct a.video_id) filter (where k.video_id is null) as duplicate
       from arrivals a left join known k on k.video_id = a.video_id""",
    "inv",
    "spread",
    "arrivals",
)
def append_metrics(t):
    return append.append_metrics(t.spread, t.arrivals)


@query("select * from inv union all select * from arrivals", "inv", "arrivals")
def stack_rows(t):
    return append.stack(t.inv, t.arrivals)


@query(
    """select user_id, ts, event_id, event_type from events
       qualify row_number() over (partition by user_id order by ts, event_id) = 1"""
)
def keep_first_events(t):
    events = t.events.select("user_id", "ts", "event_id", "event_type")
    return append.keep_first(events, "user_id", ("ts", "event_id"))


@query("select video_id, path_local from document_stems", "document_files")
def file_by_id(t):
    return files.file_for_id(t.document_files)


@query(
    """select l_orderkey, l_linenumber,
              coalesce(cast(trunc(l_extendedprice) as bigint), 0) as duration
       from lineitem"""
)
def duration_default(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", whole_seconds(F.col("l_extendedprice")).alias("duration")
    )


@query(
    """select path as bare, path as one_slash, path as three_slashes, path as authority,
              path as other_base from files""",
    "files",
)
def relative_path(t):
    """The five ways in which a listing and a base may name the same file."""
    named = {
        "bare": ("/srv/media", "/srv/media/"),
        "one_slash": ("/srv/media/", "file:/srv/media/"),
        "three_slashes": ("file:/srv/media", "file:///srv/media/"),
        "authority": ("hdfs://name:8020/media", "hdfs://name:8020/media/"),
        "other_base": ("file:///srv/media", "/srv/media/"),
    }
    return t.files.select(
        *(below(base, F.concat(F.lit(root), "path")).alias(n) for n, (base, root) in named.items())
    )


REQUESTED = """
requested as (
  select * from documents_listed where video_id not in (select video_id from labelled)),
results as (
  select r.source_url as listing, r.pos, r.video_id as entry_id, r.webpage_url as entry_page,
         coalesce(d.id, r.video_id) as video_id, d.webpage_url, d.title, d.title_known,
         d.duration, d.error
  from requested r join downloads d on d.source_url = r.source_url and d.entry_id = r.video_id)
"""

INGEST_VIEWS = ("documents_listed", "labelled", "downloads", "document_files")


def _round(t):
    """A whole round: all that is new was requested."""
    entries = candidates.usable_entries(t.documents_listed)
    requested = candidates.new_entries(entries, t.labelled)
    return ingest.ingest(requested, t.downloads, t.document_files)


@query(
    f""", {REQUESTED}
       select r.listing, r.pos, r.video_id,
              coalesce(nullif(r.webpage_url, ''), nullif(r.entry_page, ''), r.listing) as source_url,
              case when r.title is null and not coalesce(r.title_known, false) then ''
                   else r.title end as title,
              coalesce(cast(trunc(r.duration) as bigint), 0) as duration,
              coalesce(s.path_local, '') as path_local, 'pending' as status_fb
       from (select * from results where error is null and video_id <> ''
             qualify row_number() over (partition by video_id order by listing, pos) = 1) r
       left join document_stems s on s.video_id = r.video_id""",
    *INGEST_VIEWS,
)
def ingest_rows(t):
    return _round(t).rows.drop("created_at", "updated_at")


@query(
    f""", {REQUESTED}
       select entry_id, 'no id' as outcome from results where error is null and video_id = ''
       union all
       select distinct entry_id, 'failed' as outcome from results where error is not null""",
    *INGEST_VIEWS,
)
def ingest_rejects_and_failures(t):
    done = _round(t)
    rejects = done.rejects.select("entry_id", F.lit("no id").alias("outcome"))
    failed = done.failures.select(
        F.col("video_id").alias("entry_id"), F.col("status_fb").alias("outcome")
    )
    return rejects.unionByName(failed)


@query("select * from inv", "inv")
def typed_rows(t):
    """Rows of any source with the inventory's columns and types, or an error."""
    typed = as_inventory(t.inv.withColumn("source_row", F.lit(1)))
    return typed.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("created_at", "updated_at")})
