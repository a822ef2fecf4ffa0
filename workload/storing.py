"""The stored inventory and the streams into it, run for real in scratch folders."""

import uuid

from pyspark.sql import functions as F

from cliptrack.operators import candidates
from cliptrack.schema import INVENTORY
from cliptrack.session import scratch_root
from cliptrack.sources.inventory import Inventory
from cliptrack.sources.listings import read_listings
from cliptrack.streaming import arrivals, transitions
from workload import views
from workload.registry import query
from workload.views import ARRIVAL_ORDER


def _scratch(t) -> str:
    return f"{scratch_root(t.spark)}/cliptrack/{uuid.uuid4().hex}"


def _typed(rows):
    """Rows with the stored types: the test tables hold their times without zone."""
    return rows.withColumns({f.name: F.col(f.name).cast(f.dataType) for f in INVENTORY})


def _untyped(rows):
    return rows.withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in ("created_at", "updated_at")}
    )


def _stored(t, rows) -> Inventory:
    inventory = Inventory(t.spark, _scratch(t))
    inventory.append(_typed(rows), ("created_at", "title", "source_url", "duration"))
    return inventory


#: Parts in which a table comes as a stream, each after the one before it is taken.
PARTS = 3


def _in_parts(t, table: str, number: str, start, after=lambda part: None) -> None:
    """Run a stream over a table that comes in parts; it goes on from its checkpoint.

    The rows of a part are those of one remainder, so that later parts hold rows that
    are earlier in every order of their own.
    """
    folder, rows = f"{_scratch(t)}/{table}", getattr(t, table)
    for part in range(PARTS):
        rows.filter(F.col(number) % PARTS == part).write.mode("append").parquet(folder)
        reader = t.spark.readStream.schema(rows.schema).parquet(folder)
        start(reader).trigger(availableNow=True).start().awaitTermination()
        after(part)


class _Streamed:
    """Stands in for the tables where a view is wanted over a stream."""

    def __init__(self, **tables):
        self.__dict__.update(tables)


STORED = """
, first_arrivals as (
  select * from arrivals
  qualify row_number() over (partition by video_id
                             order by created_at, title, source_url, duration) = 1),
known as (select * from spread),
stored as (select * from known union all
           select * from first_arrivals where video_id not in (select video_id from known))
"""


@query("select source_url, pos, video_id, url, webpage_url from entries", "entries")
def listings_read(t):
    """The listings as JSON lines, as the fetcher hands them over."""
    path = f"{_scratch(t)}/listings"
    t.listings.write.json(path)
    return candidates.listing_entries(read_listings(t.spark, path))


@query("select * from inv", "inv")
def inventory_view(t):
    return _untyped(_stored(t, t.inv).read())


@query(STORED + "select * from stored", "inv", "spread", "arrivals")
def stored_append(t):
    inventory = _stored(t, t.spread)
    inventory.append(_typed(t.arrivals), ARRIVAL_ORDER)
    return _untyped(inventory.read())


PATCHED = """
, patched as (
  select i.video_id, i.source_url,
         case when f.set_title then f.title else i.title end as title,
         case when f.set_duration then f.duration else i.duration end as duration,
         case when f.set_status then f.path_local else i.path_local end as path_local,
         case when f.set_status then f.status_fb else i.status_fb end as status_fb,
         i.created_at, coalesce(f."at", i.updated_at) as updated_at
  from inv i left join folded f on f.video_id = i.video_id)
"""


def _patched(t) -> Inventory:
    inventory = _stored(t, t.inv)
    typed = t.patches.withColumn("at", F.col("at").cast("timestamp"))
    inventory.patch(typed, ("at", "event_id"))
    return inventory


@query(PATCHED + "select * from patched where status_fb = 'ready'", "inv", "patches")
def stored_ready_rows(t):
    return _untyped(_patched(t).read(statuses=("ready",)))


@query(PATCHED + "select * from patched", "inv", "patches")
def stored_compacted(t):
    """All patches in the rows of one folder."""
    return _untyped(_patched(t).read())


@query(
    """select video_id, "at", concat_ws(',', case when set_status then 'status_fb' end,
              case when set_title then 'title' end, case when set_status then 'path_local' end,
              case when set_duration then 'duration' end) as changes
       from folded where video_id in (select video_id from inv)""",
    "inv",
    "patches",
)
def stored_transitions(t):
    taken = _patched(t).transitions()
    names = ("status_fb", "title", "path_local", "duration")
    listed = (F.when(F.array_contains("set_cols", n), F.lit(n)) for n in names)
    return taken.select(
        "video_id", F.col("at").cast("timestamp_ntz").alias("at"),
        F.concat_ws(",", *listed).alias("changes"),
    )


def _followed(t, by: str):
    inventory, checkpoint = _stored(t, t.inv), f"{_scratch(t)}/checkpoint"

    def start(events):
        changes = views.changes(_Streamed(events=events))
        # The parts go over all the time that there is: nothing is late.
        return transitions.fold_into(changes, inventory, checkpoint, by, "400 days")

    _in_parts(t, "events", "event_id", start)
    return _untyped(inventory.read()).select("video_id", "status_fb", "updated_at")


def _followed_sql(order: str) -> str:
    return f"""
, fold as (select video_id, status_fb, ts from changes
           qualify row_number() over (partition by video_id order by {order}) = 1)
select i.video_id, coalesce(f.status_fb, i.status_fb) as status_fb,
       coalesce(f.ts, i.updated_at) as updated_at
from inv i left join fold f on f.video_id = i.video_id"""


@query(_followed_sql("ts desc, event_id desc"), "inv", "changes")
def stream_transition_fold(t):
    return _followed(t, transitions.EVENT_TIME)


@query(_followed_sql(f"event_id % {PARTS} desc, ts desc, event_id desc"), "inv", "changes")
def stream_transitions_by_arrival(t):
    return _followed(t, transitions.ARRIVAL)


@query(
    f"""
, parted as (
  select *, cast(split_part(title, '-', 2) as bigint) % {PARTS} as part from arrivals),
first_arrivals as (
  select * exclude (part) from parted
  qualify row_number() over (partition by video_id
                             order by part, created_at, title, source_url, duration) = 1)
select * from spread
union all
select * from first_arrivals where video_id not in (select video_id from spread)""",
    "inv",
    "spread",
    "arrivals",
)
def stream_append_keep_first(t):
    inventory, checkpoint = _stored(t, t.spread), f"{_scratch(t)}/checkpoint"

    def start(lines):
        offered = _typed(views.arrivals(_Streamed(lineitem=lines)))
        return arrivals.append_into(offered, inventory, checkpoint, ARRIVAL_ORDER)

    _in_parts(t, "lineitem", "l_linenumber", start)
    return _untyped(inventory.read())
