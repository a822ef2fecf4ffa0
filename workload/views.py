"""The test tables seen as inventory, listings, downloads, files and patches.

Each view exists twice, as a DataFrame and as a SQL text, with equal rows. All
of them cover their whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _text(column: str):
    return F.col(column).cast("string")


def inv(t) -> DataFrame:
    """Orders as inventory rows, in every state and with every kind of path."""
    name = F.concat(_text("o_orderkey"), F.lit(".mp4"))
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    return t.orders.select(
        _text("o_orderkey").alias("video_id"),
        F.concat(F.lit("https://src.example/"), _text("o_custkey")).alias("source_url"),
        priority.alias("title"),
        F.floor("o_totalprice").cast("bigint").alias("duration"),
        F.when(priority == "5-LOW", "")
        .when(priority.isin("1-URGENT", "2-HIGH"), F.concat(F.lit("videos/raw/"), name))
        .otherwise(F.concat(F.lit("videos/processed/"), name))
        .alias("path_local"),
        F.when(status == "P", "pending")
        .when(status == "O", "ready")
        .when(F.col("o_totalprice") < 250000, "failed")
        .otherwise("posted")
        .alias("status_fb"),
        F.col("o_orderdate").alias("created_at"),
        F.col("o_orderdate").alias("updated_at"),
    )


INV = """
inv as (
  select cast(o_orderkey as varchar) as video_id,
         'https://src.example/' || cast(o_custkey as varchar) as source_url,
         o_orderpriority as title,
         cast(floor(o_totalprice) as bigint) as duration,
         case when o_orderpriority = '5-LOW' then ''
              when o_orderpriority in ('1-URGENT', '2-HIGH')
                then 'videos/raw/' || cast(o_orderkey as varchar) || '.mp4'
              else 'videos/processed/' || cast(o_orderkey as varchar) || '.mp4' end as path_local,
         case when o_orderstatus = 'P' then 'pending'
              when o_orderstatus = 'O' then 'ready'
              when o_totalprice < 250000 then 'failed' else 'posted' end as status_fb,
         o_orderdate as created_at, o_orderdate as updated_at
  from orders)"""


def spread(t) -> DataFrame:
    """The inventory under every second id, so that others are unknown to it."""
    return t.inv.withColumn("video_id", (F.col("video_id").cast("bigint") * 2).cast("string"))


SPREAD = """
spread as (select * replace (cast(cast(video_id as bigint) * 2 as varchar) as video_id) from inv)"""


def scattered(line: DataFrame):
    """An order's key for some of its lines, and for others one that is further on."""
    return (F.col("l_orderkey") * (1 + F.col("l_linenumber") % 4)).cast("string")


SCATTERED = "cast(l_orderkey * (1 + l_linenumber % 4) as varchar)"


def files(t) -> DataFrame:
    """Media files: raw or processed by line status, for some of the inventory."""
    folder = F.when(F.col("l_linestatus") == "F", "videos/processed/").otherwise("videos/raw/")
    path = F.concat(folder, scattered(t.lineitem), F.lit(".mp4"))
    return (
        t.lineitem.groupBy(path.alias("path"))
        .agg(
            F.sum("l_quantity").cast("bigint").alias("length"),
            F.max("l_shipdate").alias("modified"),
        )
    )


FILES = f"""
files as (
  select case when l_linestatus = 'F' then 'videos/processed/' else 'videos/raw/' end
           || {SCATTERED} || '.mp4' as path,
         cast(sum(l_quantity) as bigint) as length, max(l_shipdate) as modified
  from lineitem group by 1)"""


def listings(t) -> DataFrame:
    """Pages as fetched listings, their links as entries, some without address."""
    pages = t.pages.select(
        "page_id",
        F.col("url").alias("page"),
        F.regexp_extract("url", "^(https?://[^/]*)", 1).alias("site"),
        F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1)).alias("links"),
    )
    address = lambda link: F.when(F.endswith(link, F.lit(".")), "").otherwise(
        F.concat("site", link)
    )
    return pages.select(
        F.col("page").alias("source_url"),
        _text("page_id").alias("id"),
        F.lit(None).cast("string").alias("url"),
        F.col("page").alias("webpage_url"),
        F.transform(
            "links",
            lambda link: F.struct(
                F.substr(link, F.lit(2)).alias("id"),
                address(link).alias("url"),
                F.when(F.length(link) > 3, link).alias("webpage_url"),
            ),
        ).alias("entries"),
    )


LINKS = """
links as (
  select source_url, i - 1 as pos, substr(link, 2) as video_id,
         coalesce(case when link like '%.' then null else site || link end,
                  case when length(link) > 3 then link end) as url,
         case when length(link) > 3 then link end as webpage_url
  from (select url as source_url, regexp_extract(url, '^(https?://[^/]*)', 1) as site,
               unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) as link,
               unnest(range(1, len(regexp_extract_all(html, 'href="([^"]*)"', 1)) + 1)) as i
        from pages)),
entries as (select * from links where video_id <> '' and url is not null)"""


def documents_listed(t) -> DataFrame:
    """Documents as listing entries that are stored flat, by source."""
    tail = F.concat(F.col("source"), F.lit("/"), _text("doc_id"))
    return t.documents.select(
        F.col("source").alias("source_url"),
        F.col("doc_id").alias("pos"),
        _text("doc_id").alias("video_id"),
        F.when(F.col("lang") == "de", "").otherwise(F.concat(F.lit("https://"), tail)).alias("url"),
        F.when(F.col("lang") == "es", "")
        .otherwise(F.concat(F.lit("https://www."), tail))
        .alias("webpage_url"),
    )


DOCUMENTS_LISTED = """
documents_listed as (
  select source as source_url, doc_id as pos, cast(doc_id as varchar) as video_id,
         case when lang = 'de' then 'https://www.' else 'https://' end
           || source || '/' || cast(doc_id as varchar) as url,
         case when lang = 'es' then ''
              else 'https://www.' || source || '/' || cast(doc_id as varchar) end as webpage_url
  from documents)"""


def labelled(t) -> DataFrame:
    """Ids that are in the inventory already, for the documents."""
    return t.labels.select(_text("doc_id").alias("video_id"))


LABELLED = """
labelled as (select cast(doc_id as varchar) as video_id from labels)"""


def downloads(t) -> DataFrame:
    """What a fetcher might report for the documents, with all its gaps, and with ids
    that two sources may share."""
    lang = F.col("lang")
    own = F.concat(F.lit("v"), _text("doc_id"))
    shared = F.concat(F.lit("v"), F.floor(F.col("doc_id") / 2).cast("string"))
    return t.documents.select(
        F.col("source").alias("source_url"),
        _text("doc_id").alias("entry_id"),
        F.when(lang == "es", "").when(lang == "en", shared).alias("id"),
        F.when(lang == "fr", "")
        .when(lang == "de", F.concat(F.lit("https://cdn.example/"), own))
        .alias("webpage_url"),
        F.when(lang != "fr", lang).alias("title"),
        (F.col("doc_id") > F.col("n_chars")).alias("title_known"),
        F.when(lang != "de", F.col("n_chars") / 7.0).alias("duration"),
        F.when(F.col("n_chars") > 5000, "too long").alias("error"),
    )


DOWNLOADS = """
downloads as (
  select source as source_url, cast(doc_id as varchar) as entry_id,
         case when lang = 'es' then '' when lang = 'en' then 'v' || cast(doc_id // 2 as varchar) end as id,
         case when lang = 'fr' then ''
              when lang = 'de' then 'https://cdn.example/v' || cast(doc_id as varchar) end as webpage_url,
         case when lang <> 'fr' then lang end as title,
         doc_id > n_chars as title_known,
         case when lang <> 'de' then n_chars / 7.0 end as duration,
         case when n_chars > 5000 then 'too long' end as error
  from documents)"""


def document_files(t) -> DataFrame:
    """Downloaded files of the documents: complete, partial, and in two formats."""
    name = F.when(F.col("lang") == "en", F.concat(F.lit("v"), _text("doc_id"))).otherwise(
        _text("doc_id")
    )
    ending = (
        F.when(F.col("n_chars") > 2000, F.array(F.lit(".mp4.part")))
        .when(F.col("n_chars") > 1000, F.array(F.lit(".webm"), F.lit(".mp4")))
        .when(F.col("n_chars") > 300, F.array(F.lit(".f137.mp4")))
        .otherwise(F.array(F.lit("_mp4")))
    )
    return t.documents.select(name.alias("name"), F.explode(ending).alias("ending")).select(
        F.concat(F.lit("videos/raw/"), "name", "ending").alias("path")
    )


DOCUMENT_FILES = """
document_files as (
  select 'videos/raw/' || name || unnest(ending) as path
  from (select case when lang = 'en' then 'v' else '' end || cast(doc_id as varchar) as name,
               case when n_chars > 2000 then ['.mp4.part']
                    when n_chars > 1000 then ['.webm', '.mp4']
                    when n_chars > 300 then ['.f137.mp4'] else ['_mp4'] end as ending
        from documents)),
document_names as (
  select path, substr(path, length('videos/raw/') + 1) as name
  from document_files where path not like '%.part'),
document_stems as (
  select video_id, min(path) as path_local
  from (select path, split_part(name, '.', 1) as video_id from document_names where name like '%.%'
        union all
        select path, split_part(name, '.', 1) || '.' || split_part(name, '.', 2)
        from document_names where name like '%.%.%')
  group by 1)"""


def arrivals(t) -> DataFrame:
    """Line items as rows offered for the inventory, many per id."""
    return t.lineitem.select(
        _text("l_orderkey").alias("video_id"),
        F.concat(F.lit("https://sup.example/"), _text("l_suppkey")).alias("source_url"),
        F.concat(_text("l_partkey"), F.lit("-"), _text("l_linenumber")).alias("title"),
        F.floor("l_extendedprice").cast("bigint").alias("duration"),
        F.lit("").alias("path_local"),
        F.lit("pending").alias("status_fb"),
        F.col("l_shipdate").alias("created_at"),
        F.col("l_shipdate").alias("updated_at"),
    )


#: Order of arrival: total over the columns of `arrivals`.
ARRIVAL_ORDER = ("created_at", "title", "source_url", "duration")

ARRIVALS = """
arrivals as (
  select cast(l_orderkey as varchar) as video_id,
         'https://sup.example/' || cast(l_suppkey as varchar) as source_url,
         cast(l_partkey as varchar) || '-' || cast(l_linenumber as varchar) as title,
         cast(floor(l_extendedprice) as bigint) as duration,
         '' as path_local, 'pending' as status_fb,
         l_shipdate as created_at, l_shipdate as updated_at
  from lineitem)"""


def changes(t) -> DataFrame:
    """Events as status changes, several per item."""
    kind = F.col("event_type")
    return t.events.select(
        _text("user_id").alias("video_id"),
        F.when(kind == "error", "failed")
        .when(kind == "purchase", "posted")
        .when(kind == "click", "ready")
        .otherwise("pending")
        .alias("status_fb"),
        "ts",
        "event_id",
    )


CHANGES = """
changes as (
  select cast(user_id as varchar) as video_id,
         case event_type when 'error' then 'failed' when 'purchase' then 'posted'
                         when 'click' then 'ready' else 'pending' end as status_fb,
         ts, event_id
  from events)"""


def patches(t) -> DataFrame:
    """Events as patches: each kind sets other columns, and errors set a null."""
    kind = F.col("event_type")
    names = lambda *cols: F.array(*(F.lit(c) for c in cols))
    return t.events.select(
        _text("user_id").alias("video_id"),
        F.when(kind == "click", "ready").when(kind == "error", "failed").alias("status_fb"),
        F.when(kind == "view", F.concat(F.lit("t"), _text("event_id"))).alias("title"),
        F.when(
            kind == "click", F.concat(F.lit("videos/processed/"), _text("event_id"))
        ).alias("path_local"),
        F.when(kind == "purchase", F.floor("value").cast("bigint")).alias("duration"),
        F.when(kind == "click", names("status_fb", "path_local"))
        .when(kind == "error", names("status_fb", "path_local"))
        .when(kind == "view", names("title"))
        .when(kind == "purchase", names("duration"))
        .otherwise(F.array().cast("array<string>"))
        .alias("set_cols"),
        F.col("ts").alias("at"),
        "event_id",
    )


PATCHES = """
patches as (
  select cast(user_id as varchar) as video_id, event_type,
         case event_type when 'click' then 'ready' when 'error' then 'failed' end as status_fb,
         case when event_type = 'view' then 't' || cast(event_id as varchar) end as title,
         case when event_type = 'click' then 'videos/processed/' || cast(event_id as varchar) end as path_local,
         case when event_type = 'purchase' then cast(floor(value) as bigint) end as duration,
         ts as "at", event_id
  from events),
folded as (
  select a.video_id, s.status_fb, n.title, s.path_local, d.duration, a."at",
         s.video_id is not null as set_status, n.video_id is not null as set_title,
         d.video_id is not null as set_duration
  from (select video_id, max("at") as "at" from patches group by 1) a
  left join (select * from patches where event_type in ('click', 'error')
             qualify row_number() over (partition by video_id order by "at" desc, event_id desc) = 1) s
    on s.video_id = a.video_id
  left join (select * from patches where event_type = 'view'
             qualify row_number() over (partition by video_id order by "at" desc, event_id desc) = 1) n
    on n.video_id = a.video_id
  left join (select * from patches where event_type = 'purchase'
             qualify row_number() over (partition by video_id order by "at" desc, event_id desc) = 1) d
    on d.video_id = a.video_id)"""

SPARK_VIEWS = {
    f.__name__: f
    for f in (
        inv,
        spread,
        files,
        listings,
        documents_listed,
        labelled,
        downloads,
        document_files,
        arrivals,
        changes,
        patches,
    )
}

SQL_VIEWS = {
    "inv": INV,
    "spread": SPREAD,
    "files": FILES,
    "entries": LINKS,
    "documents_listed": DOCUMENTS_LISTED,
    "labelled": LABELLED,
    "downloads": DOWNLOADS,
    "document_files": DOCUMENT_FILES,
    "arrivals": ARRIVALS,
    "changes": CHANGES,
    "patches": PATCHES,
}
