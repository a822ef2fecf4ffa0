"""The trie of all prefixes of conversations, and totals over its subtrees.

Van Emde Boas recursion over depth. The sequences are cut at half depth; the prefixes
that end at the cut get names; the upper trie (the sequences above the cut) and the
lower forests (one below each name) are built in the same way, all of one size at a
time, by joins that run in parallel. What is left at the end are ranges of one turn,
each below the name of the prefix before it: the nodes. Going back, the totals of each
lower forest are grafted on the node that it hangs from and on the nodes above it as far
as its upper trie reaches; so a node hears of its descendants in as many steps as the
depth has bits, and never of each from each.

Names are 128-bit digests while the trie is built. A node is then known by its depth and
its smallest member, which no other node of that depth can share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cliptrack.llm.sequences import chained, laid_out, numbered
from cliptrack.llm.shared import written

#: Turns of a sequence that one graft meets at a time; a longer stretch is cut.
STRETCH = 1024


def _digest(value: Column) -> Column:
    return F.unhex(F.substring(F.sha2(value, 256), 1, 32))


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, len, token, size): all turns in order, and the length of theirs.

    Order: turn, null first, then the digest of role and text. A null role or text is
    empty; size counts the text's UTF-8 bytes. Rows without conv_id take no part. Rows
    that repeat are turns of their own.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    # The role's length keeps role and text apart.
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        "turn",
        _digest(whole.cast("binary")).alias("token"),
        F.octet_length(text).cast("bigint").alias("size"),
    )
    laid = laid_out(rows, "conv_id", [F.col("turn").asc_nulls_first(), F.col("token")])
    return numbered(laid.drop("turn"), "conv_id").drop("_at")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(all conv_ids with their new len, the new turns): openings taken from a neighbour.

    Conversation c gets the first h turns of c - c % 5 (all, if fewer; none, if there is
    no such conversation), then its own turns after its first h; h = crc32(c) % 9.
    """
    turns = written(turns)
    lengths = turns.where("pos = 0").select("conv_id", "len")
    opening = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    of_base = lengths.select(F.col("conv_id").alias("base"), F.col("len").alias("base_len"))
    plan = (
        lengths.withColumn("h", opening)
        .withColumn("base", F.col("conv_id") - F.col("conv_id") % 5)
        .join(of_base, "base", "left")
        .withColumn("taken", F.least("h", F.coalesce("base_len", F.lit(0))))
        .withColumn("new_len", F.col("taken") + F.greatest(F.col("len") - F.col("h"), F.lit(0)))
        .select("conv_id", "base", "h", "taken", F.col("new_len").alias("len"))
    )
    plan = written(plan)
    given = plan.where("taken > 0").select(
        F.col("conv_id").alias("own"), F.col("base").alias("conv_id"), "taken", F.col("len").alias("new_len")
    )
    # At most eight turns of a base, for at most nine conversations.
    shared = (
        turns.where((F.col("pos") < 8) & (F.col("conv_id") % 5 == 0))
        .join(given, "conv_id")
        .where("pos < taken")
        .select(F.col("own").alias("conv_id"), "pos", F.col("new_len").alias("len"), "token", "size")
    )
    own = (
        turns.drop("len")
        .where(F.col("pos") >= opening)
        .join(plan.drop("base"), "conv_id")
        .select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "len", "token", "size")
    )
    return plan.select("conv_id", "len"), written(own.unionAll(shared))


def _named(lengths: DataFrame, turns: DataFrame, bits: int) -> DataFrame:
    """The turns with the name of the prefix that ends with each.

    A range of 2^(b+1) turns is cut in its middle: the upper half keeps the name of what
    comes before the range, the lower half gets the name of the prefix at the cut, from
    that and the digest of the upper half.
    """
    blocks = [turns.select("conv_id", F.col("pos").alias("at"), F.col("token").alias("block"))]
    for _ in range(1, bits):
        both = F.struct("at", "block")
        blocks.append(
            written(
                blocks[-1]
                .groupBy("conv_id", F.shiftright("at", 1).alias("half"))
                .agg(F.count("*").alias("n"), F.min(both).alias("a"), F.max(both).alias("b"))
                .where("n = 2")
                .select(
                    "conv_id",
                    F.col("half").alias("at"),
                    _digest(F.concat("a.block", "b.block")).alias("block"),
                )
            )
        )
    names = lengths.where("len > 0").select(
        "conv_id", "len", F.lit(0).cast("bigint").alias("range"), F.unhex(F.lit("")).alias("above")
    )
    for b in range(bits - 1, -1, -1):
        upper = blocks[b].where("at % 2 = 0").select(
            "conv_id", F.shiftright("at", 1).alias("range"), "block"
        )
        low = F.col("range") * 2 + 1
        halves = F.array_compact(
            F.array(
                F.struct((low - 1).alias("range"), F.col("above").alias("above")),
                F.when(
                    F.col("len") > low * F.lit(1 << b),
                    F.struct(low.alias("range"), _digest(F.concat("above", "block")).alias("above")),
                ),
            )
        )
        names = names.join(upper, ["conv_id", "range"], "left").select(
            "conv_id", "len", F.inline(halves)
        )
    return names.join(turns.drop("len").withColumnRenamed("pos", "range"), ["conv_id", "range"]).select(
        "conv_id",
        "len",
        (F.col("range") + 1).alias("depth"),
        _digest(F.concat("above", "token")).alias("name"),
        "size",
    )


def _grafted(nodes: DataFrame, paths: DataFrame, bits: int) -> list[DataFrame]:
    """What every node gets from the forests below it: (conv_id, depth, leaves, saved).

    Step b takes the forests that hang from the cuts of ranges of 2^(b+1) turns. The
    nodes above a cut are those on the path of its smallest member.
    """
    grafts: list[DataFrame] = []
    above = F.col("depth") - 1
    for b in range(bits):
        half = 1 << b
        tops = (above.bitwiseAND(half) != 0) & (above.bitwiseAND(half - 1) == 0)
        found = nodes.where(tops).select("conv_id", "depth", "parent_conv_id", "leaves", "saved")
        for graft in grafts:
            found = found.unionByName(graft.where(tops), allowMissingColumns=True)
        forests = (
            found.groupBy("conv_id", "depth")
            .agg(F.max("parent_conv_id").alias("member"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
            .groupBy("member", "depth")
            .agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
            # The cut lies before the tops: places (depth - 1 - half, depth - 1].
            .select(
                F.col("member").alias("conv_id"),
                F.shiftright(above - 1, b + 1).alias("range"),
                F.explode(
                    F.sequence(
                        F.floor((above - half) / STRETCH), F.floor((above - 1) / STRETCH)
                    )
                ).alias("stretch"),
                "leaves",
                "saved",
            )
        )
        range_start = F.shiftleft(F.shiftright(above, b + 1), b + 1)
        over = paths.where((above.bitwiseAND(half) == 0) & (F.col("len") >= range_start + half)).select(
            "conv_id",
            "depth",
            "node",
            F.shiftright(above, b + 1).alias("range"),
            F.floor(above / STRETCH).alias("stretch"),
        )
        grafts.append(
            written(
                over.join(forests, ["conv_id", "range", "stretch"])
                .groupBy(F.col("node").alias("conv_id"), "depth")
                .agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
            )
        )
    return grafts


def trie(lengths: DataFrame, turns: DataFrame) -> DataFrame:
    """The trie of sequences: (conv_id, len) of all of them, and their turns
    (conv_id, pos, len, token, size).

    One row a node: conv_id (its smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256. Sequences without turns end in the
    root. Without sequences there is no row.
    """
    spark = lengths.sparkSession
    top, longest = lengths.agg(F.min("conv_id"), F.max("len")).first()
    if top is None:
        return spark.createDataFrame(
            [],
            "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
            "n_leaves long, saved_tokens long, ends_sha256 string",
        )
    bits = max(longest - 1, 0).bit_length()
    named = written(_named(lengths, turns, bits))
    members = named.groupBy("depth", "name").agg(
        F.min("conv_id").alias("node"), F.count("*").alias("n_convs"), F.max("size").alias("size")
    )
    members = written(members)
    paths = written(
        named.join(members.select("depth", "name", "node"), ["depth", "name"]).select(
            "conv_id", "depth", "len", "node"
        )
    )
    parents = paths.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("node").alias("parent_conv_id"))
    nodes = written(
        members.select(F.col("node").alias("conv_id"), "depth", "n_convs", "size")
        .join(parents, ["conv_id", "depth"], "left")
        .withColumn("parent_conv_id", F.when(F.col("depth") == 1, F.lit(top)).otherwise(F.col("parent_conv_id")))
    )
    children = nodes.groupBy(
        F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")
    ).agg(F.count("*").alias("n_children"))
    nodes = written(
        nodes.join(children, ["conv_id", "depth"], "left")
        .withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("bigint"))
        .withColumn("leaves", (F.col("n_children") == 0).cast("bigint"))
        .withColumn("saved", (F.col("n_convs") - 1) * F.col("size"))
        .drop("size")
    )
    own = nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "leaves", "saved")
    for graft in _grafted(nodes, paths, bits):
        own = own.unionByName(graft, allowMissingColumns=True)
    totals = own.groupBy("conv_id", "depth").agg(
        *(F.max(c).alias(c) for c in ("parent_conv_id", "n_convs", "n_children")),
        F.sum("leaves").alias("n_leaves"),
        F.sum("saved").alias("saved_tokens"),
    )
    totals = written(totals)
    root = totals.where("depth = 1").agg(
        F.count("*").alias("n_children"),
        F.sum("n_leaves").alias("n_leaves"),
        F.sum("saved_tokens").alias("saved_tokens"),
    )
    root = root.join(lengths.agg(F.count("*").alias("n_convs"))).select(
        F.lit(top).cast("bigint").alias("conv_id"),
        F.lit(0).cast("bigint").alias("depth"),
        F.lit(None).cast("bigint").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        F.coalesce("n_leaves", F.lit(1)).cast("bigint").alias("n_leaves"),
        F.coalesce("saved_tokens", F.lit(0)).cast("bigint").alias("saved_tokens"),
    )
    ended = paths.where("depth = len").select("node", "depth", "conv_id").unionAll(
        lengths.where("len = 0").select(
            F.lit(top).cast("bigint").alias("node"), F.lit(0).cast("bigint").alias("depth"), "conv_id"
        )
    )
    ends = chained(
        ended.withColumn("text", F.col("conv_id").cast("string")), ["node", "depth"], "conv_id", "text", ","
    ).select(F.col("node").alias("conv_id"), "depth", F.col("sha256").alias("ends_sha256"))
    return (
        totals.unionByName(root)
        .join(ends, ["conv_id", "depth"], "left")
        .withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)))
    )


def op11_trie(spark, sf_dir: str) -> DataFrame:
    """The prefix trie of all rebuilt conversations."""
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return trie(*rebuilt(turns_of(conversations)))


#: crc32 by its bits, since DuckDB has none.
_CRC = """xor(4294967295, list_reduce(
    list_prepend(4294967295::ubigint, [ord(x)::ubigint for x in string_split(conv_id::varchar, '')]),
    lambda c, byte: list_reduce(
        list_prepend(xor(c, byte), range(8)::ubigint[]),
        lambda v, i: case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end)))"""

OP11_SQL = f"""
with given as (
    select conv_id, turn, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) as token,
           strlen(coalesce(text, '')) as size
    from conversations where conv_id is not null
), turns as (
    select *, row_number() over (partition by conv_id order by turn nulls first, token) - 1 as pos from given
), convs as (
    select conv_id, conv_id - conv_id % 5 as base, ({_CRC})::bigint % 9 as h
    from (select distinct conv_id from turns)
), placed as (
    select c.conv_id, t.pos as place, 0 as part, t.token, t.size
    from convs c join turns t on t.conv_id = c.base and t.pos < c.h
    union all
    select c.conv_id, t.pos, 1, t.token, t.size from convs c join turns t on t.conv_id = c.conv_id and t.pos >= c.h
), path as (
    select conv_id, size, row_number() over w as depth, count(*) over (partition by conv_id) as len,
           string_agg(token, '') over w as name
    from placed window w as (partition by conv_id order by part, place)
    union all
    select conv_id, 0, 0, (select count(*) from placed p where p.conv_id = c.conv_id), '' from convs c
), nodes as (
    select depth, name, min(conv_id) as conv_id, count(*) as n_convs, max(size) as size,
           sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (depth = len), '')) as ends_sha256
    from path group by depth, name
), counted as (
    select n.*, (select count(*) from nodes c where c.depth = n.depth + 1 and substr(c.name, 1, length(c.name) - 64) = n.name)
        as n_children
    from nodes n
)
select n.conv_id, n.depth::bigint as depth, any_value(p.conv_id) as parent_conv_id,
       any_value(n.n_convs)::bigint as n_convs, any_value(n.n_children)::bigint as n_children,
       count(*) filter (below.n_children = 0)::bigint as n_leaves,
       sum((below.n_convs - 1) * below.size)::bigint as saved_tokens, any_value(n.ends_sha256) as ends_sha256
from counted n
left join nodes p on p.depth = n.depth - 1 and p.name = substr(n.name, 1, greatest(length(n.name) - 64, 0)) and n.depth > 0
join counted below on below.depth >= n.depth and starts_with(below.name, n.name)
group by n.conv_id, n.depth
"""
