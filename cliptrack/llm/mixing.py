"""Sources mixed to target weights by Poisson replication."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Share of a source in the mix grows with its size to this power.
POWER = 0.7
SEED = "mix-1"


def uniform(seed: str, *key: Column) -> Column:
    """A number in [0, 1) from the md5 of the seed and the key's parts."""
    digest = F.md5(F.concat_ws("|", F.lit(seed), *key).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def chances(rate: Column) -> Column:
    """The Poisson distribution of a mean rate: the chance of at most 0, 1, 2, ...

    As far as a double can tell the chance from 1. The terms go by their logarithms,
    so a large rate doesn't underflow. Null or non-positive rate: no count above 0.
    """
    last = F.ceil(rate + 12 * F.sqrt(rate) + 30).cast("int")
    start = F.struct(
        (-rate).alias("log"), F.exp(-rate).alias("sum"), F.array(F.exp(-rate)).alias("sums")
    )

    def step(s, k):
        log = s["log"] + F.log(rate) - F.log(k.cast("double"))
        total = s["sum"] + F.exp(log)
        return F.struct(
            log.alias("log"), total.alias("sum"), F.array_append(s["sums"], total).alias("sums")
        )

    sums = F.aggregate(F.sequence(F.lit(1), last), start, step, lambda s: s["sums"])
    return F.when(rate > 0, sums).otherwise(F.array(F.lit(1.0)))


def poisson(reached: Column, u: Column) -> Column:
    """The count at u: how many of the chances lie below it."""
    return (F.array_position(F.sort_array(F.array_append(reached, u)), u) - 1).cast("int")


def repetition_rates(
    documents: DataFrame,
    weights: Mapping[str, float] | None = None,
    power: float = POWER,
    total: float | None = None,
) -> DataFrame:
    """(source, rate): how often a document of the source is wanted on average.

    A source's weight is that given, or its characters to the power. The mix has
    `total` characters (as many as the input, unless given). Sources without weight
    or without characters get rate 0. One row a source, folded in every task first.
    """
    sizes = documents.groupBy("source").agg(
        F.sum(F.length(F.coalesce("text", F.lit("")))).cast("double").alias("chars")
    )
    if weights is None:
        weighed = sizes.withColumn("weight", F.when(F.col("chars") > 0, F.pow("chars", F.lit(power))))
    else:
        given = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair])
        weighed = sizes.withColumn("weight", F.when(F.col("chars") > 0, given[F.col("source")]))
    sums = weighed.agg(
        F.sum("weight").alias("weights"),
        F.lit(total).alias("wanted") if total is not None else F.sum("chars").alias("wanted"),
    )
    return weighed.crossJoin(F.broadcast(sums)).select(
        "source",
        F.coalesce(F.expr("weight / weights * wanted / chars"), F.lit(0.0)).alias("rate"),
    )


def mixed(
    documents: DataFrame,
    weights: Mapping[str, float] | None = None,
    power: float = POWER,
    total: float | None = None,
    seed: str = SEED,
) -> DataFrame:
    """Documents repeated by hash-seeded Poisson counts, in one global random order.

    Adds rate, copies, copy (from 1) and shuffle_key, by which the rows are ordered
    over all partitions. A document's count follows from its doc_id and its source's
    rate, so a task that runs again repeats it, and rows that repeat an id get the
    same count and key; their place in the input decides between them, so that many of
    them spread over many tasks. Without an id the text stands for it. A null source is
    a source of its own, without weight if weights are given. Very long texts are texts
    like any other. Other columns stay as they are, whatever their names; columns named
    like those added are replaced.
    """
    rates = repetition_rates(documents, weights, power, total)
    added = ("rate", "copies", "copy", "shuffle_key")
    kept = [c for c in documents.columns if c not in added]
    marked = F.coalesce(F.concat(F.lit("+"), "source"), F.lit("-"))
    # The row stays in one column, beside which any name is free.
    rows = documents.select(
        F.struct(*kept).alias("row"),
        marked.alias("mark"),
        F.coalesce(
            F.col("doc_id").cast("string"), F.md5(F.coalesce("text", F.lit("")).cast("binary"))
        ).alias("key"),
        F.monotonically_increasing_id().alias("number"),
    )
    # Plain equi-join: Spark broadcasts the rates if their measured size allows it,
    # and else splits a hot source at run time.
    joined = rows.join(rates.select(marked.alias("mark"), "rate", chances(F.col("rate")).alias("reached")), "mark")
    return (
        joined.withColumn("copies", poisson(F.col("reached"), uniform(seed, F.col("key"))))
        .withColumn("copy", F.explode(F.expr("sequence(1, greatest(copies, 1))")))
        .where("copies > 0")
        .withColumn("shuffle_key", uniform(seed + "-order", F.col("key"), F.col("copy")))
        .orderBy("shuffle_key", "number", "copy")
        .select("row.*", *added)
    )


def mix_sql(table: str, power: float = POWER, seed: str = SEED, columns: str = "d.*") -> str:
    """DuckDB SQL for mixed(table) without weights and total."""
    return f"""
with mix_sizes as (
    select source, sum(length(coalesce(text, '')))::double as chars from {table} group by source
), mix_rates as (
    select source, coalesce(weight / (sum(weight) over ()) * (sum(chars) over ()) / chars, 0.0) as rate
    from (select *, case when chars > 0 then pow(chars, {power}) end as weight from mix_sizes)
), mix_chances as (
    select source, rate, list(reached order by k) as reached from (
        select source, rate, k,
            sum(exp(-rate + k * ln(rate) - lgamma(k + 1))) over (partition by source order by k) as reached
        from (select *, unnest(range((ceil(rate + 12 * sqrt(rate) + 30))::bigint)) as k
              from mix_rates where rate > 0))
    group by source, rate
), mix_drawn as (
    select d.*, rate, coalesce(d.doc_id::varchar, md5(coalesce(d.text, ''))) as mix_key,
        len(list_filter(reached, lambda c:
            ('0x' || substr(md5('{seed}|' || mix_key), 1, 13))::bigint / 4503599627370496.0 > c)) as copies
    from {table} d join mix_chances m on d.source is not distinct from m.source
)
select {columns}, d.rate, d.copies::int as copies, d.copy::int as copy,
    ('0x' || substr(md5('{seed}-order|' || mix_key || '|' || copy), 1, 13))::bigint / 4503599627370496.0
        as shuffle_key
from (select *, unnest(range(1, copies + 1)) as copy from mix_drawn where copies > 0) d
"""


def op6_mixing(spark, sf_dir: str) -> DataFrame:
    """All documents, mixed to weights that grow with a source's size to POWER.

    The rate is given to six places.
    """
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mixed(documents).withColumn("rate", F.round("rate", 6))


OP6_SQL = mix_sql(
    "documents", columns="d.doc_id, d.text, d.lang, d.source, d.n_chars"
).replace("d.rate,", "round(d.rate, 6) as rate,")
