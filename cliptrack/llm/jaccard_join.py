"""Near-equal documents by an exact Jaccard join on word n-grams.

Grams are ordered by how rare they are. Two sets that overlap enough share one of
the rarest grams of each (the prefixes), so only documents that share a prefix gram
are compared, and of those only pairs whose lengths, positions and parities allow
the overlap. What is left is verified on the whole sets, once per pair.

Equal sets are one class from the start. A pair is compared for the first gram that both
share, not for each. Of the pairs inside a group of documents that share a gram, first
those with the group's smallest class are verified, then those of what is still apart
with one class after another; at last all pairs that are still apart. So finding the
components costs a group of copies its size, not its square. Every link lies inside a component, so the links are counted
there, block by block, on what sets differ in; only sums leave a pair of blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cliptrack.llm.shared import CHUNK, components, mix, tidy, visible, word_hashes, written

#: The counts by which rare grams come first are kept for so many hash values; a
#: gram that shares its value with others only moves back in the order.
BITS = 18
_PARITY = 1024
#: A member knows so many grams before its own, by which a pair is known from there.
BEFORE = 3
#: Classes of a gram's group with which all others are compared, in one round after another,
#: before all that are still apart are.
HUBS = (1, 8)
#: Bytes of different sets for each task that verifies pairs, on average.
TASK = 16 << 20
#: Classes of a component that are compared at once with as many others, and the bytes
#: of their sets, on average.
BLOCK = 2048
BLOCK_BYTES = 16 << 20
#: Bytes of the sets of components that a task takes at a time, on average.
BUNDLE = 8 << 20
#: Rows of numbers that are sent to every task, at most: some 40 bytes each.
FEW = 1 << 20
#: Cells of the table in which overlaps are counted at a time.
_CELLS = 4 << 20
_ODD = mix(np.arange(1, 65, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)) | np.uint64(1)


def gram_sets(texts: list[str | None], width: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its word n-grams.

    A text of fewer words is one gram; one without words has none. Texts go by parts of
    some CHUNK characters, so that a batch of many takes no more memory.
    """
    part, size = [], 0
    for text in texts:
        if part and size + len(text or "") > CHUNK:
            yield from _gram_sets(part, width)
            part, size = [], 0
        part.append(text)
        size += len(text or "")
    if part:
        yield from _gram_sets(part, width)


def _gram_sets(texts: list[str | None], width: int) -> Iterator[np.ndarray]:
    words, begin = word_hashes(texts)
    rows = np.zeros(max(len(words) - width + 1, 0), np.uint64)
    for k in range(width):
        rows += mix(words[k : k + len(rows)] ^ _ODD[k]) * _ODD[k]
    rows = mix(rows)
    for start, end in zip(begin[:-1], begin[1:], strict=True):
        if end - start >= width:
            yield np.unique(rows[start : end - width + 1])
        elif end > start:
            part = words[start:end]
            short = sum(mix(part[k : k + 1] ^ _ODD[k]) * _ODD[k] for k in range(len(part)))
            yield mix(short + _ODD[40 + len(part)])
        else:
            yield np.zeros(0, np.uint64)


def class_of(grams: np.ndarray) -> int:
    """One 64-bit number for equal sets; of no set for the empty one (0)."""
    if not len(grams):
        return 0
    with np.errstate(over="ignore"):
        both = mix(np.array([mix(grams + _ODD[50]).sum() + np.uint64(len(grams))]))
        return int(mix(both ^ grams.sum()).view(np.int64)[0])


def prefix_length(size: int, percent: int) -> int:
    return size - (percent * size + 99) // 100 + 1


def _class_rows(width: int):
    """doc_id, size and class of each document; how many grams fall on each hash value."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = np.zeros(1 << BITS, np.int64)
        for frame in frames:
            sizes, classes = [], []
            for grams in gram_sets(frame["text"].tolist(), width):
                seen += np.bincount((grams >> np.uint64(64 - BITS)).astype(np.int64), minlength=1 << BITS) if len(grams) > 4096 else 0
                if 0 < len(grams) <= 4096:
                    np.add.at(seen, (grams >> np.uint64(64 - BITS)).astype(np.int64), 1)
                sizes.append(len(grams))
                classes.append(class_of(grams))
            yield pd.DataFrame(
                {"doc_id": frame["doc_id"], "size": sizes, "cid": classes, "bucket": -1, "seen": 0}
            )
        at = np.flatnonzero(seen)
        yield pd.DataFrame({"doc_id": None, "size": 0, "cid": 0, "bucket": at, "seen": seen[at]})
        tidy()

    return run


def _prefix_rows(width: int, percent: int, seen):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        had = set()  # copies within one task need no second row
        for frame in frames:
            out = []
            for grams in gram_sets(frame["text"].tolist(), width):
                cid = class_of(grams)
                if not len(grams) or cid in had:
                    continue
                had.add(cid)
                rare = seen.value[(grams >> np.uint64(64 - BITS)).astype(np.int64)]
                # Stable, so that of equal counts the smaller hash comes first.
                order = np.argsort(rare, kind="stable")[: prefix_length(len(grams), percent)]
                parity = np.bincount((grams % np.uint64(_PARITY)).astype(np.int64), minlength=_PARITY) & 1
                bits = np.packbits(parity.astype(np.uint8)).view(np.int64)
                out.append((cid, len(grams), grams[order].view(np.int64), bits))
            yield pd.DataFrame(out, columns=["cid", "size", "prefix", "parity"])
        tidy()

    return run


def _set_rows(width: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sets = list(gram_sets(frame["text"].tolist(), width))
            yield pd.DataFrame(
                {
                    "cid": [class_of(s) for s in sets], "size": [len(s) for s in sets],
                    "grams": [s.tobytes() for s in sets], "sketch": [sketch(s).tobytes() for s in sets],
                }
            )
        tidy()

    return run


def sketch(grams: np.ndarray) -> np.ndarray:
    """Parities as in may_link, of one to two bits a gram, in bytes: 1/64 to 1/32 of the
    set. 1024 parities of a large set tell it from no other."""
    bits = 1 << max(10, (len(grams) - 1).bit_length())
    parity = np.bincount((grams & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(parity.astype(np.uint8), bitorder="little")


def differing(x: np.ndarray, y: np.ndarray) -> int:
    """How many parities of two sketches differ; at least so many elements of the sets do."""
    while len(x) != len(y):
        x, y = (x, y) if len(x) > len(y) else (y, x)
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def _by_sketches(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those pairs (a, b) whose sketches allow a link, so that few sets move for nothing."""
    for side in ("a", "b"):
        own = sets.select(*(F.col(c).alias(n) for c, n in (("cid", side), ("size", f"size_{side}"), ("sketch", f"sketch_{side}"))))
        pairs = pairs.join(own, side)
    least = _least_overlap(percent, F.col("size_a"), F.col("size_b"))
    allowed = F.col("size_a") + F.col("size_b") - 2 * least
    rows = pairs.select("a", "b", "sketch_a", "sketch_b", allowed.alias("allowed"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            raws = zip(frame["sketch_a"], frame["sketch_b"], frame["allowed"], strict=True)
            keep = [differing(np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)) <= n for x, y, n in raws]
            yield frame.loc[np.array(keep, bool), ["a", "b"]]

    # A set may be there twice.
    return rows.mapInPandas(run, "a long, b long").distinct()




def _least_overlap(percent: int, a: Column, b: Column) -> Column:
    """The smallest overlap of sets of two sizes that is similar enough."""
    return F.floor((percent * (a + b) + percent + 99) / (percent + 100)).cast("long")


def filters_by_place(percent: int, a: str, b: str) -> Column:
    """Length and positional filter on two members of the group of their first common gram.

    Before it they have nothing in common, so the overlap is at most the gram and what
    follows it. Pairs that can link pass at their first common gram, at others they needn't.
    """
    size_a, size_b = F.col(f"{a}.size"), F.col(f"{b}.size")
    at_a, at_b = F.col(f"{a}.pos"), F.col(f"{b}.pos")
    most = F.least(size_a - at_a, size_b - at_b)
    return (100 * F.least(size_a, size_b) >= percent * F.greatest(size_a, size_b)) & (
        most >= _least_overlap(percent, size_a, size_b)
    )


def may_link(percent: int, a: str, b: str) -> Column:
    """The filters by place, the suffix filter, and that no common gram is known before.

    For the suffix filter a set has 1024 parities: where two differ, so do the sets, and
    more differing elements than the overlap allows rule a pair out.
    """
    size_a, size_b = F.col(f"{a}.size"), F.col(f"{b}.size")
    differ = sum(
        (F.bit_count(F.col(f"{a}.parity")[k].bitwiseXOR(F.col(f"{b}.parity")[k])) for k in range(_PARITY // 64)),
        start=F.lit(0),
    )
    known = F.lit(False)
    for i in range(BEFORE):
        for k in range(BEFORE):
            known |= F.col(f"{a}.before{i}") == F.col(f"{b}.before{k}")
    return (
        filters_by_place(percent, a, b)
        & ~F.coalesce(known, F.lit(False))
        & (differ <= size_a + size_b - 2 * _least_overlap(percent, size_a, size_b))
    )


def _with_partner(members: DataFrame, filters, percent: int) -> DataFrame:
    """Members that share a gram with another class that the filters let pass."""
    both = (F.col("m.gram") == F.col("o.gram")) & (F.col("m.cid") != F.col("o.cid"))
    return members.alias("m").join(
        members.alias("o"), both & filters(percent, "m", "o"), "left_semi"
    )


def _with_hubs(members: DataFrame, order: Column, hubs: int, percent: int) -> DataFrame:
    """Pairs (a, b) of the members of each gram with the first few of them by `order`,
    where they lie in different parts."""
    place = F.row_number().over(Window.partitionBy("gram").orderBy(order, "cid"))
    first = members.withColumn("place", place).where(F.col("place") <= hubs)
    return (
        members.alias("m")
        .join(first.alias("f"), F.col("f.gram") == F.col("m.gram"))
        .where((F.col("f.part") != F.col("m.part")) & may_link(percent, "f", "m"))
        .select(F.least("f.cid", "m.cid").alias("a"), F.greatest("f.cid", "m.cid").alias("b"))
        .distinct()
    )


def _few(rows: DataFrame) -> DataFrame:
    """Small rows, as a table; sent to all tasks unless they are many, so that the sets
    they are joined with needn't move for it."""
    rows = written(rows)
    return F.broadcast(rows) if rows.count() <= FEW else rows


def verified(
    pairs: DataFrame, sets: DataFrame, families: DataFrame, tasks: int, percent: int
) -> DataFrame:
    """Those pairs (a, b) of classes whose whole sets are similar enough.

    families: (cid, family, size). The classes that pairs connect go to one task, so that
    a set is sent once. Where they are more than a task's share, their pairs are dealt by
    the families of their two classes, and a set goes once to each task that has a pair
    of it. Families are split into parts of some 500 classes, and the number of tasks
    follows from the bytes of all sets, so a task stays the same size. Any dealing is
    right; this one sends few sets several times, as most pairs lie within a family.
    """
    pairs = written(_by_sketches(pairs, sets, percent))
    sets = sets.select("cid", "grams")
    placed = families.join(components(pairs), F.col("cid") == F.col("id")).drop("id")
    heavy = placed.groupBy("component").agg((F.sum("size") * 8 > TASK).alias("heavy"))
    placed = written(placed.join(heavy, "component"))
    for side in ("a", "b"):
        own = placed.select(F.col("cid").alias(side), F.col("family").alias(f"family_{side}"))
        pairs = pairs.join(own, side)
    pairs = pairs.join(placed.select(F.col("cid").alias("a"), "component", "heavy"), "a")
    where = F.when(F.col("heavy"), F.xxhash64("family_a", "family_b")).otherwise(F.xxhash64("component"))
    dealt = written(pairs.select(F.pmod(where, F.lit(tasks)).alias("task"), "a", "b"))
    needed = dealt.select(F.col("task").alias("to"), F.explode(F.array("a", "b")).alias("cid"))

    def run(own: pd.DataFrame, grams: pd.DataFrame) -> pd.DataFrame:
        held = {c: np.frombuffer(g, np.uint64) for c, g in zip(grams["cid"], grams["grams"], strict=True)}
        keep = []
        for a, b in zip(own["a"], own["b"], strict=True):
            x, y = held[a], held[b]
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(100 * both >= percent * (len(x) + len(y) - both))
        return own.loc[np.array(keep, bool), ["a", "b"]]

    return written(
        dealt.groupBy("task")
        .cogroup(sets.join(_few(needed.distinct()), "cid").groupBy("to"))
        .applyInPandas(run, "a long, b long")
    )


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """The sizes of the intersections of every set on the left with every one on the right."""
    sets = [*left, *right]
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, gram, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    kept = held[gram] > 1  # a gram of one set alone is in no intersection
    number = np.cumsum(held > 1) - 1
    row, gram = row[kept], number[gram[kept]]
    order = np.argsort(gram, kind="stable")
    row, gram = row[order], gram[order]
    out = np.zeros((len(left), len(right)))
    wide = max(1, _CELLS // len(sets))
    for start in range(0, int(gram[-1]) + 1 if len(gram) else 0, wide):
        a, b = np.searchsorted(gram, [start, start + wide])
        table = np.zeros((len(sets), min(wide, int(gram[-1]) + 1 - start)), np.float32)
        table[row[a:b], gram[a:b] - start] = 1
        out += table[: len(left)] @ table[len(left) :].T
    return out.astype(np.int64)


def _size_class(percent: int, size: str) -> Column:
    """Sets that are similar enough are of the same class or of neighbouring ones.

    A class is a little wider than the ratio of sizes that may link, so that rounding
    never moves such sets two classes apart.
    """
    return F.floor(F.log(F.col(size)) / (math.log(100 / percent) * (1 + 1e-9))).cast("int")


def _differences(own: pd.DataFrame, hubs: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links of every class of a small component; of a large one, differences to its hub."""
    hub = {c: np.frombuffer(g, np.uint64) for c, g in zip(hubs["component"], hubs["hub"], strict=True)}
    out = []
    for component, group in own.drop_duplicates("cid").groupby("component", sort=False):
        sets = [np.frombuffer(g, np.uint64) for g in group["grams"]]
        if component in hub:
            far = [np.setxor1d(s, hub[component], assume_unique=True).tobytes() for s in sets]
            out.append(group.assign(links=-1, far=far))
        else:
            sizes = group["size"].to_numpy()
            both, total = overlaps(sets, sets), sizes[:, None] + sizes
            near = 100 * both >= percent * (total - both)
            np.fill_diagonal(near, False)
            out.append(group.assign(links=near.astype(np.int64) @ group["weight"].to_numpy(), far=b""))
    names = ["component", "cid", "weight", "size", "links", "far"]
    return pd.concat(out)[names] if out else pd.DataFrame(columns=names)


def _block_links(group: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links between two blocks of a component, from their classes' differences to its hub.

    Two sets differ where their differences to a third do: so much of both is common.
    """
    first = group.iloc[0]
    one = (group["k"] == first["ik"]) & (group["b"] == first["ib"])
    two = (group["k"] == first["jk"]) & (group["b"] == first["jb"])
    x, y = group[one], group[two]
    if not len(x) or not len(y):
        return pd.DataFrame({"cid": [], "links": []}, dtype="int64")
    left, right = ([np.frombuffer(g, np.uint64) for g in side["far"]] for side in (x, y))
    lengths = np.array([len(s) for s in left])[:, None] + np.array([len(s) for s in right])
    sizes = x["size"].to_numpy()[:, None] + y["size"].to_numpy()
    both = (sizes - (lengths - 2 * overlaps(left, right))) // 2
    near = 100 * both >= percent * (sizes - both)
    same = bool((one == two).all())
    if same:
        np.fill_diagonal(near, False)
    out = pd.DataFrame({"cid": x["cid"], "links": near.astype(np.int64) @ y["weight"].to_numpy()})
    if not same:
        more = pd.DataFrame({"cid": y["cid"], "links": near.T.astype(np.int64) @ x["weight"].to_numpy()})
        out = pd.concat([out, more])
    return out


def link_counts(rows: DataFrame, joined: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(cid, links) of the classes in components: how many rows of other classes link.

    A whole set goes to one task. Small components are compared there. The classes of a
    large one are there reduced to their differences from its smallest class, the hub,
    whose set goes to each task of the component: near copies differ in little, and two
    of them overlap by what their sizes and differences say, exactly. Only differences
    then meet in pairs of blocks; by the length filter, a class of sizes meets itself and
    its neighbours only.
    """
    sized = rows.groupBy("cid").agg(F.count("*").alias("weight"), F.first("size").alias("size"))
    own = written(joined.join(sized, F.col("id") == F.col("cid")).select("cid", "component", "weight", "size"))
    bytes_of = F.sum("size") * 8
    large = written(
        own.groupBy("component")
        .agg(F.count("*").alias("n"), F.ceil(bytes_of / BLOCK_BYTES).cast("int").alias("parts"))
        .where((F.col("n") > BLOCK) | (F.col("parts") > 1))
    )
    held = own.agg(bytes_of).first()[0] or 0
    bundles = max(1, math.ceil(held / BUNDLE))
    bundle = lambda part: F.pmod(F.xxhash64("component", part), F.lit(bundles))
    placed = (
        own.join(large.select("component", "parts"), "component", "left")
        .withColumn("part", F.pmod(F.xxhash64("cid"), F.coalesce("parts", F.lit(1))).cast("int"))
        .select(bundle(F.col("part")).alias("bundle"), "component", "cid", "weight", "size")
    )
    whole = sets.select("cid", "grams").join(_few(placed), "cid")
    sent = (
        large.select("component", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
        .select(bundle(F.col("part")).alias("to"), "component")
        .distinct()
    )
    hubs = sets.select(F.col("cid").alias("component"), F.col("grams").alias("hub")).join(_few(sent), "component")
    found = written(
        whole.groupBy("bundle")
        .cogroup(hubs.groupBy("to"))
        .applyInPandas(
            lambda own, hubs: _differences(own, hubs, percent),
            "component long, cid long, weight long, size long, links long, far binary",
        )
    )
    done = found.where("links >= 0").select("cid", "links")
    if large.isEmpty():
        return done
    spread = found.where("links < 0").withColumn("k", _size_class(percent, "size"))
    blocks = F.ceil(F.greatest(F.count("*") / BLOCK, F.sum(F.octet_length("far")) / BLOCK_BYTES)).cast("int")
    # At most some hundred classes of sizes a component.
    classes = (
        spread.groupBy("component", "k")
        .agg(blocks.alias("n"))
        .groupBy("component")
        .agg(F.map_from_entries(F.collect_list(F.struct("k", "n"))).alias("blocks"))
    )

    def pairs(at: Column, pair) -> Column:
        many = F.try_element_at("blocks", at)
        some = F.transform(F.sequence(F.lit(0), many - 1), pair)
        return F.when(many.isNotNull(), some).otherwise(F.array().cast("array<struct<ik:int,ib:int,jk:int,jb:int>>"))

    def pair(ik, ib, jk, jb):
        return F.struct(ik.alias("ik"), ib.alias("ib"), jk.alias("jk"), jb.alias("jb"))

    k, b = F.col("k"), F.col("b")
    dealt = (
        spread.join(classes, "component")
        .withColumn("b", F.pmod(F.xxhash64("cid"), F.try_element_at("blocks", k)).cast("int"))
        .withColumn(
            "pair",
            F.explode(
                F.concat(
                    pairs(k, lambda o: pair(k, F.least(b, o), k, F.greatest(b, o))),
                    pairs(k + 1, lambda o: pair(k, b, k + 1, o)),
                    pairs(k - 1, lambda o: pair(k - 1, o, k, b)),
                )
            ),
        )
        .select("component", "pair.*", "k", "b", "cid", "weight", "size", "far")
    )
    counted = dealt.groupBy("component", "ik", "ib", "jk", "jb").applyInPandas(
        lambda group: _block_links(group, percent), "cid long, links long"
    )
    return written(done.unionAll(counted.groupBy("cid").agg(F.sum("links").alias("links"))))


def near_groups(documents: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Three tables: (doc_id, size, cid) of every row, (id, component) of every class,
    and (cid, grams) of the classes that could link, some more than once.

    `component` is the smallest class reachable by links; classes without links have
    no row in the second table. A null text has no words. Rows may share an id.
    Numbers stand for grams and sets (64 bits each), so that two different ones are
    taken for equal with a chance of some 1e-19 for each pair.
    """
    spark = documents.sparkSession
    visible(spark)
    # Ids go through pandas as text, which keeps large ones whole beside nulls.
    texts = documents.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    read = written(
        texts.mapInPandas(_class_rows(width), "doc_id string, size long, cid long, bucket int, seen long")
    )
    rows = read.where("bucket < 0").select(F.col("doc_id").cast("long"), "size", "cid")
    counts = read.where("bucket >= 0").groupBy("bucket").agg(F.sum("seen").alias("seen"))
    counts = counts.toArrow()  # 2 ** BITS rows at most
    seen = np.zeros(1 << BITS, np.int64)
    seen[counts["bucket"].to_numpy()] = counts["seen"].to_numpy()
    seen = spark.sparkContext.broadcast(seen)

    classes = written(
        texts.mapInPandas(
            _prefix_rows(width, percent, seen), "cid long, size long, prefix array<long>, parity array<long>"
        ).dropDuplicates(["cid"])
    )
    postings = classes.select("cid", "size", F.posexplode("prefix").alias("pos", "gram"))
    # Grams of one class alone pair nothing; of grams with the same members the first
    # will do, which is the first to all of them.
    shared = (
        postings.groupBy("gram")
        .agg(
            F.count("*").alias("n"),
            F.sum(F.xxhash64("cid").bitwiseAND(F.lit((1 << 40) - 1))).alias("one"),
            F.bit_xor(F.xxhash64(F.lit(1), "cid")).alias("two"),
            F.min(F.struct("cid", "pos")).alias("place"),
        )
        .where("n > 1")
        .groupBy("n", "one", "two")
        .agg(F.min_by("gram", "place").alias("gram"))
        .select("gram")
    )
    # Most members meet nobody that the filters let pass, and go: first by what they
    # carry here, then by parities. Each stays once, however many it could link with.
    members = postings.join(shared, "gram")
    members = written(_with_partner(members, filters_by_place, percent))
    members = members.join(classes.select("cid", "parity"), "cid")
    order = Window.partitionBy("cid").orderBy("pos")
    members = members.select("*", *(F.lag("gram", k + 1).over(order).alias(f"before{k}") for k in range(BEFORE)))
    members = written(_with_partner(members, may_link, percent))

    ids = (
        rows.groupBy("cid")
        .agg(F.min("doc_id").alias("doc_id"))
        .join(members.select("cid").distinct(), "cid", "left_semi")
    )
    wanted = _few(ids.select(F.col("doc_id").cast("string").alias("_id")))
    some = texts.join(wanted, F.expr("doc_id <=> _id"), "left_semi")
    # Rows that share an id may add a set that nobody asks for, or one twice.
    sets = written(some.mapInPandas(_set_rows(width), "cid long, size long, grams binary, sketch binary"))
    held = sets.agg(F.sum(F.octet_length("grams"))).first()[0] or 0
    tasks = max(1, math.ceil(held / TASK))

    first = members.groupBy("gram").agg(F.min("cid").alias("top"))
    # A class's family: the smallest class that it shares a gram with, split where large.
    family = (
        members.select("gram", "cid")
        .join(first, "gram")
        .groupBy("cid")
        .agg(F.min("top").alias("top"))
    )
    many = family.groupBy("top").agg(F.ceil(F.count("*") / 500).alias("parts"))
    families = written(
        family.join(many, "top")
        .select("cid", F.xxhash64("top", F.pmod(F.xxhash64("cid"), F.col("parts"))).alias("family"))
        .join(classes.select("cid", "size"), "cid")
    )
    placed, links, tried = members.withColumn("part", F.col("cid")), None, None
    for turn, hubs in enumerate([*HUBS, None]):
        if turn:
            joined = written(components(links))
            placed = members.join(joined, F.col("cid") == F.col("id"), "left").select(
                members["*"], F.coalesce("component", "cid").alias("part")
            )
            apart = placed.groupBy("gram").agg(F.min("part").alias("x"), F.max("part").alias("y")).where("x < y")
            placed = written(placed.join(apart.select("gram"), "gram", "left_semi"))
        if hubs:
            order = F.xxhash64(F.lit(turn), "cid") if turn else F.col("cid")
            pairs = _with_hubs(placed, order, hubs, percent)
        else:
            pairs = (
                placed.alias("p")
                .join(placed.alias("q"), F.col("p.gram") == F.col("q.gram"))
                .where((F.col("p.part") < F.col("q.part")) & may_link(percent, "p", "q"))
                .select(F.least("p.cid", "q.cid").alias("a"), F.greatest("p.cid", "q.cid").alias("b"))
                .distinct()
            )
        if turn:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")  # those have been refused
        pairs = written(pairs)
        found = verified(pairs, sets, families, tasks, percent)
        links, tried = (links.unionAll(found), tried.unionAll(pairs)) if turn else (found, pairs)
    return rows, written(components(links)), sets


def grouped(documents: DataFrame, width: int = 3, percent: int = 90) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links) of every row of documents.

    component_id is the smallest doc_id reachable by links, the row's own included;
    rows without words have their own. Null ids are never the smallest; a group of
    them alone has a null. n_links counts the other rows that are similar enough, those
    with an equal set among them; rows without words link with nothing.
    """
    rows, joined, sets = near_groups(documents, width, percent)
    known = (
        rows.where("size > 0")
        .groupBy("cid")
        .agg(F.count("*").alias("weight"))
        .join(joined, F.col("cid") == F.col("id"), "left")
        .where("weight > 1 or component is not null")
        .join(link_counts(rows, joined, sets, percent), "cid", "left")
        .select("cid", "component", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    )
    placed = rows.join(known, "cid", "left").select(
        "doc_id", "size", F.coalesce("component", "cid").alias("part"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )
    least = placed.where("size > 0").groupBy("part").agg(F.min("doc_id").alias("least"))
    return placed.join(least, "part", "left").select(
        "doc_id",
        F.col("size").alias("n_shingles"),
        F.when(F.col("size") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"),
        "n_links",
    )


def without_near_copies(documents: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The documents with one row of each group: that of the smallest id, null last.

    Of rows with the same id in a group, the one of smallest class, then of smallest
    checksum over its columns stays. Rows without words all stay.
    """

    @F.pandas_udf("long")
    def class_numbers(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([class_of(s) for s in gram_sets(texts.tolist(), width)], dtype="int64")
        tidy()

    # Else Spark would hash every text a second time, below what it projects, for the join's
    # check for nulls: by another Python worker beside the first, which stays.
    class_numbers = class_numbers.asNondeterministic()

    def key(column):
        return F.coalesce(F.concat(F.lit("+"), F.col(column).cast("string")), F.lit("-"))

    rows, joined, _ = near_groups(documents, width, percent)
    order = F.struct(F.isnull("doc_id").alias("x"), "doc_id", "cid")
    first = (
        rows.where("size > 0")
        .join(joined, F.col("cid") == F.col("id"), "left")
        .groupBy(F.coalesce("component", "cid").alias("part"))
        .agg(F.min(order).alias("first"))
        .select(key("first.doc_id").alias("key"), F.col("first.cid").alias("cid"))
    )
    # The rows move once, by id and class; what is decided about them is small.
    whole = F.struct(*documents.columns).alias("row")
    marked = documents.select(
        whole, key("doc_id").alias("key"), class_numbers("text").alias("cid"),
        F.xxhash64(*documents.columns).alias("sum"),
    )
    kept = marked.join(first, ["key", "cid"]).groupBy("key", "cid").agg(F.min_by("row", "sum").alias("row"))
    wordless = ~F.coalesce("text", F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    return kept.select("row.*").unionByName(documents.where(wordless))


def op4_ngram_join(spark, sf_dir: str) -> DataFrame:
    """Groups of documents whose 3-word shingles overlap by nine tenths, and their links."""
    return grouped(spark.read.parquet(f"{sf_dir}/documents.parquet"))
