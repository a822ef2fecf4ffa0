"""Language-model scores by context-tree weighting of bytes.

A byte is eight binary decisions, and each decision, named by the bits before it, has
a tree of contexts of its own: the last 0, 1, ... `depth` bytes. A node estimates its
decision by Krichevsky and Trofimov's rule and weighs itself against its children by
how well either codes the training texts. The chance of a decision mixes the estimates
on the path from the root to the deepest context that was seen.

A text is what its tokens are: words, lowered, with one space between, and an end.

Texts are cut into blocks of bounded size. A block reports its distinct contexts with
their counts, cut into parts by context; a part gathers its contexts from all blocks,
and answers each block with what they are worth. So the model is spread over the
cluster, no task holds more than a block or a part, and both stay the same size as the
corpus grows. Words meet their counts the same way. An answer names its contexts and
words, so that a block needn't count them again.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cliptrack.llm.shared import crc, folded, mix, visible, word_hashes, written

#: Bytes of context. The last `depth` + 1 bytes of a text are kept in one number.
DEPTH = 5
#: Bytes of text in a block.
BLOCK = 32 << 20
#: Parts of the contexts for each block: what a part works on is many times its reports.
PARTS = 4
_CHUNK = 2 << 20
_END = b"\xff"  # no byte of UTF-8


def _streams(texts: list[str | None], depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, grams): the byte and context of every position, a chunk at a time."""

    def pieces():
        for row, text in enumerate(texts):
            stream = b"\0" * depth + b" ".join(folded(text).split()) + _END
            for at in range(0, len(stream) - depth, _CHUNK):
                yield row, stream[at : at + _CHUNK + depth]

    def grams(rows, parts):
        joined = np.frombuffer(b"".join(parts), np.uint8).astype(np.uint64)
        sizes = np.array([len(p) for p in parts])
        found = joined[depth:].copy()
        for back in range(1, depth + 1):
            found |= joined[depth - back : len(joined) - back] << np.uint64(8 * back)
        inside = np.ones(len(joined), bool)
        starts = np.cumsum(sizes) - sizes
        for k in range(depth):
            inside[starts + k] = False
        return np.repeat(rows, sizes - depth), found[inside[depth:]].view(np.int64)

    rows, parts, size = [], [], 0
    for row, piece in pieces():
        if parts and size + len(piece) > _CHUNK:
            yield grams(rows, parts)
            rows, parts, size = [], [], 0
        rows.append(row)
        parts.append(piece)
        size += len(piece)
    if parts:
        yield grams(rows, parts)


def _firsts(ordered: np.ndarray) -> np.ndarray:
    """Where each distinct one of sorted keys begins."""
    return np.flatnonzero(np.append(np.ones(min(1, len(ordered)), bool), ordered[1:] != ordered[:-1]))


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts."""
    every = np.concatenate([np.zeros(0, np.int64), *keys])
    order = np.argsort(every, kind="stable")  # merges what is sorted
    every = every[order]
    first = _firsts(every)
    each = np.concatenate([np.zeros(0, np.int64), *counts])[order]
    return every[first], np.add.reduceat(each, first) if len(first) else each


def _counted(keys: np.ndarray, learn: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Sorted distinct keys where they may be learnt, and where not, and how often each is learnt."""
    learnt, other = np.sort(keys[learn]), np.sort(keys[~learn])
    first, rest = _firsts(learnt), _firsts(other)
    return [learnt[first], other[rest]], [np.diff(first, append=len(learnt)), np.zeros(len(rest), np.int64)]


def _block_words(texts: list[str | None], learn: np.ndarray):
    words, begin = word_hashes(texts)
    return _summed(*_counted(words.view(np.int64), np.repeat(learn, np.diff(begin))))


def _block_grams(texts: list[str | None], learn: np.ndarray, depth: int):
    keys, counts = [], []
    for rows, grams in _streams(texts, depth):
        seen, n = _counted(grams, learn[rows])
        keys += seen
        counts += n
    return _summed(keys, counts)


def _reports(depth: int, parts: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        texts, learn = frame["text"].tolist(), frame["learn"].to_numpy(bool)
        block, out = frame["block"].iloc[0], []
        for kind, (keys, counts) in (
            ("word", _block_words(texts, learn)),
            ("gram", _block_grams(texts, learn, depth)),
        ):
            part = part_of(kind, keys, depth, parts)
            order = np.argsort(part, kind="stable")
            cuts = np.searchsorted(part[order], np.arange(parts + 1))
            for p in range(parts):
                at = order[cuts[p] : cuts[p + 1]]
                if len(at):
                    out.append((block, kind, p, keys[at].tobytes(), counts[at].astype(np.int32).tobytes()))
        return pd.DataFrame(out, columns=["block", "kind", "part", "keys", "counts"])

    return run


def part_of(kind: str, keys: np.ndarray, depth: int, parts: int) -> np.ndarray:
    """The part a key belongs to; grams lie with all that share their context but for
    its oldest byte, which are 65,536 at most."""
    if kind == "gram":
        keys = keys >> 8 & ((1 << 8 * (depth - 1)) - 1)
    return ((mix(keys.view(np.uint64)) >> np.uint64(20)) % np.uint64(parts)).astype(np.int64)


def _gathered(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    return _summed(
        [np.frombuffer(k, np.int64) for k in frame["keys"]],
        [np.frombuffer(c, np.int32) for c in frame["counts"]],
    )


def _answered(frame: pd.DataFrame, keys: np.ndarray, values: np.ndarray) -> pd.DataFrame:
    """A value for every key that a block has reported, beside the keys."""
    own = [values[np.searchsorted(keys, np.frombuffer(k, np.int64))].tobytes() for k in frame["keys"]]
    return pd.DataFrame({"block": frame["block"], "kind": frame["kind"], "keys": frame["keys"], "values": own})


def _word_answers(frame: pd.DataFrame) -> pd.DataFrame:
    keys, counts = _gathered(frame)
    out = _answered(frame, keys, counts.astype(float))
    # The words seen and how often, once a part.
    out["distinct"], out["tokens"] = 0, 0
    out.iloc[0, out.columns.get_indexer(["distinct", "tokens"])] = (counts > 0).sum(), counts.sum()
    return out


def _log_gamma(x):
    y = x + 6.0
    log = np.log if isinstance(x, np.ndarray) else F.log
    rest = 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * y * y * y * y * y)
    below = x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5)
    return (y - 0.5) * log(y) - y + 0.5 * math.log(2 * math.pi) + rest - log(below)


def log_kt(zeros, ones):
    """The log of what Krichevsky and Trofimov's rule gives so many zeros and ones."""
    both = _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - _log_gamma(zeros + ones + 1.0)
    return both - math.log(math.pi)


def _decisions(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(context and decision in one number, bit taken), eight rows a gram."""
    context, symbol = grams >> 8 << 8, grams & 255
    nodes = [context | 1 << k | symbol >> 8 - k for k in range(8)]
    bits = [symbol >> 7 - k & 1 for k in range(8)]
    return np.stack(nodes), np.stack(bits)


def _leaves(grams: np.ndarray, counts: np.ndarray):
    nodes, bits = _decisions(grams)
    distinct, at = np.unique(nodes.ravel(), return_inverse=True)
    weights = np.tile(counts, 8)
    ones = np.bincount(at, weights * bits.ravel(), len(distinct))
    zeros = np.bincount(at, weights, len(distinct)) - ones
    return distinct, zeros, ones, at.reshape(nodes.shape), bits


def _shorter(nodes: np.ndarray, depth: int) -> np.ndarray:
    """The same decisions in contexts of so many bytes."""
    return nodes & ((1 << 8 * (depth + 1)) - 1)


def _above_leaves(depth: int):
    """What the leaves of a part add up to, one context byte above them."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        grams, counts = _gathered(frame)
        nodes, zeros, ones, _, _ = _leaves(grams, counts)
        above, at = np.unique(_shorter(nodes, depth - 1), return_inverse=True)
        add = lambda x: np.bincount(at, x, len(above))
        return pd.DataFrame(
            {
                "part": frame["part"].iloc[0], "node": above, "zeros": add(zeros), "ones": add(ones),
                "below": add(log_kt(zeros, ones)),
            }
        )

    return run


def _gram_answers(depth: int):
    """log10 of the chance of each gram's byte in its context."""

    def run(frame: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        grams, counts = _gathered(frame)
        nodes, zeros, ones, at, bits = _leaves(grams, counts)
        above = above.sort_values("node")
        where = np.searchsorted(above["node"].to_numpy(), _shorter(nodes, depth - 1))
        sure, left, stop = (above[c].to_numpy()[where] for c in ("sure", "left", "stop"))
        one = np.where(zeros + ones > 0, sure + left * (ones + 0.5) / (zeros + ones + 1), stop)
        chance = np.where(bits == 1, one[at], 1 - one[at])
        return _answered(frame, grams, np.log10(chance).sum(0))

    return run


def weighted(lowest: DataFrame, depth: int) -> DataFrame:
    """For nodes of `depth` context bytes: (node, part, sure, left, stop).

    lowest has their counts (zeros, ones) and the logs of what their children give
    (below). stop is the chance of a one if nothing deeper was seen; a child that was
    seen gives sure + left * its own estimate instead. A node without counts is its
    parent's equal.
    """

    def own(level: DataFrame) -> DataFrame:
        kt = log_kt(F.col("zeros"), F.col("ones"))
        one = (F.col("ones") + 0.5) / (F.col("zeros") + F.col("ones") + 1)
        top = F.greatest("kt", "below")
        either = top + F.log((F.exp(F.col("kt") - top) + F.exp(F.col("below") - top)) / 2)
        return (
            level.withColumn("kt", kt)
            .withColumn("weight", 1 / (1 + F.exp(F.col("below") - F.col("kt"))))
            .withColumn("one", one)
            .withColumn("coded", either)
        )

    levels = [written(own(lowest))]
    for bytes_kept in range(depth - 1, -1, -1):
        shorter = F.col("node").bitwiseAND(F.lit((1 << 8 * (bytes_kept + 1)) - 1))
        sums = levels[-1].groupBy(shorter.alias("node")).agg(
            F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("coded").alias("below")
        )
        levels.append(written(own(sums)))
    sure, left = F.col("weight") * F.col("one"), 1 - F.col("weight")
    placed = levels.pop().select(
        "node", sure.alias("sure"), left.alias("left"), F.col("one").alias("stop")
    )
    for bytes_kept in range(1, depth + 1):
        level = levels.pop()
        upper = placed.select(
            F.col("node").alias("_up"), F.col("sure").alias("_sure"),
            F.col("left").alias("_left"), F.col("stop").alias("_stop"),
        )
        seen = F.col("zeros") + F.col("ones") > 0
        placed = level.join(
            upper, F.col("node").bitwiseAND(F.lit((1 << 8 * bytes_kept) - 1)) == F.col("_up")
        ).select(
            *(["part"] if bytes_kept == depth else []),
            "node",
            (F.col("_sure") + F.col("_left") * sure).alias("sure"),
            (F.col("_left") * left).alias("left"),
            F.when(seen, F.col("_sure") + F.col("_left") * F.col("one")).otherwise(F.col("_stop")).alias("stop"),
        )
    return written(placed)


def _scores(depth: int, ends: int, tokens: int, distinct: int):
    smoothed = math.log10(tokens + distinct + 1)

    def answered(answers: pd.DataFrame, kind: str) -> tuple[pd.Index, np.ndarray]:
        own = answers[answers["kind"] == kind]
        keys = np.frombuffer(b"".join(own["keys"]), np.int64)
        return pd.Index(keys), np.frombuffer(b"".join(own["values"]), float)

    def run(frame: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        texts, learn = frame["text"].tolist(), frame["learn"].to_numpy(bool)
        n = len(texts)
        held, count = answered(answers, "word")
        words, begin = word_hashes(texts)
        row = np.repeat(np.arange(n), np.diff(begin))
        own = count[held.get_indexer(words.view(np.int64))]
        base = np.bincount(row, np.log10(own + 1) - smoothed, n) + math.log10(ends + 1) - smoothed
        known = np.bincount(row, own > 0, n).astype(np.int64) + (ends > 0)
        held, chance = answered(answers, "gram")
        score, size = np.zeros(n), np.zeros(n, np.int64)
        for rows, found in _streams(texts, depth):
            score += np.bincount(rows, chance[held.get_indexer(found)], n)
            size += np.bincount(rows, minlength=n)
        return pd.DataFrame(
            {
                "doc_id": frame["doc_id"], "held_out": ~learn, "n_tokens": np.diff(begin) + 1,
                "n_known": known, "train_tokens": tokens, "base_score": base, "score": score,
                "bits_per_byte": -score / math.log10(2) / size,
            }
        )

    return run


def scored(documents: DataFrame, learn: Column, depth: int = DEPTH, block: int = BLOCK) -> DataFrame:
    """Scores of all texts by a model of those where `learn` holds.

    doc_id, held_out (not learnt from), n_tokens, n_known, train_tokens, base_score and
    score (log10 of the text's chance by token counts and by the context trees) and
    bits_per_byte. Null and empty texts are an end alone. Rows may share an id; they
    are scored each. Nothing learnt: every decision is even.
    """
    spark = documents.sparkSession
    visible(spark)
    rows = documents.select(
        F.col("doc_id").cast("string").alias("doc_id"),  # whole beside nulls in pandas
        "text",
        F.coalesce(learn, F.lit(False)).alias("learn"),
    )
    totals = rows.agg(
        F.sum(F.octet_length("text")), F.sum(F.col("learn").cast("long"))
    ).first()
    blocks = max(1, math.ceil((totals[0] or 0) / block))
    parts = PARTS * blocks
    ends = int(totals[1] or 0)
    dealt = rows.withColumn(
        "block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int")
    ).groupBy("block")
    reports = written(
        dealt.applyInPandas(
            _reports(depth, parts), "block int, kind string, part int, keys binary, counts binary"
        )
    )
    answer = "block int, kind string, keys binary, values binary"
    words = written(
        reports.where("kind = 'word'")
        .groupBy("part")
        .applyInPandas(_word_answers, answer + ", distinct long, tokens long")
    )
    seen = words.agg(F.sum("distinct"), F.sum("tokens")).first()
    distinct, tokens = int(seen[0] or 0) + (ends > 0), int(seen[1] or 0) + ends
    grams = reports.where("kind = 'gram'").groupBy("part")
    lowest = grams.applyInPandas(
        _above_leaves(depth), "part int, node long, zeros double, ones double, below double"
    )
    above = weighted(lowest, depth - 1)
    answers = words.select("block", "kind", "keys", "values").unionAll(
        grams.cogroup(above.groupBy("part")).applyInPandas(_gram_answers(depth), answer)
    )
    return dealt.cogroup(answers.groupBy("block")).applyInPandas(
        _scores(depth, ends, tokens, distinct),
        "doc_id string, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double, bits_per_byte double",
    ).withColumn("doc_id", F.col("doc_id").cast("long"))


def op2_context_trees(spark, sf_dir: str) -> DataFrame:
    """Scores of all documents by context trees that six sevenths of them teach."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return scored(documents, F.coalesce(crc("doc_id", 7) != 2, F.lit(True)))
