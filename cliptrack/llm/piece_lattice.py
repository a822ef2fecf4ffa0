"""Sampled SentencePiece segmentations, and their decoding.

Every way to cut a text into pieces is a path through a lattice. Forward filtering
sums over the paths that lead to each place; backward sampling then walks from the end
of the text to its start and draws each piece by its share of that sum, so that every
segmentation comes with its own probability. The draws follow from a hash of the row's
key, so a row gives the same pieces wherever and whenever it runs.

No piece holds a word start after another character, so a lattice falls apart into
stretches, and equal stretches share one lattice. Each place of a stretch is a place of
the whole text's lattice; only the draws differ between its occurrences.

The vocabulary's scores are ranks (its pieces come from merges), which say nothing of
how often a piece is used. A piece's chance is therefore taken by Zipf's law from its
rank, to the power `alpha`: large values take the likeliest cuts, small ones any.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import islice
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    IntegerType,
    LongType,
    StructField,
    StructType,
)

from cliptrack.llm.shared import mix, tidy, visible

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
ALPHA = 0.5
#: Constant that is added to a rank in Zipf's law.
FLAT = 100.0
SPACE = "▁"
#: Bytes of lattices that a worker keeps; beyond it starts anew.
MEMORY = 32 << 20
#: Characters of a stretch. A longer one (without any space) is cut into such stretches,
#: and no piece spans the cut.
LONGEST = 4096
_AT_ONCE = 1 << 15  # characters of stretches whose lattices are built at a time
_CHUNK = 1 << 18  # characters that are encoded at a time; a longer text is cut between stretches
_SLICE = 1 << 16  # ids that are decoded at a time
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


class Vocabulary(NamedTuple):
    texts: list[bytes]  # of each id, as UTF-8; a byte piece is its byte
    byte_ids: np.ndarray  # id of each byte's piece
    slots: np.ndarray  # hash table of the trie: key (node * 256 + byte) + 1, or 0
    child: np.ndarray  # node each leads to
    reach: int  # slots that a key may lie from its own
    ends: np.ndarray  # id of the piece that ends in a node, or -1
    weight: np.ndarray  # log of each id's chance
    raw: pa.Array  # texts, for Arrow


def _slot(keys: np.ndarray, size: int) -> np.ndarray:
    """The first of `size` slots, a power of two, for each key."""
    return ((keys.view(np.uint64) * _GOLDEN) >> np.uint64(65 - size.bit_length())).view(np.int64)


@lru_cache(4)
def vocabulary(model: str = MODEL, alpha: float = ALPHA) -> Vocabulary:
    """The model file's pieces as a trie over bytes. Control pieces take no part."""
    import sentencepiece

    read = sentencepiece.SentencePieceProcessor(model_file=model)
    size = read.get_piece_size()
    texts, byte_ids = [b""] * size, np.full(256, -1, np.int64)
    pieces = []
    for i in range(size):
        piece = read.id_to_piece(i)
        if read.is_byte(i):
            texts[i] = bytes([int(piece[3:5], 16)])
            byte_ids[texts[i][0]] = i
        elif not (read.is_control(i) or read.is_unknown(i) or read.is_unused(i)):
            texts[i] = piece.replace(SPACE, " ").encode()
            # A stretch ends before a word start, so no piece may go on there.
            if not re.search(rf"[^{SPACE}]{SPACE}", piece):
                pieces.append(i)
    if (byte_ids < 0).any():
        raise ValueError(f"{model} has no piece for some byte")
    pieces.sort(key=lambda i: (-read.get_score(i), i))
    weight = np.zeros(size)
    zipf = 1 / (np.arange(len(pieces) + 1) + 1 + FLAT)
    logs = alpha * np.log(zipf / zipf.sum())
    weight[pieces], weight[byte_ids] = logs[:-1], logs[-1]
    nodes: dict[int, int] = {}
    ends = [-1]
    for i in pieces:
        node = 0
        for byte in texts[i].replace(b" ", SPACE.encode()):
            key = node * 256 + byte
            if key not in nodes:
                nodes[key] = len(ends)
                ends.append(-1)
            node = nodes[key]
        ends[node] = i
    slots = 1 << (4 * len(nodes) - 1).bit_length()
    table, child = np.zeros(slots, np.int64), np.zeros(slots, np.int32)
    keys = np.fromiter(nodes, np.int64, len(nodes))
    leads = np.fromiter(nodes.values(), np.int32, len(nodes))
    reach, at = 0, _slot(keys, slots)
    while len(keys):
        reach += 1
        free = table[at] == 0
        table[at[free]] = keys[free] + 1  # of several for one slot the last stays
        here = table[at] == keys + 1
        child[at[here]] = leads[here]
        keys, leads, at = keys[~here], leads[~here], (at[~here] + 1) & (slots - 1)
    return Vocabulary(texts, byte_ids, table, child, reach, np.array(ends), weight, pa.array(texts, pa.binary()))


def _step(v: Vocabulary, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
    """The child of each node by a byte, or -1."""
    key = node.astype(np.int64) * 256 + byte + 1
    at = _slot(key - 1, len(v.slots))
    out = np.full(len(key), -1, np.int32)
    todo = np.arange(len(key))
    for _ in range(v.reach):
        held = v.slots[at]
        hit = held == key
        out[todo[hit]] = v.child[at[hit]]
        on = ~hit & (held != 0)
        if not on.any():
            break
        todo, key, at = todo[on], key[on], (at[on] + 1) & (len(v.slots) - 1)
    return out


class Lattice(NamedTuple):
    """Edges into each place of all stretches, with the sum of chances up to each."""

    first: np.ndarray  # of a place, its first edge; one more at the end
    source: np.ndarray  # place an edge comes from
    piece: np.ndarray  # its id
    upto: np.ndarray  # chance that it or an earlier edge of the place is drawn
    start: np.ndarray  # of a stretch, its first place
    end: np.ndarray  # and its last


def lattice(v: Vocabulary, stretches: list[str]) -> Lattice:
    """Forward filtering over all stretches at once, place by place.

    A stretch is a word, after one space, or anything else behind a word start. A word
    start that the text itself holds is a stretch that is spelled by its bytes.
    """
    literal = [s == SPACE + SPACE for s in stretches]
    raws = [
        (s[1:].replace(" ", SPACE) if s[:1] == SPACE else SPACE + s).encode() for s in stretches
    ]
    sizes = np.array([len(r) for r in raws], np.int64)
    text = np.frombuffer(b"".join(raws), np.uint8)
    # A place lies before each byte and after the last; pieces meet between characters.
    start = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
    own = np.repeat(np.arange(len(raws)), sizes)
    byte_of = np.arange(len(text)) + own  # place before each byte
    last = (start + sizes)[own]
    total = len(text) + len(raws)
    whole = (text & 0xC0) != 0x80
    sources, targets, ids = [], [], []
    at = np.flatnonzero(whole & ~np.repeat(literal, sizes))
    node = np.zeros(len(at), np.int32)
    origin = at
    while len(at):
        node = _step(v, node, text[at])
        keep = node >= 0
        node, origin, at = node[keep], origin[keep], at[keep] + 1
        piece = v.ends[node]
        found = piece >= 0
        sources.append(byte_of[origin[found]])
        targets.append(byte_of[at[found] - 1] + 1)
        ids.append(piece[found])
        more = byte_of[at - 1] + 1 < last[at - 1]
        node, origin, at = node[more], origin[more], at[more]
    # A character that is no piece is spelled by its bytes, and in no other way.
    length = np.diff(np.append(np.flatnonzero(whole), len(text)))
    places, width, single = byte_of[whole], np.zeros(total, np.int64), np.zeros(total, bool)
    width[places] = length
    for a, b in zip(sources, targets, strict=True):
        single[a[b - a == width[a]]] = True
    spell = np.repeat(~single[places], length)
    sources.append(byte_of[spell])
    targets.append(byte_of[spell] + 1)
    ids.append(v.byte_ids[text[spell]])
    source, target, piece = map(np.concatenate, (sources, targets, ids))
    order = np.argsort(target.astype(np.int32), kind="stable")
    source, target, piece = source[order], target[order], piece[order]
    first = np.concatenate([[0], np.cumsum(np.bincount(target, minlength=total))])
    # Log sums of chances up to each place, by distance from the stretch's start.
    sums = np.full(total, -np.inf)
    sums[start] = 0.0
    weight = v.weight[piece]
    depth = np.arange(total) - np.repeat(start, sizes + 1)
    filled = np.flatnonzero((first[1:] > first[:-1]) & (depth > 0))
    by_depth = filled[np.argsort(depth[filled], kind="stable")]
    cuts = np.flatnonzero(np.diff(depth[by_depth], prepend=-1))
    share = np.empty(len(source))
    for a, b in zip(cuts, np.append(cuts[1:], len(by_depth)), strict=True):
        spots = by_depth[a:b]
        many = first[spots + 1] - first[spots]
        into = np.concatenate([[0], np.cumsum(many)])
        edges = np.arange(into[-1]) + np.repeat(first[spots] - into[:-1], many)
        logs = sums[source[edges]] + weight[edges]
        top = np.repeat(np.maximum.reduceat(logs, into[:-1]), many)
        # A place that nothing leads to keeps no share.
        chance = np.where(np.isfinite(top), np.exp(logs - np.where(np.isfinite(top), top, 0)), 0)
        added = np.add.reduceat(chance, into[:-1])
        with np.errstate(divide="ignore"):
            sums[spots] = np.maximum.reduceat(logs, into[:-1]) + np.log(added)
        share[edges] = chance / np.repeat(np.where(added > 0, added, 1), many)
    run = np.cumsum(share)
    before = np.concatenate([[0.0], run])[first[target]]
    small = [x.astype(np.int32) for x in (first, source, piece)]
    bounds = start.astype(np.int32), (start + sizes).astype(np.int32)
    return Lattice(*small, (run - before).astype(np.float32), *bounds)


class Store:
    """Lattices one behind another, in arrays that grow in place."""

    def __init__(self):
        self.places = self.edges = self.stretches = 0
        self.first = np.zeros(1, np.int32)
        self.source = self.piece = np.zeros(0, np.int32)
        self.upto = np.zeros(0, np.float32)
        self.start = self.end = np.zeros(0, np.int32)

    @property
    def bytes(self) -> int:
        return 4 * self.places + 12 * self.edges + 8 * self.stretches

    def _put(self, name: str, at: int, values: np.ndarray) -> None:
        have = getattr(self, name)
        if at + len(values) > len(have):
            grown = np.zeros(max(at + len(values), len(have) + len(have) // 4), have.dtype)
            grown[:at] = have[:at]
            setattr(self, name, have := grown)
        have[at : at + len(values)] = values

    def add(self, net: Lattice) -> None:
        place, edge = np.int32(self.places), np.int32(self.edges)
        self._put("first", self.places, net.first + edge)
        self._put("source", self.edges, net.source + place)
        self._put("piece", self.edges, net.piece)
        self._put("upto", self.edges, net.upto)
        self._put("start", self.stretches, net.start + place)
        self._put("end", self.stretches, net.end + place)
        self.places += len(net.first) - 1
        self.edges += len(net.source)
        self.stretches += len(net.start)


def sampled(net: Store, stretch: np.ndarray, seed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pieces of all occurrences in order, how many each has).

    Backward sampling: an occurrence of a stretch starts at its end and draws edges by
    its own seed until it is at the start.
    """
    place, goal = net.end[stretch], net.start[stretch]
    active = np.flatnonzero(place > goal)
    drawn, owner = [], []
    counts = np.zeros(len(stretch), np.int64)
    step = 0
    while len(active):
        step += 1
        here = place[active]
        bits = mix(seed[active] + np.uint64(step * int(_GOLDEN) % (1 << 64)))
        u = (bits >> np.uint64(11)).astype(np.float64) * (1.0 / (1 << 53))
        edge, end = net.first[here], net.first[here + 1] - 1
        todo = np.flatnonzero((edge < end) & (net.upto[edge] <= u))
        while len(todo):
            edge[todo] += 1
            todo = todo[(edge[todo] < end[todo]) & (net.upto[edge[todo]] <= u[todo])]
        drawn.append(net.piece[edge])
        owner.append(active.astype(np.int32))
        counts[active] += 1
        place[active] = net.source[edge]
        active = active[place[active] > goal[active]]
    ends = np.cumsum(counts)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.int32)
    for back, (who, ids) in enumerate(zip(owner, drawn, strict=True)):
        out[ends[who] - 1 - back] = ids
    return out, counts


_STRETCH = re.compile(rf" +[^ {SPACE}]*|[^ {SPACE}]+|{SPACE}")


def _cut(stretch: str) -> list[str]:
    """A stretch as lattice() takes it, in parts of LONGEST characters where it is longer."""
    if len(stretch) <= LONGEST:
        return [stretch]
    parts = [stretch[at : at + LONGEST] for at in range(0, len(stretch), LONGEST)]
    return [parts[0], *(SPACE + p for p in parts[1:])]


def stretches(text: str) -> list[str]:
    """The text, with a space before it, in stretches as lattice() takes them."""
    if "  " not in text and SPACE not in text and text[:1] != " ":
        found = text.split(" ")
    else:
        found = _STRETCH.findall(" " + text)
        found = [s[1:] if s[0] == " " and s[1:2] != " " else SPACE + s for s in found]
    if max(map(len, found)) <= LONGEST:
        return found
    return [part for s in found for part in _cut(s)]


def passages(text: str) -> Iterator[str]:
    """The text without the spaces between its passages: each of some _CHUNK characters, and
    of the same stretches as it has in the whole text. A text without spaces is one."""
    at = 0
    while len(text) - at > _CHUNK:
        cut = text.find(" ", at + _CHUNK)
        while cut > 0 and text[cut - 1] == " ":
            cut = text.find(" ", cut + 1)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut + 1
    yield text[at:]


class _Numbers(dict):
    """Numbers its keys in the order in which they are first asked for."""

    def __missing__(self, key):
        self[key] = len(self)
        return self[key]


class Sampler:
    """Encodes texts and keeps the lattices of the stretches that it has met."""

    def __init__(self, v: Vocabulary):
        self.v, self.numbers, self.store = v, _Numbers(), Store()

    def forget(self) -> None:
        self.numbers, self.store = _Numbers(), Store()

    def _known(self, found: list[str]) -> np.ndarray:
        """Numbers of stretches in the store, which gets those that it lacks."""
        had = len(self.numbers)
        out = np.fromiter(map(self.numbers.__getitem__, found), np.int64, len(found))
        new, size = [], 0
        for stretch in islice(self.numbers, had, None):
            new.append(stretch)
            size += len(stretch)
            if size > _AT_ONCE:
                self.store.add(lattice(self.v, new))
                new, size = [], 0
        if new:
            self.store.add(lattice(self.v, new))
        return out

    def _drawn(self, found: list[str], key: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(pieces in order, how many each stretch has), from the keys of their rows and
        their places in them. Stretches go on in groups, none of them large."""
        ids, counts = [], []
        at = 0
        sizes = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))
        while at < len(found):
            if self.store.bytes > MEMORY:
                self.forget()
            end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + _CHUNK)))
            seed = mix(mix(key[at:end] + _GOLDEN) ^ mix(turn[at:end] + _GOLDEN))
            some, many = sampled(self.store, self._known(found[at:end]), seed)
            ids.append(some)
            counts.append(many)
            at = end
        return np.concatenate(ids), np.concatenate(counts)

    def _long(self, text: str, key: np.ndarray) -> np.ndarray:
        out, turn = [], 0
        for passage in passages(text):
            found = stretches(passage)
            places = np.arange(turn, turn + len(found)).astype(np.uint64)
            out.append(self._drawn(found, np.repeat(key, len(found)), places)[0])
            turn += len(found)
        return np.concatenate(out)

    def _chunk(self, texts: list[str], keys: np.ndarray) -> list[np.ndarray]:
        found: list[str] = []
        upto = [0]
        for text in texts:
            found += stretches(text)
            upto.append(len(found))
        sizes = np.diff(upto)
        turn = np.arange(len(found)) - np.repeat(np.array(upto[:-1]), sizes)
        ids, counts = self._drawn(found, np.repeat(keys, sizes), turn.astype(np.uint64))
        return np.split(ids, np.cumsum(np.add.reduceat(counts, upto[:-1]))[:-1])

    def encoded(self, texts: list[str | None], keys: np.ndarray) -> list[np.ndarray | None]:
        """Sampled ids of each whole text; null for null, none for the empty text.

        keys: a 64-bit number for each row, from which its draws follow.
        """
        keys = keys.view(np.uint64)
        out: list[np.ndarray | None] = [
            None if text is None else np.zeros(0, np.int32) for text in texts
        ]
        held: list[int] = []
        size = 0
        for row in [*(i for i, text in enumerate(texts) if text), None]:
            if held and (row is None or size + len(texts[row]) > _CHUNK):
                found = self._chunk([texts[i] for i in held], keys[held])
                for i, ids in zip(held, found, strict=True):
                    out[i] = ids
                held, size = [], 0
            if row is not None and len(texts[row]) > _CHUNK:
                out[row] = self._long(texts[row], keys[row : row + 1])
            elif row is not None:
                held.append(row)
                size += len(texts[row])
        return out


@lru_cache(2)
def sampler(model: str, alpha: float) -> Sampler:
    return Sampler(vocabulary(model, alpha))


def decoded(ids, v: Vocabulary) -> str | None:
    """The text of a sequence of ids; the very one that was encoded."""
    if ids is None:
        return None
    ids = np.asarray(ids)
    raw = b"".join(
        b"".join(map(v.texts.__getitem__, ids[at : at + _SLICE].tolist()))
        for at in range(0, len(ids), _SLICE)
    )
    return raw[1:].decode("utf-8", "replace") if raw[:1] == b" " else raw.decode("utf-8", "replace")[1:]


def lossless(texts: list[str | None], ids: list[np.ndarray | None], v: Vocabulary) -> list[bool]:
    """Whether each text is what its ids decode to."""
    out = []
    for text, own in zip(texts, ids, strict=True):
        # Equal bytes are equal texts; others may still be, where they are no UTF-8.
        raw = b"" if own is None or not len(own) else pc.take(v.raw, pa.array(own)).buffers()[2].to_pybytes()
        same = text is not None and raw[:1] == b" " and raw[1:] == text.encode("utf-8", "surrogatepass")
        out.append(same or decoded(own, v) == text)
    return out


def _parts(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Slices of a batch's rows that hold some _CHUNK characters, or one longer text."""
    at, size = 0, 0
    for row, length in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        if row > at and size + length > _CHUNK:
            yield at, row
            at, size = row, 0
        size += length
    if len(texts) > at:
        yield at, len(texts)


def with_ids(
    documents: DataFrame,
    key: str = "doc_id",
    keep: Sequence[str] | None = None,
    model: str = MODEL,
    alpha: float = ALPHA,
) -> DataFrame:
    """The columns to keep (all, unless named) with ids, n_tokens and lossless.

    lossless tells whether the ids decode to the text. The model's path must be the
    same on all machines. Null text: null ids, no tokens, lossless. A very long text is
    encoded in passages, with the ids that it would have as a whole. Rows that share a
    key and a text get the same ids. Columns of those three names are replaced.
    """
    visible(documents.sparkSession)
    kept = [c for c in keep or documents.columns if c not in ("ids", "n_tokens", "lossless")]
    rows = documents.select(
        *kept, F.col("text").alias("_text"), F.xxhash64(F.col(key)).alias("_key")
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sampler(model, alpha)
        for batch in batches:
            for at, end in _parts(batch.column("_text")):
                part = batch.slice(at, end - at)
                texts = part.column("_text").to_pylist()
                ids = own.encoded(texts, part.column("_key").to_numpy())
                same = lossless(texts, ids, own.v)
                counts = np.array([0 if i is None else len(i) for i in ids], np.int64)
                flat = np.concatenate([np.zeros(0, np.int32), *(i for i in ids if i is not None)])
                lists = pa.ListArray.from_arrays(
                    pa.array(np.append(0, np.cumsum(counts)).astype(np.int32)),
                    pa.array(flat),
                    mask=pa.array([i is None for i in ids]),
                )
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in kept), lists, pa.array(counts), pa.array(same)],
                    names=[*kept, "ids", "n_tokens", "lossless"],
                )
        own.forget()
        tidy()

    fields = [rows.schema[c] for c in kept]
    added = [
        StructField("ids", ArrayType(IntegerType())),
        StructField("n_tokens", LongType()),
        StructField("lossless", BooleanType()),
    ]
    return rows.mapInArrow(encode, StructType([*fields, *added]))


def with_text(encoded_rows: DataFrame, ids: str = "ids", model: str = MODEL) -> DataFrame:
    """Adds text: what the ids decode to."""
    visible(encoded_rows.sparkSession)

    @F.pandas_udf("string")
    def decode(column: pd.Series) -> pd.Series:
        v = vocabulary(model, ALPHA)
        return pd.Series([decoded(i, v) for i in column], dtype=object)

    return encoded_rows.withColumn("text", decode(ids))


def op5_pieces(spark, sf_dir: str) -> DataFrame:
    """Sampled pieces of every document."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return with_ids(documents, keep=["doc_id"])
