"""Conversations repaired by the cheapest edits that give them a legal order of roles.

A lattice has a place for every row and state of the grammar `(s?(ua)+)?` over role
initials: keep, rerole or delete the next row, or insert an empty turn. Bidirectional
Dijkstra: a forward heap from the start and a reverse heap from the accepting ends meet;
both go on until every crossing of the least cost is settled; of all paths of that cost
the one with the least audit is read off.

A lattice is as long as its conversation, which may hold a third of all rows. So it is
cut into blocks of BLOCK rows. Reverse searches give each block the cost between its four
entry and four exit states, one pass over the blocks from the last to the first turns
these into the cost from every border to the end, and then each block is searched on its
own, with those costs as the seeds of its reverse heap. A pass from the first to the last
picks the state in which each block is entered. Conversations within one block need none
of this. The answer is the same wherever the cuts lie.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cliptrack.llm.sequences import _batch, chained, laid_out, numbered
from cliptrack.llm.shared import visible, written

#: Rows of a conversation that one search looks at.
BLOCK = 256
#: Neighbouring rows (2 ** RUN) whose texts go to one task, and the characters of repaired
#: text after which a piece is handed on.
RUN = 10
PIECE = 1 << 16

START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
#: What may follow a state, by role initial.
FOLLOWS = (
    {"s": SYSTEM, "u": USER},
    {"u": USER},
    {"a": ASSISTANT},
    {"u": USER},
)
#: The role that an edit puts into a state: never s, so it is fixed by the state.
WANTED = ("u", "u", "a", "u")
#: Cost of ending in a state behind the last row.
ACCEPT = (0, None, None, 0)
NAMES = {"u": "user", "a": "assistant"}

# What an edit costs. Keeping costs nothing.
REROLE, DELETE, INSERT, UNMENDED = 2, 3, 2, 1

# A row's code: its role's class (s, u, a or other) in capitals where the text is cut
# off; one sign for all rows that must go.
GONE = "-"


@lru_cache(64)
def _moves(code: str | None, state: int) -> tuple[tuple[str, str, int, int, int], ...]:
    """(audit letter, action, cost, rows passed, next state), by audit letter."""
    wanted = WANTED[state]
    moves = [("I", wanted, INSERT, 0, FOLLOWS[state][wanted])]
    if code is not None:
        moves.append(("D", "D", DELETE, 1, state))
        if code != GONE:
            extra = UNMENDED if code.isupper() else 0
            if code.lower() in FOLLOWS[state]:
                moves.append(("K", "K", extra, 1, FOLLOWS[state][code.lower()]))
            moves.append(("R", wanted.upper(), REROLE + extra, 1, FOLLOWS[state][wanted]))
    return tuple(sorted(moves))


@lru_cache(64)
def _arrivals(code: str | None, state: int) -> tuple[tuple[int, int, int], ...]:
    """(cost, rows passed, state before) of every move into a state, past this code or none."""
    return tuple(
        (cost, passed, before)
        for before in STATES
        for _, _, cost, passed, after in _moves(code, before)
        if after == state and passed == (code is not None)
    )


class _Heap:
    """Places in the order of their distance; settled ones keep it."""

    def __init__(self, seeds):
        self.open = [(cost, place) for cost, place in seeds]
        heapq.heapify(self.open)
        self.seen = {place: cost for cost, place in self.open}
        for cost, place in self.open:
            self.seen[place] = min(cost, self.seen[place])
        self.settled: dict[tuple[int, int], int] = {}

    def least(self) -> int | None:
        while self.open and self.open[0][1] in self.settled:
            heapq.heappop(self.open)
        return self.open[0][0] if self.open else None

    def settle(self) -> tuple[int, tuple[int, int]]:
        cost, place = heapq.heappop(self.open)
        self.settled[place] = cost
        return cost, place

    def reach(self, cost: int, place: tuple[int, int]) -> None:
        if place not in self.settled and cost < self.seen.get(place, cost + 1):
            self.seen[place] = cost
            heapq.heappush(self.open, (cost, place))


def _onward(codes: str, place, last: bool):
    """Moves from a place; at a border that is not the end, what follows is the next block's."""
    row, state = place
    if row < len(codes):
        return _moves(codes[row], state)
    return _moves(None, state) if last else ()


def _back(codes: str, place, last: bool):
    """(cost, place before) of every move that ends in a place."""
    row, state = place
    found = []
    if row < len(codes) or last:
        found += [(cost, (row, before)) for cost, _, before in _arrivals(None, state)]
    if row:
        found += [(cost, (row - 1, before)) for cost, _, before in _arrivals(codes[row - 1], state)]
    return found


@lru_cache(1 << 14)
def cheapest(
    codes: str, entry: int, ends: tuple[int | None, ...], last: bool
) -> tuple[int, tuple[str, ...], int] | None:
    """(cost, actions before and on each row and behind the last, exit state), or None.

    ends: the cost from each state behind the last row to the end; None where there is
    no way. Of all cheapest ways the one whose audit is least.
    """
    goal = len(codes)
    ahead = _Heap([(0, (0, entry))])
    astern = _Heap([(cost, (goal, state)) for state, cost in enumerate(ends) if cost is not None])
    best = None
    while True:
        a, b = ahead.least(), astern.least()
        # One side has settled all it can reach, or no crossing of this cost is left.
        if a is None or b is None or (best is not None and a + b > best):
            break
        if a <= b:
            cost, place = ahead.settle()
            for _, _, more, passed, state in _onward(codes, place, last):
                ahead.reach(cost + more, (place[0] + passed, state))
            other = astern.seen.get(place)
        else:
            cost, place = astern.settle()
            for more, before in _back(codes, place, last):
                astern.reach(cost + more, before)
            other = ahead.seen.get(place)
        if other is not None and (best is None or cost + other < best):
            best = cost + other
    if best is None:
        return None
    # Cost from a place to the end, for all places of the cheapest ways: known from the
    # reverse side, or carried back over the forward side from the crossings. Each move
    # adds cost, or passes a row at the same cost.
    left = dict(astern.settled)
    for place, cost in sorted(ahead.settled.items(), key=lambda x: (x[1], x[0][0]), reverse=True):
        if place in left:
            continue
        if (place[0] == goal and ends[place[1]] == best - cost) or any(
            left.get((place[0] + passed, state)) == best - cost - more
            for _, _, more, passed, state in _onward(codes, place, last)
        ):
            left[place] = best - cost
    place, rest = (0, entry), best
    actions, held = [], ""
    while place[0] < goal or (last and rest > (ends[place[1]] if ends[place[1]] is not None else -1)):
        for _, action, cost, passed, state in _onward(codes, place, last):
            after = place[0] + passed, state
            if left.get(after) == rest - cost:
                held += action
                place, rest = after, rest - cost
                if passed:
                    actions.append(held)
                    held = ""
                break
        else:
            raise AssertionError("a cheapest way breaks off")
    return best, (*actions, held), place[1]


def between(codes: str, last: bool) -> list[list[int | None]]:
    """Cost from each entry state of a block to each exit state."""
    table: list[list[int | None]] = [[None] * 4 for _ in STATES]
    for out in STATES:
        astern = _Heap([(0, (len(codes), out))])
        while astern.least() is not None:
            cost, place = astern.settle()
            for more, before in _back(codes, place, last):
                astern.reach(cost + more, before)
        for state in STATES:
            table[state][out] = astern.settled.get((0, state))
    return table


def _least(costs) -> int | None:
    return min((c for c in costs if c is not None), default=None)


def audit_of(actions: str) -> str:
    """Initials of the edits: keep, rerole, delete, insert."""
    return actions.translate(str.maketrans({"u": "I", "a": "I", "U": "R", "A": "R"}))


def lines(role: str, text: str, actions: str) -> list[str]:
    """The lines that the actions at a row leave: inserted ones, then the row's own."""
    out = []
    for action in actions:
        if action in NAMES:
            out.append(f"{NAMES[action]}:")
        elif action != "D":
            out.append(f"{NAMES.get(action.lower(), role)}:{text}")
    return out


# -- on Spark -----------------------------------------------------------------

def laid(rows: DataFrame) -> DataFrame:
    """Rows (key, turn, role, text) in order: by turn, null first, then the digest of role
    and text. Added: _at, _same (that digest) and ink, the last character that is no
    white space."""
    whole = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    marked = rows.withColumn("_same", F.sha2(whole.cast("binary"), 256)).withColumn("ink", last)
    return laid_out(marked, "key", [F.col("turn").asc_nulls_first(), F.col("_same")])


def faults(rows: DataFrame, size: int = BLOCK) -> DataFrame:
    """Rows that were laid, without their texts: key, turn, pos, len, `fault` (blank,
    duplicate, truncated or null), `kind` and `code`, and block, of `size` rows.

    A row is a duplicate if an earlier one has its role and text.
    """
    initial = F.substring("role", 1, 1)
    kind = F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("kind")
    placed = written(numbered(rows.select("key", "turn", "_at", "_same", "ink", kind), "key"))
    # Of equal rows the first is no duplicate; only what is met twice goes into the join.
    again = (
        placed.groupBy("key", "_same")
        .agg(F.min("pos").alias("_earliest"), F.count("*").alias("n"))
        .where("n > 1")
        .drop("n")
    )
    fault = (
        F.when(F.col("ink") == "", "blank")
        .when(F.col("pos") > F.col("_earliest"), "duplicate")
        .when(~F.col("ink").isin(".", "!", "?"), "truncated")
    )
    return (
        placed.join(again, ["key", "_same"], "left")
        .withColumn("fault", fault)
        .withColumn(
            "code",
            F.when(F.col("fault").isin("blank", "duplicate"), GONE)
            .when(F.col("fault") == "truncated", F.upper("kind"))
            .otherwise(F.col("kind")),
        )
        .withColumn("block", F.floor(F.col("pos") / size))
        .drop("_same", "_earliest", "ink")
    )


_ENDS = "key string, block long, v0 long, v1 long, v2 long, v3 long"


def _borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cost from the end of each block to the end of all, from the last block backwards."""
    schema = pa.schema([("key", pa.string()), ("block", pa.int64()), *((f"v{q}", pa.int64()) for q in STATES)])
    key, rest = None, None
    for batch in batches:
        out = []
        for own, block, table in zip(*(batch.column(c).to_pylist() for c in ("key", "block", "table")), strict=True):
            if own != key:
                key, rest = own, ACCEPT
            out.append((own, block, *rest))
            costs = [table[4 * q : 4 * q + 4] for q in STATES]
            rest = tuple(
                _least(c + r for c, r in zip(row, rest, strict=True) if c is not None and r is not None)
                for row in costs
            )
        yield _batch(out, schema)


_CHOSEN = "key string, block long, actions array<string>, cost long, illegal long"


def _chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The way through each block from the state in which the one before it was left."""
    schema = pa.schema(
        [("key", pa.string()), ("block", pa.int64())]
        + [("actions", pa.list_(pa.string())), ("cost", pa.int64()), ("illegal", pa.int64())]
    )
    names = ("key", "block", "kinds", "ways", "exits", "costs")
    key, state, role = None, START, None
    for batch in batches:
        out = []
        for own, block, kinds, ways, exits, costs in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
            if own != key:
                key, state, role = own, START, None
            run = (role or "") + kinds
            illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(run, run[1:], strict=False))
            out.append((own, block, ways[state], costs[state] if block == 0 else 0, illegal))
            state, role = exits[state], kinds[-1]
        yield _batch(out, schema)


def edits(marked: DataFrame, size: int = BLOCK) -> DataFrame:
    """(key, block, actions, cost, illegal) of every block of marked rows.

    actions: of each row of the block, what is inserted before it and becomes of it;
    one more at the end for what is inserted behind the last row. The cost of all stands
    in the first block; illegal counts pairs that end in the block.
    """
    blocks = (
        marked.groupBy("key", "block", "len")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "code", "kind"))).alias("rows"))
        .select(
            "key",
            "block",
            "len",
            F.array_join("rows.code", "").alias("codes"),
            F.array_join("rows.kind", "").alias("kinds"),
            (((F.col("block") + 1) * size) >= F.col("len")).alias("last"),
        )
    )
    blocks = written(blocks)

    @F.pandas_udf("array<long>")
    def tables(codes: pd.Series, last: pd.Series) -> pd.Series:
        return pd.Series(
            [[c for row in between(a, b) for c in row] for a, b in zip(codes, last, strict=True)], dtype=object
        )

    several = blocks.where(F.col("len") > size).select("key", "block", tables("codes", "last").alias("table"))
    borders = (
        several.repartition("key")
        .sortWithinPartitions("key", F.col("block").desc())
        .mapInArrow(_borders, _ENDS)
    )

    @F.pandas_udf("ways array<array<string>>, exits array<int>, costs array<long>")
    def searched(codes: pd.Series, block: pd.Series, last: pd.Series, ends: pd.DataFrame) -> pd.DataFrame:
        found = []
        at = zip(codes, block, last, ends.itertuples(index=False), strict=True)
        for code, number, final, end in at:
            goal = ACCEPT if final else tuple(None if pd.isna(v) else int(v) for v in end)
            ways = [
                cheapest(code, q, goal, bool(final)) if number or q == START else None for q in STATES
            ]
            found.append(
                (
                    [None if w is None else list(w[1]) for w in ways],
                    [None if w is None else w[2] for w in ways],
                    [None if w is None else w[0] for w in ways],
                )
            )
        return pd.DataFrame(found, columns=["ways", "exits", "costs"])

    ends = F.struct(*(F.col(f"v{q}").cast("double").alias(f"v{q}") for q in STATES))
    return (
        blocks.join(borders, ["key", "block"], "left")
        .withColumn("found", searched("codes", "block", "last", ends))
        .select("key", "block", "kinds", "found.*")
        .repartition("key")
        .sortWithinPartitions("key", "block")
        .mapInArrow(_chosen, _CHOSEN)
    )


_PIECES = "key string, number long, whole boolean, text string"


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repaired lines of rows in order, in pieces of bounded size; a short conversation
    comes as its hash. Before each text comes a row that says what becomes of it. A
    piece's number is the place of the first row that it holds a line of."""
    schema = pa.schema(
        [("key", pa.string()), ("number", pa.int64()), ("whole", pa.bool_()), ("text", pa.string())]
    )
    names = ("_at", "key", "pos", "len", "action", "tail", "role", "text")
    run, mark, begun, held, size, number = None, None, False, [], 0, 0
    for batch in batches:
        out = []
        for at, key, pos, n, action, tail, role, text in zip(
            *(batch.column(c).to_pylist() for c in names), strict=True
        ):
            if text is None:
                if (at >> RUN, key) != run:
                    # Rows of a run that goes on elsewhere.
                    if held:
                        out.append((run[1], number, False, "\n".join(held)))
                    run, begun, held, size = (at >> RUN, key), pos == 0, [], 0
                mark = pos, n, action, tail
                continue
            pos, n, action, tail = mark
            more = lines(role, text, action)
            if pos + 1 == n:
                more += lines("", "", tail)
            if more and not held:
                number = pos
            held += more
            size += sum(map(len, more))
            if pos + 1 == n and begun:
                whole = "\n".join(held).encode("utf-8", "surrogatepass")
                out.append((run[1], 0, True, hashlib.sha256(whole).hexdigest()))
                held, size = [], 0
            elif size > PIECE or (held and pos + 1 == n):
                out.append((run[1], number, False, "\n".join(held)))
                begun, held, size = False, [], 0
        yield _batch(out, schema)
    if held:
        yield _batch([(run[1], number, False, "\n".join(held))], schema)


def repaired(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per key of rows (key, turn, role, text; none null but turn): blank,
    duplicate, truncated, illegal, gaps, cost, audit, repaired_sha256.

    Empty and very long texts are texts like any other; a table without rows gives none.
    """
    rows = laid(rows)
    marked = written(faults(rows, block))
    # One row a conversation leaves each task: few turns fold before the shuffle.
    counts = marked.groupBy("key").agg(
        *(F.count(F.when(F.col("fault") == f, 1)).alias(f) for f in ("blank", "duplicate", "truncated")),
        F.max("turn").alias("_last"),
        F.min("turn").alias("_first"),
    )
    turns = (
        marked.where(F.col("turn").isNotNull()).groupBy("key", "turn").agg(F.lit(1).alias("_one"))
        .groupBy("key").agg(F.count("*").alias("_turns"))
    )
    chosen = written(edits(marked, block))
    audits = chosen.groupBy("key").agg(
        F.sum("cost").alias("cost"),
        F.sum("illegal").alias("illegal"),
        F.sort_array(F.collect_list(F.struct("block", F.array_join("actions", "").alias("a")))).alias("parts"),
    ).select(
        "key",
        "cost",
        "illegal",
        F.translate(F.array_join("parts.a", ""), "uaUA", "IIRR").alias("audit"),
    )
    fates = (
        marked.select("_at", "key", "block", "pos", "len")
        .join(chosen.select("key", "block", "actions"), ["key", "block"])
        .withColumn("action", F.element_at("actions", (F.col("pos") % block + 1).cast("int")))
        .withColumn("tail", F.element_at("actions", -1))
        .drop("block", "actions")
    )
    # The texts move once, with what becomes of them, in runs of neighbours.
    pieces = written(
        fates.unionByName(rows.select("_at", "role", "text"), allowMissingColumns=True)
        .repartition(F.shiftright("_at", RUN))
        .sortWithinPartitions("_at", F.col("text").isNotNull())
        .mapInArrow(_repaired, _PIECES)
    )
    whole = pieces.where("whole").select("key", F.col("text").alias("sha256"))
    long = chained(pieces.where("not whole"), ["key"], "number", "text", "\n")
    gaps = F.col("_last") - F.col("_first") + 1 - F.col("_turns")
    return (
        counts.join(turns, "key", "left")
        .join(audits, "key")
        .join(whole.unionByName(long), "key", "left")
        .select(
            "key",
            F.coalesce(gaps, F.lit(0)).cast("bigint").alias("gaps"),
            "blank",
            "duplicate",
            "truncated",
            "illegal",
            "cost",
            "audit",
            F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
        )
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows (key, turn, role, text) with faults put in by crc32(conv_id:turn) % 20.

    0 drops the row, 1 empties its text, 2 takes every `.`, `!` and `?` from it, 3 repeats
    it, 4 sets its role to user. Nulls are one space: in role and text, in the key, and in
    what is hashed. Rows with a null conv_id are one conversation.
    """
    key = F.coalesce(F.col("conv_id").cast("string"), F.lit(" "))
    turn = F.coalesce(F.col("turn").cast("string"), F.lit(" "))
    lot = F.crc32(F.concat(key, F.lit(":"), turn).cast("binary")) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    return (
        conversations.select(
            key.alias("key"),
            F.col("turn").cast("bigint").alias("turn"),
            F.when(lot == 4, "user").otherwise(role).alias("role"),
            F.when(lot == 1, "").when(lot == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
            lot.alias("lot"),
        )
        .where("lot <> 0")
        .withColumn("copy", F.explode(F.expr("if(lot = 3, array(0, 1), array(0))")))
        .drop("lot", "copy")
    )


def op13_repair(spark, sf_dir: str) -> DataFrame:
    """All conversations, damaged and repaired; a null conv_id is a conversation of its own."""
    visible(spark)
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    every = conversations.select(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")).alias("key")).distinct()
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return every.join(repaired(damaged(conversations)), "key", "left").select(
        F.when(F.col("key") != " ", F.col("key")).cast("bigint").alias("conv_id"),
        *(F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in counts),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


#: crc32 by its bits, since DuckDB has none.
_LOT = """xor(4294967295, list_reduce(
    list_prepend(4294967295::ubigint, [ord(x)::ubigint for x in string_split(key || ':' || coalesce(turn::varchar, ' '), '')]),
    lambda c, byte: list_reduce(
        list_prepend(xor(c, byte), range(8)::ubigint[]),
        lambda v, i: case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end)))::bigint % 20"""


def _after(state: int, cost: str, letter: str, line: str) -> str:
    """A move's cost, audit and lines, in front of the best of a state behind the row."""
    rest = f"best[{state + 1}]"
    return f"{{'c': {rest}.c + {cost}, 'a': '{letter}' || {rest}.a, 'o': list_prepend({line}, {rest}.o)}}"


def _past(state: int) -> str:
    """The best way from a state that starts by passing the row."""
    ways = [f"{{'c': best[{state + 1}].c + 3, 'a': 'D' || best[{state + 1}].a, 'o': best[{state + 1}].o}}"]
    for initial, after in FOLLOWS[state].items():
        kept = _after(after, "cut", "K", "role || ':' || text")
        ways.append(f"case when not gone and initial = '{initial}' then {kept} end")
    mended = _after(FOLLOWS[state][WANTED[state]], "cut + 2", "R", f"'{NAMES[WANTED[state]]}:' || text")
    ways.append(f"case when not gone then {mended} end")
    return f"list_sort(list_filter([{', '.join(ways)}], lambda w: w is not null))[1]"


def _opened(state: int) -> str:
    """The best way from a state: at once, or after one or two insertions."""
    ways, before, at = [f"base[{state + 1}]"], [], state
    for _ in range(2 if state < USER else 1):
        before.append(f"'{NAMES[WANTED[at]]}:'")
        at = FOLLOWS[at][WANTED[at]]
        ways.append(
            f"{{'c': base[{at + 1}].c + {2 * len(before)}, 'a': '{'I' * len(before)}' || base[{at + 1}].a, "
            f"'o': list_concat([{', '.join(before)}], base[{at + 1}].o)}}"
        )
    return f"list_sort([{', '.join(ways)}])[1]"


#: Dynamic programming from the last row to the first, a check on the heaps.
OP13_SQL = f"""
with recursive given as (
    select coalesce(conv_id::varchar, ' ') as key, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text
    from conversations
), drawn as (
    select *, {_LOT} as lot from given
), harmed as (
    select key, turn, case lot when 4 then 'user' else role end as role,
           case lot when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
           unnest(range(case lot when 3 then 2 else 1 end)) as copy
    from drawn where lot <> 0
), placed as (
    select *, left(role, 1) as initial,
           row_number() over (partition by key order by turn nulls first, sha256(length(role) || ':' || role || text), copy) as i,
           rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as ink
    from harmed
), marked as (
    select *, row_number() over (partition by key, role, text order by i) > 1 as again,
           lag(initial) over (partition by key order by i) as earlier
    from placed
), rows as (
    select *, ink = '' as blank, ink <> '' and again as doubled,
           ink <> '' and not again and right(ink, 1) not in ('.', '!', '?') as cut_off from marked
), steps as (
    select key, i, role, text, initial, blank or doubled as gone, cut_off::bigint as cut from rows
), ends as (
    select [{{'c': 0::bigint, 'a': '', 'o': []::varchar[]}}, {{'c': 1000000000000::bigint, 'a': '', 'o': []::varchar[]}},
            {{'c': 1000000000000::bigint, 'a': '', 'o': []::varchar[]}}, {{'c': 0::bigint, 'a': '', 'o': []::varchar[]}}] as base
), ways as (
    select key, n + 1 as i, [{', '.join(map(_opened, STATES))}] as best
    from (select key, max(i) as n from steps group by key), ends
    union all
    select key, i, [{', '.join(map(_opened, STATES))}] as best
    from (select s.key, s.i, [{', '.join(map(_past, STATES))}] as base
          from ways w join steps s on s.key = w.key and s.i = w.i - 1)
), counted as (
    select key, case when count(turn) > 0 then max(turn) - min(turn) + 1 - count(distinct turn) else 0 end as gaps,
           count(*) filter (blank) as blank, count(*) filter (doubled) as duplicate, count(*) filter (cut_off) as truncated,
           count(*) filter (earlier is not null and earlier || initial not in ('su', 'ua', 'au')) as illegal
    from rows group by key
), done as (
    select c.*, w.best[1].c as cost, w.best[1].a as audit, array_to_string(w.best[1].o, chr(10)) as lines
    from counted c join ways w on w.key = c.key and w.i = 1
)
select case when g.key <> ' ' then g.key end::bigint as conv_id, coalesce(gaps, 0)::bigint as gaps,
       coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate,
       coalesce(truncated, 0)::bigint as truncated, coalesce(illegal, 0)::bigint as illegal,
       coalesce(cost, 0)::bigint as cost, coalesce(audit, '') as audit, sha256(coalesce(lines, '')) as repaired_sha256
from (select distinct key from given) g left join done on done.key = g.key
"""
