"""The prefix trie and the repair of conversations against plain Python."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from cliptrack.llm import prefix_trie, sequences, shared, structure_repair
from cliptrack.llm.structure_repair import ACCEPT, START, audit_of, cheapest

SCHEMA = "conv_id long, turn long, role string, text string"
EMPTY = hashlib.sha256(b"").hexdigest()


@pytest.fixture(autouse=True)
def _workers(spark):
    shared.visible(spark)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def table(spark, rows, extra=False):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    names = ("pos", "len", "key", "depth", "node", "_at", "size") if extra else ()
    for name in names:
        df = df.selectExpr("*", f"'clash' as {name}")
    return df


def stored(spark, rows, folder, extra=True):
    table(spark, rows, extra).write.parquet(f"{folder}/conversations.parquet")
    return str(folder)


def in_order(row):
    turn, role, text = row
    return turn is not None, turn or 0, sha(f"{len(role)}:{role}{text}")


# -- numbers and chains -------------------------------------------------------


def test_rows_are_numbered_within_groups_that_span_ranges(spark):
    rows = [(1, i % 7) for i in range(4000)] + [(g, 0) for g in range(2, 60)]
    df = spark.createDataFrame(rows, "g long, x long").repartition(6)
    got = sequences.numbered(sequences.laid_out(df, "g", [df["x"].asc()]), "g").collect()
    by_group = defaultdict(list)
    for r in got:
        by_group[r.g].append((r.pos, r.x, r.len))
    assert sorted(by_group) == list(range(1, 60))
    for group in by_group.values():
        group.sort()
        assert [p for p, _, _ in group] == list(range(len(group)))
        assert [x for _, x, _ in group] == sorted(x for _, x, _ in group)
        assert {n for _, _, n in group} == {len(group)}


def test_equal_rows_spread_over_ranges(spark):
    df = spark.createDataFrame([(1, 5)] * 8000 + [(2, 5)] * 100, "g long, x long").repartition(6)
    laid = sequences.laid_out(df, "g", [df["x"].asc()])
    assert sequences.numbered(laid, "g").count() == 8100
    sizes = [r["count"] for r in laid.groupBy((laid["_at"] / 2**33).cast("long")).count().collect()]
    assert max(sizes) < 3 * sorted(sizes)[len(sizes) // 2]


def test_a_chain_hashes_texts_in_order(spark, monkeypatch):
    rows = [(1, i, f"t{i}") for i in range(3000)] + [(2, 5, ""), (2, 1, "é"), (3, 0, "x" * 100_000)]
    df = spark.createDataFrame(rows, "g long, n long, t string").repartition(5)
    got = {r.g: r.sha256 for r in sequences.chained(df, ["g"], "n", "t", ", ").collect()}
    assert got == {1: sha(", ".join(f"t{i}" for i in range(3000))), 2: sha("é, "), 3: sha("x" * 100_000)}


# -- op 11 --------------------------------------------------------------------


def plain_trie(rows):
    given = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            given[conv].append((turn, role or "", text or ""))
    for turns in given.values():
        turns.sort(key=in_order)
    nodes, ends = defaultdict(list), defaultdict(list)
    for conv in given:
        h = zlib.crc32(str(conv).encode()) % 9
        new = [t[1:] for t in given.get(conv - conv % 5, [])[:h] + given[conv][h:]]
        for d in range(len(new) + 1):
            nodes[tuple(new[:d])].append(conv)
        ends[tuple(new)].append(conv)
    children = defaultdict(list)
    for path in nodes:
        if path:
            children[path[:-1]].append(path)

    def below(path):
        todo = [path]
        while todo:
            at = todo.pop()
            yield at
            todo += children[at]

    return {
        (
            min(members),
            len(path),
            min(nodes[path[:-1]]) if path else None,
            len(members),
            len(children[path]),
            sum(not children[p] for p in below(path)),
            sum((len(nodes[p]) - 1) * len(p[-1][1].encode()) for p in below(path) if p),
            sha(",".join(map(str, sorted(ends[path])))),
        )
        for path, members in nodes.items()
    }


def some_conversations(rng, n, longest):
    rows = []
    for conv in range(n):
        for turn in range(rng.randrange(1, longest)):
            role = rng.choice(["user", "assistant", "system", None])
            rows.append((conv, turn, role, rng.choice(["a", "é", "", None, f"text {turn}"])))
    return rows


COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


@pytest.mark.parametrize("seed, n, longest, stretch", [(1, 60, 4, 1024), (2, 40, 30, 4)])
def test_trie_is_that_of_all_prefixes(spark, tmp_path, monkeypatch, seed, n, longest, stretch):
    monkeypatch.setattr(prefix_trie, "STRETCH", stretch)
    rng = random.Random(seed)
    rows = some_conversations(rng, n, longest)
    # null and tied turns, a repeated row, ids without a base, a negative one, no id
    rows += [(0, None, "user", "first"), (0, 0, "user", "tie"), rows[3], rows[3], (None, 1, "user", "x")]
    rows += [(1003, 0, "user", "alone"), (-7, 0, "user", "a"), (500, 0, "user", "a" * 50_000)]
    rows += [(100, t, "user", "same") for t in range(11)] + [(101 + i, t, "user", "same") for i in range(4) for t in range(11)]
    got = prefix_trie.op11_trie(spark, stored(spark, rows, tmp_path)).select(*COLUMNS).collect()
    want = plain_trie(rows)
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_trie_of_one_long_conversation_and_of_none(spark, tmp_path):
    rows = [(5, t, "user", f"t{t % 3}") for t in range(150)]
    got = prefix_trie.op11_trie(spark, stored(spark, rows, tmp_path / "one")).select(*COLUMNS).collect()
    assert {tuple(r) for r in got} == plain_trie(rows) and len(got) == 151
    none = prefix_trie.op11_trie(spark, stored(spark, [], tmp_path / "none"))
    assert sorted(none.columns) == sorted(COLUMNS) and none.count() == 0


def test_conversations_without_turns_end_in_the_root(spark, tmp_path):
    ids = [c for c in range(1, 400) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 0][:6]
    rows = [(c, 0, "user", "gone") for c in ids]
    got = prefix_trie.op11_trie(spark, stored(spark, rows, tmp_path)).select(*COLUMNS).collect()
    assert [tuple(r) for r in got] == [(min(ids), 0, None, 6, 0, 1, 0, sha(",".join(map(str, ids))))]


# -- op 13 --------------------------------------------------------------------

NEED = "uuau"
STEP = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
NAMES = {"u": "user", "a": "assistant"}


def plain_repair(rows):
    """By dynamic programming from the end; rows are (turn, role, text) after damage."""
    rows = sorted(rows, key=in_order)
    seen, faults = set(), []
    for _, role, text in rows:
        ink = re.sub(r"[\x20\x09-\x0d]", "", text)
        faults.append("b" if not ink else "d" if (role, text) in seen else "t" if ink[-1] not in ".!?" else "")
        seen.add((role, text))
    initials = [role[:1] for _, role, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    turns = [turn for turn, _, _ in rows if turn is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    best = [[None] * 4 for _ in range(len(rows) + 1)]
    for i in range(len(rows), -1, -1):
        for _ in range(4):  # insertions may follow one another
            new = []
            for q in range(4):
                ways = [(0, "", [])] if i == len(rows) and q in (0, 3) else []
                if (after := best[i][STEP[q][NEED[q]]]) is not None:
                    ways.append((after[0] + 2, "I" + after[1], [NAMES[NEED[q]] + ":", *after[2]]))
                if i < len(rows):
                    _, role, text = rows[i]
                    cut = faults[i] == "t"
                    after = best[i + 1][q]
                    if after is not None:
                        ways.append((after[0] + 3, "D" + after[1], after[2]))
                    moves = [] if faults[i] in ("b", "d") else [("K", initials[i], 0, role), ("R", NEED[q], 2, NAMES[NEED[q]])]
                    for letter, to, cost, name in moves:
                        after = best[i + 1][STEP[q][to]] if to in STEP[q] else None
                        if after is not None:
                            ways.append((after[0] + cost + cut, letter + after[1], [f"{name}:{text}", *after[2]]))
                new.append(min(ways, default=None))
            best[i] = new
    cost, audit, lines = best[0][0]
    return gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, sha("\n".join(lines))


def plain_damage(rows):
    out, ids = defaultdict(list), set()
    for conv, turn, role, text in rows:
        ids.add(conv)
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        lot = zlib.crc32(key.encode()) % 20
        role, text = (" " if v is None else v for v in (role, text))
        text = "" if lot == 1 else re.sub("[.!?]", "", text) if lot == 2 else text
        out[conv] += [(turn, "user" if lot == 4 else role, text)] * {0: 0, 3: 2}.get(lot, 1)
    return {c: plain_repair(out[c]) if out[c] else (0, 0, 0, 0, 0, 0, "", EMPTY) for c in ids}


REPAIRED = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def odd_conversations(rng, lengths):
    roles = ["user", "assistant", "assistant", "system", "tool", None, "", "u"]
    texts = ["hi.", "ok", "  ", "a b?", "", "x" * 9, None, "é!  \n", "same."]
    return [
        (conv, rng.choice([t, t, t, t + 1, t + 5, None]), rng.choice(roles), rng.choice(texts))
        for conv, n in enumerate(lengths)
        for t in range(n)
    ]


def test_repairs_are_the_cheapest(spark, tmp_path):
    rng = random.Random(5)
    rows = odd_conversations(rng, [rng.choice([1, 2, 3, 5, 9, 30]) for _ in range(60)] + [700])
    rows += [(None, 3, "user", "no id."), (None, 4, "user", "z" * 100_000 + ".")]
    rows += [(900, 1, "user", "again.")] * 40
    dropped = next(c for c in range(1000, 2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows.append((dropped, 0, "user", "dropped."))
    got = structure_repair.op13_repair(spark, stored(spark, rows, tmp_path)).select("conv_id", *REPAIRED).collect()
    want = plain_damage(rows)
    assert len(got) == len(want)
    for r in got:
        assert tuple(r)[1:] == want[r.conv_id], r.conv_id
    assert want[dropped] == (0, 0, 0, 0, 0, 0, "", EMPTY)


def test_cuts_do_not_change_a_repair(spark):
    rng = random.Random(6)
    rows = [
        (str(c), t, role or " ", text or " ")
        for c, t, role, text in odd_conversations(rng, [1, 2, 4, 5, 6, 7, 8, 9, 13, 40, 41, 90])
    ]
    df = spark.createDataFrame(rows, "key string, turn long, role string, text string").repartition(4)
    whole = {r.key: tuple(r) for r in structure_repair.repaired(df).collect()}
    cut = {r.key: tuple(r) for r in structure_repair.repaired(df, block=4).collect()}
    assert whole == cut
    for key, row in whole.items():
        assert row[1:] == plain_repair([r[1:] for r in rows if r[0] == key])


def test_a_search_finds_the_least_audit_of_all_cheapest():
    rng = random.Random(7)
    kinds = {"s": "system", "u": "user", "a": "assistant", "o": "tool"}
    for _ in range(1500):
        codes = "".join(rng.choice("suaoSUAO-") for _ in range(rng.randrange(0, 9)))
        cost, actions, _ = cheapest(codes, START, ACCEPT, True)
        rows = [
            (i, "user", "") if c == "-" else (i, kinds[c.lower()], f"{i}" + "." * c.islower())
            for i, c in enumerate(codes)
        ]
        assert (cost, audit_of("".join(actions))) == plain_repair(rows)[5:7], codes


def test_no_conversations(spark, tmp_path):
    got = structure_repair.op13_repair(spark, stored(spark, [], tmp_path))
    assert got.columns == ["conv_id", *REPAIRED] and got.count() == 0
