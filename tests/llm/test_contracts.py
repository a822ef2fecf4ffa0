"""Every opN_ query over the smallest tables: its columns, rows and fixed rules."""

import math
import re
import zlib
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry

SMALL = "/root/testdata/sf0.001"
LOWER = {i: i + 32 for i in range(65, 91)}

#: What each query must return, with types; more columns may follow.
CONTRACTS = {
    "op1_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op2_context_trees": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, "
    "train_tokens bigint, base_score double, score double",
    "op3_pii": "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
    "base_sha256 string, spans string",
    "op4_ngram_join": "doc_id bigint, n_shingles bigint, component_id bigint",
    "op7_nearest": "query_id bigint, rank int, vec_id bigint, score double",
    "op8_sharding": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    "op9_html": "page_id bigint, url string, text string, n_chars bigint",
    "op10_lattice": "vec_id bigint, n_links bigint, component_id bigint, kept boolean",
    "op11_trie": "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, "
    "n_leaves bigint, saved_tokens bigint, ends_sha256 string",
    "op12_warc": "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint",
    "op13_repair": "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
    "cost bigint, audit string, repaired_sha256 string",
}
TABLES = {"op9": "pages", "op10": "embeddings", "op12": "pages"}


def column(table, *names):
    return duckdb.sql(f"select {', '.join(names)} from '{SMALL}/{table}.parquet'").fetchall()


@pytest.fixture(scope="module")
def found(spark):
    kept = {}

    def rows(name):
        if name not in kept:
            got = entry.queries()[name](spark, SMALL)
            kept[name] = got.dtypes, got.collect()
        return kept[name]

    return rows


@pytest.mark.parametrize("name", list(CONTRACTS))
def test_columns_and_rows(found, name):
    types, rows = found(name)
    types = dict(types)
    for wanted in CONTRACTS[name].split(", "):
        column_name, kind = wanted.split(" ")
        assert types[column_name] == kind, (name, column_name)
    if name in ("op7_nearest", "op11_trie", "op13_repair"):
        return
    table = TABLES.get(name.split("_")[0], "documents")
    key = {"documents": "doc_id", "pages": "page_id", "embeddings": "vec_id"}[table]
    assert Counter(r[key] for r in rows) == Counter(k for (k,) in column(table, key))


@pytest.mark.parametrize("name, divisor", [("op1_toxicity", 4), ("op2_context_trees", 7)])
def test_what_is_held_out(found, name, divisor):
    _, rows = found(name)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % divisor == 2) for r in rows)


def test_predictions_follow_the_threshold(found):
    _, rows = found("op1_toxicity")
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)


def test_base_scores_count_the_training_tokens(found):
    _, rows = found("op2_context_trees")
    tokens = {d: [*re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER)), None] for d, t in column("documents", "doc_id", "text")}
    counts = Counter(t for d, own in tokens.items() if zlib.crc32(str(d).encode()) % 7 != 2 for t in own)
    total, distinct = sum(counts.values()), len(counts)
    for r in rows:
        own = tokens[r.doc_id]
        assert (r.n_tokens, r.train_tokens, r.n_known) == (len(own), total, sum(t in counts for t in own))
        want = sum(math.log10((counts[t] + 1) / (total + distinct + 1)) for t in own)
        assert r.base_score == pytest.approx(want, rel=1e-9)
        assert r.score < 0


def test_nearest_are_queries_of_every_fiftieth(found):
    _, rows = found("op7_nearest")
    ranks = Counter(r.query_id for r in rows)
    assert all(q % 50 == 0 for q in ranks) and set(ranks.values()) == {5}
    assert all(r.vec_id != r.query_id and 1 <= r["rank"] <= 5 for r in rows)
