"""The pipeline against plain Python on a small table, and its registration."""

import random
from collections import Counter

import corpus_pipeline
import __spark_entry__ as entry
from cliptrack.llm import piece_lattice, shared
from cliptrack.llm.queries import QUERIES, SQL
from oracle import differences, duck
from test_operators import by_rules, plain_groups, plain_mix, prose


def tables(spark, folder):
    rng = random.Random(12)
    texts = [None, "", "a@b.example", "call +1 (988) 555-2485 now"]
    for i in range(260):
        text = prose(rng, rng.randrange(12, 60))
        if i % 5 == 0:
            text += " blurgh zoink"
        if i % 7 == 0:
            text += " jo.7@mail.example and 10.20.30.40"
        texts.append(text)
    for i in range(20, 60):  # near copies, of toxic documents too
        texts.append(texts[i] + " end")
    rows = [
        (i, t, "en", f"src{0 if i % 3 else i % 5}", len(t or "")) for i, t in enumerate(texts)
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, int("blurgh" in (t or ""))) for i, t in enumerate(texts) if i % 4]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(
        f"{folder}/labels.parquet"
    )
    return texts, rows


def masked(text):
    found = by_rules(text or "")
    for kind, start, end in reversed(found):
        text = text[:start] + f"<{kind.upper()}>" + text[end:]
    return text


def test_pipeline_equals_plain_python(spark, tmp_path):
    texts, rows = tables(spark, f"file:{tmp_path}")
    clean = [r for r in rows if "blurgh" not in (r[1] or "")]
    sets, tops, links = plain_groups([r[1] for r in clean], 5, 80)
    assert links
    clean = [r for k, r in enumerate(clean) if not sets[k] or tops[k] == k]
    kept = [{"doc_id": r[0], "text": masked(r[1]), "source": r[3]} for r in clean]
    by_id = {r["doc_id"]: r["text"] for r in kept}
    want = Counter((d, by_id[d]) for _, d, _ in plain_mix(kept))
    got = corpus_pipeline.run(spark, f"file:{tmp_path}").collect()
    v = piece_lattice.vocabulary()
    assert all(r.lossless for r in got)
    assert Counter((r.doc_id, piece_lattice.decoded(r.ids, v)) for r in got) == want


def test_stages_hand_documents_on(spark, tmp_path):
    tables(spark, f"file:{tmp_path}")
    docs = spark.read.parquet(f"file:{tmp_path}/documents.parquet")
    assert len(corpus_pipeline.STAGES) == 5
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = shared.written(stage(spark, docs, f"file:{tmp_path}"))
        assert after.dtypes == docs.dtypes, name
        assert shared.written(stage(spark, docs.limit(0), f"file:{tmp_path}")).count() == 0, name
        docs = after


def test_registered(spark):
    names = entry.queries()
    assert {f"op{n}_" for n in range(1, 14)} == {k.split("_")[0] + "_" for k in QUERIES}
    assert set(QUERIES) | {"pipeline"} <= set(names)
    small = "/root/testdata/sf0.001"
    for name in SQL:
        assert differences(spark, duck(small), name, small) is None
