"""A corpus pipeline: toxic documents go, near copies go, personal data is masked, the
sources are mixed to their target weights, and what is left is encoded in pieces.

Each stage takes (spark, documents, folder of the tables) and works on all that the
one before it kept. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cliptrack.llm.jaccard_join import without_near_copies
from cliptrack.llm.mixing import mixed
from cliptrack.llm.piece_lattice import with_ids
from cliptrack.llm.pii import without
from cliptrack.llm.shared import visible, written
from cliptrack.llm.toxicity import THRESHOLD, classifier, scored, taught_rows


def toxicity(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a classifier of the labelled ones holds for toxic are rejected.

    It learns from the labels outside the held-out fourth. Null and empty texts stay.
    """
    visible(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = classifier(docs, taught_rows(labels))
    # The row stays in one column, beside which any name is free.
    marked = docs.select(F.struct(*docs.columns).alias("row"), "text")
    return scored(marked, model).where(F.col("score") < THRESHOLD).select("row.*")


def near_copies(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that of the smallest id.

    Near: four fifths of the five-word shingles in common. Texts without words stay.
    """
    visible(spark)
    return without_near_copies(docs, width=5, percent=80)


def pii(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes placeholders; all documents stay, n_chars is counted anew."""
    visible(spark)
    masked = without(docs)
    if "n_chars" in docs.columns:
        length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        masked = masked.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(length))
    return masked


def mixing(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated, or left out, by Poisson counts that bring the sources to
    weights between equal and their sizes; the rows come in one global random order."""
    return mixed(docs).select(*docs.columns)


def pieces(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as sampled pieces: doc_id, source, ids, n_tokens, lossless."""
    return with_ids(docs, keep=["doc_id", "source"])


STAGES = [
    ("toxicity", toxicity),
    ("ngram_jaccard_join", near_copies),
    ("pii", pii),
    ("mixing", mixing),
    ("sentencepiece", pieces),
]

#: A trained classifier and sampled lattices are beyond SQL; tests/llm compares run()
#: with plain Python on a small table.
ORACLE_SQL = None


def run(spark, sf_dir: str) -> DataFrame:
    """The stages over documents, each written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
