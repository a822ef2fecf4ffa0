"""Toxicity: a linear classifier that is held to the same score for swapped identities."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cliptrack.llm.shared import CHUNK, crc, folded, tidy, written

#: Labelled rows that the classifier is fitted on, at most; those of lowest hash.
SAMPLE = 12_000
#: Parts of words that it may weigh, at most; those that tell the labels apart best.
PARTS = 8192
#: Likelihood ratio from which a part counts as tied to the label.
MARKED = 18.0
THRESHOLD = 0.3

#: Terms that name groups of people, in English, German, French and Spanish. Within a line
#: any may stand for any other.
IDENTITIES: dict[str, tuple[str, ...]] = {
    "gender": ("women", "men", "females", "males"),
    "one": ("woman", "man", "girl", "boy"),
    "orientation": ("gay", "lesbian", "straight", "bisexual", "heterosexual", "queer"),
    "religion": ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic"),
    "believers": ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics"),
    "origin": ("black", "white", "asian", "african", "european", "latino", "arab"),
    "status": ("immigrant", "refugee", "foreigner", "migrant", "citizen", "local"),
    "many": ("immigrants", "refugees", "foreigners", "migrants", "citizens", "locals"),
    "body": ("disabled", "blind", "deaf", "autistic", "elderly", "young"),
    "geschlecht": ("frauen", "männer", "mädchen", "jungen"),
    "eine": ("frau", "mann"),
    "orientierung": ("schwul", "lesbisch", "bisexuell", "heterosexuell"),
    "gläubige": ("muslime", "christen", "juden", "buddhisten", "atheisten", "katholiken"),
    "gläubig": ("muslimisch", "christlich", "jüdisch", "hinduistisch", "buddhistisch", "katholisch"),
    "herkunft": ("schwarze", "weiße", "asiaten", "afrikaner", "europäer", "araber"),
    "zugezogen": ("einwanderer", "flüchtlinge", "ausländer", "migranten", "einheimische"),
    "körper": ("behinderte", "blinde", "gehörlose", "autisten", "senioren"),
    "genre": ("femmes", "hommes", "filles", "garçons"),
    "une": ("femme", "homme", "fille", "garçon"),
    "orientation fr": ("homosexuels", "lesbiennes", "bisexuels", "hétérosexuels"),
    "croyants": ("musulmans", "chrétiens", "juifs", "hindous", "bouddhistes", "athées", "catholiques"),
    "croyant": ("musulman", "chrétien", "juif", "hindou", "bouddhiste", "athée", "catholique"),
    "origine": ("noirs", "blancs", "asiatiques", "africains", "européens", "arabes"),
    "arrivés": ("immigrés", "réfugiés", "étrangers", "citoyens"),
    "corps": ("handicapés", "aveugles", "sourds", "autistes", "âgés"),
    "género": ("mujeres", "hombres", "niñas", "niños"),
    "una": ("mujer", "hombre", "niña", "niño"),
    "orientación": ("homosexuales", "lesbianas", "bisexuales", "heterosexuales"),
    "creyentes": ("musulmanes", "cristianos", "judíos", "hindúes", "budistas", "ateos", "católicos"),
    "creyente": ("musulmán", "cristiano", "judío", "hindú", "budista", "ateo", "católico"),
    "origen": ("negros", "blancos", "asiáticos", "africanos", "europeos", "árabes"),
    "llegados": ("inmigrantes", "refugiados", "extranjeros", "ciudadanos"),
    "cuerpo": ("discapacitados", "ciegos", "sordos", "autistas", "ancianos"),
}

_BITS = 20
_SIZES = (4, 5, 6, 7)
_PLAIN = bytes(b if b >= 128 or 97 <= b <= 122 else 48 if 48 <= b <= 57 else 32 for b in range(256))
_ROWS = 256  # texts that are scored at a time
_SPREAD = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) ^ (
    np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F) >> np.uint64(29)
)


def _buckets(texts: Sequence[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, bucket) of every part of a word, 4 to 7 bytes with the spaces around it.

    Whole texts, a chunk at a time; a long text is cut at spaces.
    """

    def parts(rows, raws):
        joined = np.frombuffer(b" ".join([b"", *raws, b""]), np.uint8)
        starts = np.cumsum([1] + [len(r) + 1 for r in raws])[:-1]
        n = len(joined)
        space = np.where(joined == 32, np.arange(n, dtype=np.int32), n + 8)
        after = np.append(np.minimum.accumulate(space[::-1])[::-1][1:], n + 8)
        room = after - np.arange(n, dtype=np.int32)
        values = _SPREAD[joined]
        h = values.copy()
        for size in range(2, _SIZES[-1] + 1):
            if n < size:
                break
            h = h[: n - size + 1] + values[size - 1 :] * np.uint64(
                pow(0x9E3779B97F4A7C15, size, 1 << 64)
            )
            if size in _SIZES:
                at = np.flatnonzero(room[: len(h)] >= size - 1)
                found = ((h[at] + np.uint64(size)) * np.uint64(0xE7037ED1A0B428DB)) >> np.uint64(
                    64 - _BITS
                )
                yield rows[np.searchsorted(starts, at, "right") - 1], found.astype(np.int64)

    rows, raws, size = [], [], 0
    for row, text in enumerate(texts):
        raw, at = folded(text).translate(_PLAIN), 0
        while at < len(raw):
            cut = len(raw)
            if cut - at > CHUNK and (space := raw.find(b" ", at + CHUNK)) >= 0:
                cut = space
            if raws and size + cut - at > CHUNK:
                yield from parts(np.array(rows), raws)
                rows, raws, size = [], [], 0
            rows.append(row)
            raws.append(raw[at:cut])
            size += cut - at
            at = cut
    if raws:
        yield from parts(np.array(rows), raws)


def _known(texts: Sequence[str | None], index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, part) with a number in index, by row."""
    pairs = [np.zeros(0, np.int64)]
    width = int(index.max(initial=0)) + 1
    for rows, found in _buckets(texts):
        numbers = index[found]
        hit = numbers >= 0
        # np.maximum: an index of nothing has no number at all
        pairs.append(np.unique(np.maximum(rows[hit], 0) * width + numbers[hit]))
    both = np.unique(np.concatenate(pairs))
    return both // width, both % width


def swapper(identities: Mapping[str, Sequence[str]]):
    """text -> the text with every identity term replaced by another of its line."""
    line = {term: terms for terms in identities.values() for term in terms}
    if not line:
        return lambda text: text
    terms = re.compile(rf"\b({'|'.join(map(re.escape, sorted(line, key=len, reverse=True)))})\b", re.IGNORECASE)

    def other(text):
        turn = zlib.crc32(text.encode("utf-8", "surrogatepass"))

        def swap(m):
            terms = line[m[0].lower()]
            at = terms.index(m[0].lower())
            return terms[(at + 1 + turn % (len(terms) - 1)) % len(terms)]

        return terms.sub(swap, text)

    return lambda text: text and other(text)


def fitted(
    rows: np.ndarray, parts: np.ndarray, swapped_rows: np.ndarray, swapped_parts: np.ndarray,
    labels: np.ndarray, width: int, fairness: float, ridge: float = 2e-4, steps: int = 400,
) -> np.ndarray:
    """Weights and, last, the bias of a logistic model over the parts present.

    The loss adds fairness times the mean squared difference between the scores of a
    row and of the same row with its identity terms swapped. Full batches, so that
    the same rows give the same weights.
    """
    n = len(labels)
    w = np.zeros(width + 1)
    prior = np.clip(labels.mean(), 1e-6, 1 - 1e-6)
    w[-1] = np.log(prior / (1 - prior))
    first, second = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        z = np.bincount(rows, w[parts], n) + w[-1]
        other = np.bincount(swapped_rows, w[swapped_parts], n) + w[-1]
        wrong = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - labels) / n
        apart = 2 * fairness * (z - other) / n
        grad = np.bincount(parts, (wrong + apart)[rows], width + 1)
        grad -= np.bincount(swapped_parts, apart[swapped_rows], width + 1)
        grad[-1] = wrong.sum()
        grad[:-1] += ridge * w[:-1]
        first = 0.9 * first + 0.1 * grad
        second = 0.99 * second + 0.01 * grad**2
        rate = 0.1 * (1 - step / (steps + 1))
        w -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
    return w


def classifier(
    documents: DataFrame,
    labels: DataFrame,
    identities: Mapping[str, Sequence[str]] = IDENTITIES,
    fairness: float = 1.0,
    sample: int = SAMPLE,
    parts: int = PARTS,
) -> tuple[np.ndarray, np.ndarray]:
    """(number of each bucket or -1, weights) learned from (doc_id, toxic) in labels.

    At most `sample` labelled ids are used, those of lowest hash, and at most `parts`
    buckets; so what reaches the driver is bounded by the two. Of documents that share
    an id one teaches, that of lowest hash, then lowest text. Ids labelled more than
    once are toxic if any label is; null labels and ids are left out. Without any
    label nothing is known and every score is 0.
    """
    known = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id")
    chosen = (
        known.agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    rows = written(
        documents.select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")
        # One row an id, so `sample` rows at most; copies fold in every task first.
        .groupBy("doc_id")
        .agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least"), F.max("toxic").alias("toxic"))
        .select("least.text", F.col("toxic").cast("double"))
    )

    def counts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = np.zeros((2, 1 << _BITS), np.int64)
        for frame in frames:
            toxic = frame["toxic"].to_numpy()
            for row, part in _buckets(frame["text"].tolist()):
                both = np.unique((row << _BITS) | part)  # a text counts a part once
                label, part = toxic[both >> _BITS], both & ((1 << _BITS) - 1)
                for x in (0, 1):
                    held[x] += np.bincount(part[label == x], minlength=1 << _BITS)
        at = np.flatnonzero(held.sum(0))
        yield pd.DataFrame({"bucket": at, "clean": held[0, at], "toxic": held[1, at]})

    totals = rows.groupBy().agg(F.count("*"), F.sum("toxic")).first()
    total, toxic_total = int(totals[0]), float(totals[1] or 0)
    index = np.full(1 << _BITS, -1, np.int64)
    if not total:
        return index, np.array([-np.inf])
    # How far presence and label are from independent, as a likelihood ratio.
    share = toxic_total / total
    telling = (
        rows.mapInPandas(counts, "bucket long, clean long, toxic long")
        .groupBy("bucket")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .withColumn("n", F.col("clean") + F.col("toxic"))
        .where("n >= 3")
    )
    if not 0 < share < 1:
        return index, np.array([40.0 if share else -40.0])

    def term(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    n, t, c = F.col("n"), F.col("toxic"), F.col("clean")
    absent_t, absent_c = F.lit(toxic_total) - t, F.lit(total - toxic_total) - c
    absent = F.lit(float(total)) - n
    ratio = 2 * (
        term(t, n * share) + term(c, n * (1 - share))
        + term(absent_t, absent * share) + term(absent_c, absent * (1 - share))
    )
    best = (
        telling.withColumn("ratio", ratio).where(F.col("ratio") >= MARKED).orderBy(F.desc("ratio"), "bucket").limit(parts)
    )
    picked = np.array([r["bucket"] for r in best.select("bucket").collect()], np.int64)
    index[picked] = np.arange(len(picked))
    swap = swapper(identities)

    def numbers(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), _ROWS):
                some = frame.iloc[at : at + _ROWS]
                texts, both = some["text"].tolist(), []
                for version in (texts, [swap(t) for t in texts]):
                    row, part = _known(version, index)
                    cuts = np.searchsorted(row, np.arange(1, len(texts)))
                    both.append(np.split(part, cuts))
                yield pd.DataFrame({"toxic": some["toxic"].to_numpy(), "own": both[0], "swapped": both[1]})

    held = rows.mapInPandas(numbers, "toxic double, own array<int>, swapped array<int>").toArrow()

    def flat(column):
        sizes = pc.list_value_length(column).to_numpy()
        return np.repeat(np.arange(len(sizes)), sizes), pc.list_flatten(column).to_numpy().astype(np.int64)

    # Few texts name identities. Where none does, the swapped ones need no second copy.
    both = flat(held["own"])
    both *= 2
    if not held["swapped"].equals(held["own"]):
        both = both[:2] + flat(held["swapped"])
    toxic = held["toxic"].to_numpy()
    del held
    tidy()
    return index, fitted(*both, toxic, len(picked), fairness)


def scored(documents: DataFrame, model: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """Adds score, 0 to 1, of the whole text; null and empty texts get the base rate.

    Columns of the input stay; one that is named score is replaced.
    """
    index, weights = model

    def sums(texts: list[str | None]) -> np.ndarray:
        row, part = _known(texts, index)
        return np.bincount(row, weights[part], len(texts)) if len(part) else np.zeros(len(texts))

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        held = texts.tolist()
        found = [sums(held[at : at + _ROWS]) for at in range(0, len(held), _ROWS)]
        z = np.concatenate([np.zeros(0), *found]) + weights[-1]
        return pd.Series(1 / (1 + np.exp(-np.clip(z, -500, 500))))

    return documents.withColumn("score", score("text"))


def taught_rows(labels: DataFrame) -> DataFrame:
    """The labels that may teach: those outside the held-out fourth."""
    return labels.where(crc("doc_id", 4) != 2)


def op1_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labels that aren't held out."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return scored(documents, classifier(documents, taught_rows(labels))).select(
        "doc_id",
        F.coalesce(crc("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
