"""Operator 7: language identification by sparse multinomial logistic regression.

Features are character n-grams of one to three characters (letters in lower case, anything else a
blank, blanks run together), hashed to ``BUCKETS`` places and weighted by tf-idf; tf is the share
of the text's n-grams. Document frequencies are counted over all labelled training texts. The weights
are fitted by follow-the-regularised-leader with an L1 and an L2 penalty on a bounded sample of
``SAMPLE_PER_LANGUAGE`` texts of each language, those with the least hash of their key; a fifth of the sample
is set aside to calibrate the temperature. Predicting reads the whole text and nothing else.

Defined results: a null text, or one without a letter, is ``und`` with score 0; without any labelled
training text everything is ``und``; equal scores go to the first language in alphabetical order; repeated rows are
predicted each for itself.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridscope.llm import textarrays as ta
from gridscope.sources.tables import cut_lineage

BUCKET_BITS = 15
BUCKETS = 1 << BUCKET_BITS
ORDERS = (1, 2, 3)
SAMPLE_PER_LANGUAGE = 600
UNKNOWN = "und"

ALPHA, BETA, L1, L2, EPOCHS = 0.5, 1.0, 0.02, 0.05, 4
#: tf-idf values are small; one common factor keeps the learning rate in its usual range.
SCALE = 20.0

_FACTORS = ta.seeds(len(ORDERS), salt=7)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Lower-case code point of each letter, 32 for everything else."""
    table = np.full(sys.maxunicode + 1, 32, dtype=np.uint32)
    for point in range(sys.maxunicode + 1):
        letter = chr(point)
        if letter.isalpha():
            low = letter.lower()
            table[point] = ord(low) if len(low) == 1 else point
    return table


def grams(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and text number of every n-gram, and which texts have a letter."""
    n = len(cuts) - 1
    if len(data) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(n, bool)
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
    bounds = np.searchsorted(lead, cuts)
    letters = _letters()[points]
    text = np.repeat(np.arange(n), np.diff(bounds))
    solid = letters != 32
    keep = np.ones(len(points), dtype=bool)
    keep[1:] = solid[1:] | solid[:-1] | (text[1:] != text[:-1])
    letters, text = letters[keep].astype(np.uint64), text[keep]
    known = np.zeros(n, dtype=bool)
    known[text[letters != 32]] = True
    places, owners = [], []
    for order in ORDERS:
        if len(letters) < order:
            continue
        size = len(letters) - order + 1
        held = np.full(size, order, dtype=np.uint64)
        for i in range(order):
            held += letters[i: i + size] * _FACTORS[i]
        held *= np.uint64(0x9E3779B97F4A7C15)
        inside = text[:size] == text[order - 1:]
        places.append((held >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)[inside])
        owners.append(text[:size][inside])
    return np.concatenate(places), np.concatenate(owners), known


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # buckets x languages, idf included
    bias: np.ndarray
    temperature: float

    def scores(self, data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities per text and language, and which texts have a letter."""
        n = len(cuts) - 1
        places, owners, known = grams(data, cuts)
        totals = np.maximum(np.bincount(owners, minlength=n), 1)
        logits = np.empty((n, len(self.languages)))
        for k in range(len(self.languages)):
            logits[:, k] = np.bincount(owners, weights=self.weights[:, k][places], minlength=n) / totals + self.bias[k]
        return softmax(logits / self.temperature), known


def softmax(logits: np.ndarray) -> np.ndarray:
    held = np.exp(logits - logits.max(axis=1, keepdims=True))
    return held / held.sum(axis=1, keepdims=True)


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, documents = np.zeros(BUCKETS, dtype=np.int64), 0
    for batch in batches:
        for _, data, cuts in ta.chunks(batch.column(0), 1 << 18):
            places, owners, _ = grams(data, cuts)
            total += np.bincount(np.unique(owners * BUCKETS + places) % BUCKETS, minlength=BUCKETS)
            documents += len(cuts) - 1
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(total[some], documents))], ["place", "n"])


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, data, cuts in ta.chunks(batch.column(2), 1 << 18):
            places, owners, _ = grams(data, cuts)
            pair, counts = np.unique(owners * BUCKETS + places, return_counts=True)
            bounds = np.searchsorted(pair, np.arange(len(cuts)) * BUCKETS)
            n = len(cuts) - 1
            ids = [(pair[a:b] % BUCKETS).astype("<i4").tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
            shares = [(counts[a:b] / max(counts[a:b].sum(), 1)).astype("<f8").tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(row, n), batch.column(1).slice(row, n), pa.array(ids, pa.binary()), pa.array(shares, pa.binary())],
                ["rank", "lang", "places", "shares"])


def fit(sample: list[tuple[str, np.ndarray, np.ndarray]], idf: np.ndarray) -> Model:
    """FTRL-proximal on (language, buckets, shares), every fifth for the temperature."""
    languages = sorted({lang for lang, _, _ in sample})
    index = {lang: k for k, lang in enumerate(languages)}
    width = len(languages)
    # the last row is the bias
    z, n = np.zeros((BUCKETS + 1, width)), np.zeros((BUCKETS + 1, width))

    def solve(rows: np.ndarray) -> np.ndarray:
        zr, nr = z[rows], n[rows]
        return np.where(np.abs(zr) <= L1, 0.0, -(zr - np.sign(zr) * L1) / ((BETA + np.sqrt(nr)) / ALPHA + L2))

    rows = [(index[lang], np.append(places, BUCKETS), np.append(shares * idf[places] * SCALE, 1.0)) for lang, places, shares in sample]
    train = [r for i, r in enumerate(rows) if i % 5 or len(rows) < 10]
    aside = [r for i, r in enumerate(rows) if i % 5 == 0] or rows
    for epoch in range(EPOCHS):
        for at in np.random.default_rng(epoch).permutation(len(train)):
            k, places, values = train[at]
            weights = solve(places)
            error = softmax((values @ weights)[None, :])[0]
            error[k] -= 1
            grad = values[:, None] * error
            sigma = (np.sqrt(n[places] + grad * grad) - np.sqrt(n[places])) / ALPHA
            z[places] += grad - sigma * weights
            n[places] += grad * grad
    weights = solve(np.arange(BUCKETS + 1))
    logits = np.array([values @ weights[places] for _, places, values in aside])
    truth = np.array([k for k, _, _ in aside])

    def loss(temperature: float) -> float:
        return -np.log(softmax(logits / temperature)[np.arange(len(truth)), truth] + 1e-300).mean()

    temperature = min(np.geomspace(0.05, 20, 121), key=loss)
    return Model(languages, weights[:-1] * (idf * SCALE)[:, None], weights[-1], float(temperature))


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
          per_language: int = SAMPLE_PER_LANGUAGE) -> Model | None:
    """Fit on the labelled rows of ``docs``; None if there are none."""
    labelled = docs.select(F.col(key).alias("_key"), F.col(lang).alias("_lang"), F.col(text).alias("_text")) \
        .where("_lang is not null and _text is not null")
    # one row per bucket at most comes to the driver
    counts = labelled.select("_text").mapInArrow(_document_frequencies, "place long, n long") \
        .groupBy("place").agg(F.sum("n").alias("n")).toPandas()
    documents = int(counts.n[counts.place == -1].sum()) if len(counts) else 0
    if not documents:
        return None
    frequency = np.zeros(BUCKETS)
    some = counts[counts.place >= 0]
    frequency[some.place.to_numpy()] = some.n.to_numpy()
    idf = np.log((1 + documents) / (1 + frequency)) + 1
    # a rank is of a text under its key, so that rows of one key, or of none, are ranked each for itself; repeats are one.
    # ranks are spread evenly, so twice the wanted share of a language holds its least ranks: a frequent language
    # sends few rows to the window, from any number of tasks
    labelled = labelled.withColumn("_rank", F.shiftrightunsigned(F.xxhash64(F.col("_key").cast("string"), "_text"), 1))
    # the counts are written first, so that no row is dealt out by its language before that choice
    sizes = cut_lineage(labelled.groupBy("_lang").agg(F.approx_count_distinct("_rank").alias("_n")), "language-sizes")
    ranked = labelled.select("_lang", "_rank").join(sizes, "_lang").where(F.col("_rank") <= F.lit(2.0 * per_language * 2**63) / F.col("_n")) \
        .select("_lang", "_rank").distinct() \
        .withColumn("_at", F.row_number().over(Window.partitionBy("_lang").orderBy("_rank"))).where(F.col("_at") <= per_language)
    # written, so that Spark knows that it is small and the texts need no shuffle
    ranked = cut_lineage(ranked.select("_rank", "_lang"), "language-sample")
    chosen = labelled.join(ranked, ["_rank", "_lang"]) \
        .select("_rank", "_lang", "_text").mapInArrow(_features, "rank long, lang string, places binary, shares binary") \
        .dropDuplicates(["rank", "lang"])
    rows = sorted(chosen.toPandas().itertuples(index=False), key=lambda r: (r.rank, r.lang))
    return fit([(r.lang, np.frombuffer(r.places, "<i4"), np.frombuffer(r.shares, "<f8")) for r in rows], idf)


def predict(docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, ``lang_pred`` and ``score``."""
    rows = docs.select(key, text)
    schema = docs.select(key).schema.add("lang_pred", "string").add("score", "double")
    if model is None:
        return rows.select(key, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = sent.value
        for batch in batches:
            names, scores = [], []
            for _, data, cuts in ta.chunks(batch.column(1)):
                chances, known = held.scores(data, cuts)
                best = chances.argmax(axis=1)
                names += [held.languages[k] if good else UNKNOWN for k, good in zip(best.tolist(), known.tolist())]
                scores += np.where(known, chances.max(axis=1), 0.0).tolist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], schema.names)

    return rows.mapInArrow(run, schema)


def held_out(key: Column, fold: int, folds: int) -> Column:
    """Whether crc32 of the key as text falls into the fold."""
    return F.coalesce(F.crc32(key.cast("string")) % folds == fold, F.lit(False))
