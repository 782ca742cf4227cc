"""Operator 13: ranked lexical search with hashed max-sketches.

Terms are longest runs of letters a-z, digits and characters from U+0080 on; A-Z count as lower case. N, L and the document
frequencies of the items' terms are counted over the whole corpus first. Then every task folds each of its documents into a
sketch: the impact of each term (its weight apart) goes to the coordinate of the term's hash, which keeps the maximum. A
coordinate is no less than the impact of any term that falls on it, so the weighted sum of an item's coordinates is an upper
bound of its score, for all items and a batch of documents at once. Documents are scored exactly in descending order of their
bounds until the bound is under the least of the best ``top`` scores that the task has found for the item. Each task hands on at most
``top`` documents an item; the best of them are chosen by a window.

The sketch of a document has at least twice as many coordinates as the document has different terms, so the
bounds of long documents stay close. All arithmetic is in whole numbers of 64 bits but for the weights. Terms are told apart by a
64-bit hash.

Items are taken in blocks of at most ``BLOCK_TERMS`` terms (one item at least), so that what goes to the tasks is bounded; each
block meets all documents.

Defined results: a null text has no terms, as document or item, and is in no result; items are rows: equal rows of item id and text
are one item, other rows of one item id are ranked each for itself; equal scores are ordered by ascending key, rows without a key last,
and every repeated row has a rank of its own; an empty table of items or documents gives an empty result. Extra columns
are left out. Texts are whole, however long.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridscope.llm import textarrays as ta
from gridscope.sources.tables import cut_lineage

TOP = 20
#: Terms of items, repeats included, that go to the tasks at once.
BLOCK_TERMS = 1 << 16
#: Coordinates of the smallest sketch, and cells of sketches and bounds that are held at once.
LEAST_WIDTH = 256
CELLS = 1 << 22
#: Documents of an item that are scored exactly in the first round; later rounds double it.
FIRST_ROUND = 32

#: Fixed values of the score.
SCALE, TF, NORM, LENGTH_SHARE = 1_000_000_000, 1000, 12, 25

_TERM = np.zeros(256, dtype=bool)
_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def terms(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all terms of a run of texts, and the ``n + 1`` places of each text's first term."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(cuts), np.int64)
    inside = np.concatenate([[False], _TERM[data], [False]])
    first = np.zeros(len(data) + 1, dtype=bool)
    first[cuts] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | first[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | first[1:])) + 1
    return ta.hash_spans(ta.lowered(data), starts, ends), np.searchsorted(starts, cuts)


def frequencies(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different terms of each text in order: its text, hash and number of occurrences."""
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    new = np.ones(len(owner), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    at = np.flatnonzero(new)
    return owner[at], hashes[at], np.diff(np.append(at, len(owner)))


def impacts(tf: np.ndarray, norm: np.ndarray) -> np.ndarray:
    return SCALE * tf // (TF * tf + NORM * norm)


class Items:
    """A block of items: for each its different terms, how often each is repeated, and after ``weigh`` their weights."""

    def __init__(self, texts: list[str]) -> None:
        hashes, first = [np.zeros(0, np.uint64)], [0]
        for text in texts:
            data = np.frombuffer(text.encode("utf-8"), dtype=np.uint8)
            hashes.append(terms(data, np.array([0, len(data)]))[0])
            first.append(first[-1] + len(hashes[-1]))
        item, term, self.repeats = frequencies(np.concatenate(hashes), np.array(first))
        self.vocabulary, self.place = np.unique(term, return_inverse=True)
        self.cuts = np.searchsorted(item, np.arange(len(texts) + 1))
        self.worth = np.zeros(len(item), dtype=np.int64)
        self.corpus, self.length = 0, 0

    def weigh(self, corpus: int, length: int, found: dict[int, int]) -> None:
        weights = [math.floor(1000 * math.log((2 * corpus + 2) / (2 * found.get(h, 0) + 1))) for h in self.vocabulary.tolist()]
        self.worth = self.repeats * np.array(weights, dtype=np.int64)[self.place]
        self.corpus, self.length = corpus, length

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        """Place in the vocabulary, -1 for other terms."""
        if not len(self.vocabulary):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at, -1)

    def summed(self, by_term: np.ndarray) -> np.ndarray:
        """Worth of each item for rows of values by the items' terms, one column per term."""
        padded = np.concatenate([by_term * self.worth, np.zeros((len(by_term), 1), np.int64)], axis=1)
        held = np.add.reduceat(padded, self.cuts[:-1], axis=1)
        held[:, np.diff(self.cuts) == 0] = 0
        return held


def _statistics(batches: Iterator[pa.RecordBatch], items: Items) -> Iterator[pa.RecordBatch]:
    """Documents per term of the items; under a null place the documents with terms, and all their terms."""
    found, documents, length = np.zeros(len(items.vocabulary), np.int64), 0, 0
    for batch in batches:
        for _, data, cuts in ta.chunks(batch.column(0)):
            hashes, first = terms(data, cuts)
            place = items.lookup(hashes)
            owner = np.repeat(np.arange(len(cuts) - 1), np.diff(first))
            held = np.unique(owner[place >= 0] * len(items.vocabulary) + place[place >= 0])
            if len(held):
                found += np.bincount(held % len(items.vocabulary), minlength=len(items.vocabulary))
            documents, length = documents + int((np.diff(first) > 0).sum()), length + len(hashes)
    place = np.flatnonzero(found)
    yield pa.RecordBatch.from_arrays(
        [pa.array([None, *place.tolist()], pa.int32()), pa.array([documents, *found[place].tolist()], pa.int64()),
         pa.array([length, *[0] * len(place)], pa.int64())], ["place", "n", "length"])


class Best:
    """The best documents of each item so far, by score and then key."""

    def __init__(self, items: int, top: int) -> None:
        self.top = top
        self.item = self.score = self.number = np.zeros(0, np.int64)
        self.keys: pa.Array | None = None
        self.least = np.zeros(items, np.int64)

    def add(self, item: np.ndarray, score: np.ndarray, keys: pa.Array) -> None:
        item, score = np.concatenate([self.item, item]), np.concatenate([self.score, score])
        keys = keys if self.keys is None else pa.concat_arrays([self.keys, keys])
        order = pc.rank(keys, "ascending", null_placement="at_end", tiebreaker="dense").to_numpy() if len(keys) else np.zeros(0, np.int64)
        by = np.lexsort((order, -score, item))
        held = item[by]
        rank = np.arange(len(held)) - np.searchsorted(held, held)
        kept = by[rank < self.top]
        last = by[rank == self.top - 1]
        self.least[item[last]] = score[last]
        self.item, self.score, self.keys = item[kept], score[kept], keys.take(pa.array(kept))


def _search(batches: Iterator[pa.RecordBatch], items: Items, top: int) -> Iterator[pa.RecordBatch]:
    best = Best(len(items.cuts) - 1, top)
    for batch in batches:
        for row, data, cuts in ta.chunks(batch.column(1)):
            _rank(items, best, batch.column(0).slice(row, len(cuts) - 1), *terms(data, cuts))
    if best.keys is not None:
        yield pa.RecordBatch.from_arrays([pa.array(best.item, pa.int32()), best.keys, pa.array(best.score, pa.int64())],
                                         ["number", "key", "score"])


def _rank(items: Items, best: Best, keys: pa.Array, hashes: np.ndarray, first: np.ndarray) -> None:
    n = np.diff(first)
    owner, term, tf = frequencies(hashes, first)
    norm = 100 - LENGTH_SHARE + LENGTH_SHARE * n * items.corpus // max(items.length, 1)
    impact = impacts(tf, norm[owner])
    begins = np.searchsorted(owner, np.arange(len(n) + 1))
    width = np.maximum(LEAST_WIDTH, 1 << np.ceil(np.log2(np.maximum(2 * np.diff(begins), 1))).astype(np.int64))
    width[n == 0] = 0
    place = items.lookup(term)
    known = np.flatnonzero(place >= 0)
    exact_key, exact = owner[known] * len(items.vocabulary) + place[known], impact[known]
    by_key = np.argsort(exact_key)
    exact_key, exact = exact_key[by_key], exact[by_key]
    for size in np.unique(width[width > 0]).tolist():
        group = np.flatnonzero(width == size)
        step = max(1, CELLS // max(size, len(items.worth)))
        for at in range(0, len(group), step):
            texts = group[at: at + step]
            sketch = np.zeros((len(texts), size), dtype=np.int64)
            counts = begins[texts + 1] - begins[texts]
            cell = np.repeat(begins[texts], counts) + ta.ramp(counts)
            np.maximum.at(sketch, (np.repeat(np.arange(len(texts)), counts), _coordinate(term[cell], size)), impact[cell])
            bounds = items.summed(sketch[:, _coordinate(items.vocabulary, size)[items.place]])
            _rescore(items, best, keys, texts, bounds, exact_key, exact)


def _coordinate(hashes: np.ndarray, size: int) -> np.ndarray:
    return (hashes % np.uint64(size)).astype(np.int64)


def _rescore(items: Items, best: Best, keys: pa.Array, texts: np.ndarray, bounds: np.ndarray, exact_key: np.ndarray,
             exact: np.ndarray) -> None:
    """Exact scores in descending order of the bounds, until no bound reaches the least of an item's best."""
    order = np.argsort(-bounds, axis=0, kind="stable")
    ordered = np.take_along_axis(bounds, order, axis=0)
    at, size = 0, FIRST_ROUND
    while at < len(texts):
        held = ordered[at: at + size]
        rank, item = np.nonzero((held > 0) & (held >= best.least))
        if not len(item):
            break
        text = texts[order[at + rank, item]]
        score = _scores(items, text, item, exact_key, exact)
        good = np.flatnonzero((score > 0) & (score >= best.least[item]))
        if len(good):
            best.add(item[good], score[good], keys.take(pa.array(text[good])))
        at, size = at + size, size * 2


def _scores(items: Items, text: np.ndarray, item: np.ndarray, exact_key: np.ndarray, exact: np.ndarray) -> np.ndarray:
    if not len(exact_key):
        return np.zeros(len(text), np.int64)
    counts = np.diff(items.cuts)[item]
    spot = np.repeat(items.cuts[item], counts) + ta.ramp(counts)
    wanted = np.repeat(text, counts) * len(items.vocabulary) + items.place[spot]
    at = np.minimum(np.searchsorted(exact_key, wanted), len(exact_key) - 1)
    value = np.where(exact_key[at] == wanted, exact[at] * items.worth[spot], 0)
    total = np.append(0, np.cumsum(value))
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


def search(docs: DataFrame, queries: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
           item_text: str = "text", top: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """The ``top`` documents of each item: item id, ``rank`` (from 1), document key, ``score``."""
    spark = docs.sparkSession
    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).where("text is not null")
    named = queries.select(F.col(item).alias("item"), F.col(item_text).alias("text")).where("text is not null").distinct()
    # a term and what parts it from the next have two bytes at least
    sized = named.withColumn("size", F.ceil((F.octet_length("text") + 1) / 2))
    blocks = max(1, math.ceil((sized.agg(F.sum("size")).first()[0] or 0) / block_terms))
    dealt = cut_lineage(sized.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(blocks))), "items")
    found = []
    for block in range(blocks):
        rows = dealt.where(F.col("block") == block).select("item", "text").collect()
        if rows:
            found.append(_searched(texts, rows, dealt.schema["item"], top))
    if not found:
        return spark.createDataFrame([], _result(dealt.schema["item"].dataType, texts.schema["key"].dataType, item, key))
    result = found[0]
    for more in found[1:]:
        result = result.unionByName(more)
    return result.select(F.col("item").alias(item), "rank", F.col("key").alias(key), "score")


def _result(item_kind: T.DataType, key_kind: T.DataType, item: str, key: str) -> T.StructType:
    return T.StructType().add(item, item_kind).add("rank", "integer").add(key, key_kind).add("score", "long")


def _searched(texts: DataFrame, rows: list, item: T.StructField, top: int) -> DataFrame:
    spark = texts.sparkSession
    items = Items([r.text for r in rows])
    counted = texts.select("text").mapInArrow(lambda batches: _statistics(batches, items), "place int, n long, length long") \
        .groupBy("place").agg(F.sum("n").alias("n"), F.sum("length").alias("length")).collect()
    # as many rows as the block has different terms
    numbers = items.vocabulary.tolist()
    whole = next((r for r in counted if r.place is None), None)
    items.weigh(whole.n if whole else 0, whole.length if whole else 0, {numbers[r.place]: r.n for r in counted if r.place is not None})
    schema = T.StructType().add("number", "integer").add("key", texts.schema["key"].dataType).add("score", "long")
    held = texts.mapInArrow(lambda batches: _search(batches, items, top), schema)
    order = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("key"))
    best = held.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    names = spark.createDataFrame([(n, r.item) for n, r in enumerate(rows)], T.StructType().add("number", "integer").add(item))
    return best.join(F.broadcast(names), "number").select("item", "rank", "key", "score")
