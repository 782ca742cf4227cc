"""Operator 2: language-model scores, a causal attention model beside a word unigram base.

One pass encodes all texts and writes their ids; of the training texts it counts all words, all subword ids and all phrases (runs of
``PHRASE`` ids, from the first of a text on; the last of a text may be shorter). The attention's vocabulary and the shares of rarer ids come from
these counts; its weights begin with steps on the ``SAMPLED_WINDOWS`` windows of least hash of text and place and then learn from all
windows of all training texts: texts are dealt by their hash to ``ROUNDS`` rounds, in each the tasks sum the gradients of all windows of
its texts, and the weights move once by the sum. So every window counts once, however texts lie in partitions; where there are no more
than ``SAMPLED_WINDOWS`` windows the first steps have them all. The ids lie in a folder per round, so a round reads its own texts alone.
A last pass scores the ids of every text, from which its words follow too: windows overlap, each id is scored once.

The model is a mixture over phrases by absolute discounting. Of N training phrases, T of them different, a phrase seen c times has
the probability max(c - 1, 0) / N + T / N * attention(phrase, given what is before it); over all phrases this adds up to one.
So a text whose phrases the corpus repeats is far likelier than by the attention alone, and a phrase seen once tells nothing.

Counts of frequent words and phrases go to the tasks: those that make up at least 1 / ``FREQUENT`` of
all tokens or phrases, so there are at most ``FREQUENT`` of each. All others meet their counts in a join.

Defined results: a null or empty text is its end alone; words are lower-cased (A-Z) runs between white space; without training
texts the base score is 0 and the model is the attention as it starts; repeated rows and null keys are scored each for itself
(a null key counts as training text).
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridscope.llm import textarrays as ta
from gridscope.llm.attention import CONTEXT, STRIDE, Adam, Attention, places, windows
from gridscope.llm.bpe import PieceCoder
from gridscope.sources.tables import cut_lineage, scratch_path

#: Windows of the first steps; all others follow in the rounds.
SAMPLED_WINDOWS = 49_152
ROUNDS, ROUND_RATE = 24, 1e-2
#: Windows of stored texts that lie in memory at once, and the parts in which gradients are summed over tasks.
HELD_WINDOWS, PARTS = 4_096, 64
#: Ids of stored texts that are scored at once; a longer text is scored alone.
HELD_IDS = 1 << 18
#: A freed block of this size lets the allocator keep smaller ones, which would otherwise go back and be cleared anew for each array.
KEPT_BYTES = 31 << 20
#: Ids of a phrase: whole windows, so that a phrase's probability is the product of theirs.
PHRASE = 2 * STRIDE
FREQUENT = 1 << 20
#: Counted words that a task holds before it hands them on.
HELD_WORDS = 1 << 20
#: The end of a text as a word; no word hashes to it but by a chance of 2**-64.
END_WORD = 0

_WORDS, _IDS, _WINDOWS, _PHRASES, _TEXTS, _OTHERS = 0, 1, 2, 3, 4, 5
#: White space that is no blank.
_INNER = re.compile(r"[^\S ]")


@lru_cache(maxsize=2)
def _ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}


@lru_cache(maxsize=2)
def _openers(path: str) -> np.ndarray:
    """Which ids begin a word: those that begin with its blank, and the end."""
    ranks = _ranks(path)
    found = np.zeros(max(ranks.values()) + 2, dtype=bool)
    found[[rank for token, rank in ranks.items() if token.startswith(b" ")]] = True
    found[-1] = True
    return found


@lru_cache(maxsize=2)
def _coder(path: str) -> tuple[PieceCoder, int]:
    """Ids of a blank and a lower-case word; the first free id is the end."""
    import public_tokenizers
    import tiktoken

    ranks = _ranks(path)
    encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    lengths = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
    lengths[list(ranks.values())] = [len(token) for token in ranks]

    def encode(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # a blank before each word
        sizes = ends - starts + 1
        at = np.repeat(starts - 1, sizes) + ta.ramp(sizes)
        blanks = np.cumsum(sizes) - sizes
        joined = np.take(data, at, mode="clip")
        joined[blanks] = 0x20
        joined = joined.tobytes().decode("utf-8")
        # no piece goes past the end of a word without white space of its own: such words are encoded in one text
        alone = np.zeros(len(starts), dtype=bool)
        if _INNER.search(joined):
            words = [data[a:b].tobytes().decode("utf-8") for a, b in zip(starts.tolist(), ends.tolist())]
            alone = np.array([w.split() != [w] for w in words], dtype=bool)
            joined = "".join(" " + w for w, single in zip(words, alone.tolist()) if not single)
        ids = np.array(encoding.encode_ordinary(joined), dtype=np.int64)
        counts = np.zeros(len(starts), dtype=np.int64)
        word_ends = np.cumsum(sizes[~alone])
        counts[~alone] = np.diff(np.searchsorted(np.cumsum(lengths[ids]), word_ends, side="right"), prepend=0)
        if not alone.any():
            return ids, counts
        found = [encoding.encode_ordinary(" " + words[at]) for at in np.flatnonzero(alone).tolist()]
        counts[alone] = [len(f) for f in found]
        ids = np.append(ids, np.array([i for f in found for i in f], dtype=np.int64))
        order = np.argsort(alone, kind="stable")
        places = np.empty(len(starts), dtype=np.int64)
        places[order] = np.cumsum(counts[order]) - counts[order]
        return ids[np.repeat(places, counts) + ta.ramp(counts)], counts

    return PieceCoder(encode), max(ranks.values()) + 1


def _texts(column: pa.Array, path: str) -> Iterator[tuple]:
    """First row, different word hashes, which of them each word is, first word of each text, ids with ends, and their cuts."""
    coder, end = _coder(path)
    for row, data, cuts in ta.chunks(column):
        data = ta.lowered(data)
        starts, ends, first = ta.words(data, cuts)
        held, at, codes, different = coder.distinct(data, starts, ends)
        places, counts = coder.places[at][codes], coder.counts[at][codes]
        flat = held[np.repeat(places, counts) + ta.ramp(counts)].astype(np.int64)
        bounds = np.append(0, np.cumsum(counts))[first]
        ids = np.insert(flat, bounds[1:], end)
        yield row, different, codes, first, ids, bounds + np.arange(len(bounds))


def _words_of(ids: np.ndarray, cuts: np.ndarray, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of the texts, and the ``n + 1`` places of each text's first word.

    Words and their ids follow from each other, as blanks stand before words alone; the hash is of the ids.
    """
    starts = np.flatnonzero(_openers(path)[ids])
    sizes = np.diff(np.append(starts, len(ids)))
    spread = ta.ramp(sizes).astype(np.uint64)
    spread *= np.uint64(0x9E3779B97F4A7C15)
    spread += ids.astype(np.uint64)
    found = ta.mix(np.add.reduceat(ta.mix(spread), starts)) if len(starts) else np.zeros(0, np.uint64)
    # the last id of each text is the end
    first = np.searchsorted(starts, cuts)
    return np.delete(found, first[1:] - 1), first - np.arange(len(first))


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes, names = pd.factorize(np.concatenate([p[0] for p in parts]))
    return names, np.bincount(codes, weights=np.concatenate([p[1] for p in parts]), minlength=len(names)).astype(np.int64)


def _text_hash(names: np.ndarray, codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A hash of each text that follows from its words in their order."""
    size = np.diff(first)
    spread = names[codes] * (ta.ramp(size).astype(np.uint64) * np.uint64(2) + np.uint64(1))
    total = np.append(np.uint64(0), np.cumsum(spread, dtype=np.uint64))
    return total[first[1:]] - total[first[:-1]]


def phrases(ids: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text and hash of each phrase; the end of a text is one of its ids."""
    text, place = places(cuts)
    some = place % PHRASE == 0
    text, starts = text[some], (cuts[text] + place)[some]
    sizes = np.diff(np.append(starts, cuts[-1:]))[: len(starts)]
    spread = (ids.astype(np.uint64) + np.uint64(1)) * ta.seeds(PHRASE, salt=13)[ta.ramp(sizes)]
    return text, ta.mix(np.add.reduceat(spread, starts)) if len(starts) else np.zeros(0, np.uint64)


def _least(parts: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """The windows of least hash, in order."""
    order, held = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    some = np.argsort(order, kind="stable")[:SAMPLED_WINDOWS]
    return [(order[some], held[some])]


def _count(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """The ids of the task's texts; of its training texts the counts of words, ids and phrases, and the windows of least hash.

    The batches have text, key and whether it is a training text.
    """
    np.empty(KEPT_BYTES, np.uint8)
    end = _coder(path)[1]
    key_type = None
    id_counts = np.zeros(end + 1, dtype=np.int64)
    words: list[tuple[np.ndarray, np.ndarray]] = []
    drawn: list[tuple[np.ndarray, np.ndarray]] = []
    documents = 0

    def rows(kind: int, keys: np.ndarray, n: np.ndarray, held: pa.Array | None = None, own: pa.Array | None = None,
             rounds: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(keys), 100_000):
            part = slice(at, at + 100_000)
            size = len(keys[part])
            yield pa.RecordBatch.from_arrays([
                pa.array(keys[part].view(np.int64)), pa.array(n[part], pa.int64()),
                pa.nulls(size, pa.binary()) if held is None else held.slice(at, 100_000),
                pa.nulls(size, key_type) if own is None else own.slice(at, 100_000),
                pa.array(np.full(size, kind), pa.int32()),
                pa.array(np.zeros(size) if rounds is None else rounds[part], pa.int32())], ["key", "n", "held", "own", "kind", "round"])

    limit = np.uint64(np.iinfo(np.uint64).max)
    for batch in batches:
        key_type, learnt = batch.column(1).type, batch.column(2)
        others = batch.filter(pc.invert(learnt))
        for row, names, codes, first, ids, cuts in _texts(others.column(0), path):
            yield from rows(_OTHERS, ta.mix(_text_hash(names, codes, first)), np.diff(cuts), _packed(ids, cuts, end),
                            others.column(1).slice(row, len(cuts) - 1))
        batch = batch.filter(learnt)
        for row, names, codes, first, ids, cuts in _texts(batch.column(0), path):
            documents += len(cuts) - 1
            id_counts += np.bincount(ids, minlength=end + 1)
            sample = np.zeros(len(names), dtype=np.int64)
            sample[codes] = np.arange(len(codes))
            words.append((_words_of(ids, cuts, path)[0][sample], np.bincount(codes, minlength=len(names))))
            if sum(len(p[0]) for p in words) > HELD_WORDS:
                words = [_merged(words)]
                if len(words[0][0]) > HELD_WORDS // 2:
                    yield from rows(_WORDS, *words[0])
                    words = []
            yield from rows(_PHRASES, *np.unique(phrases(ids, cuts)[1], return_counts=True))
            hashes = _text_hash(names, codes, first)
            dealt = ta.mix(hashes)
            yield from rows(_TEXTS, dealt, np.diff(cuts), _packed(ids, cuts, end), batch.column(1).slice(row, len(cuts) - 1),
                            dealt.view(np.int64) % ROUNDS)
            text, place = places(cuts)
            order = ta.mix(hashes[text] + place.astype(np.uint64) * ta.seeds(1, salt=9)[0])
            chosen = np.flatnonzero(order <= limit)
            inputs, targets, _ = windows(ids, cuts, end, chosen)
            wanted = np.where(targets >= 0, ids[np.maximum(targets, 0)], -1)
            drawn.append((order[chosen], np.concatenate([inputs, wanted], axis=1).astype(np.int32)))
            if sum(len(d[0]) for d in drawn) > 2 * SAMPLED_WINDOWS:
                drawn = _least(drawn)
                limit = drawn[0][0][-1]
    if documents:
        yield from rows(_IDS, np.arange(end + 1), id_counts)
        words.append((np.array([END_WORD], dtype=np.uint64), np.array([documents])))
        yield from rows(_WORDS, *_merged(words))
        order, held = _least(drawn)[0]
        yield from rows(_WINDOWS, order, np.ones(len(order), np.int64), pa.array([h.tobytes() for h in held], pa.binary()))


def _stored(end: int) -> type:
    """The least type that holds all ids."""
    return np.uint16 if end <= np.iinfo(np.uint16).max else np.int32


def _packed(ids: np.ndarray, cuts: np.ndarray, end: int) -> pa.Array:
    """The ids of each text as bytes."""
    held = ids.astype(_stored(end))
    return pa.Array.from_buffers(pa.large_binary(), len(cuts) - 1, [
        None, pa.py_buffer((cuts * held.itemsize).astype(np.int64)), pa.py_buffer(held)]).cast(pa.binary())


def _unpacked(column: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of stored texts and their cuts."""
    held = column.cast(pa.large_binary())
    _, offsets, data = held.buffers()
    cuts = np.frombuffer(offsets, np.int64)[held.offset: held.offset + len(held) + 1] // np.dtype(_stored(end)).itemsize
    return np.frombuffer(data, _stored(end), count=int(cuts[-1]))[cuts[0]:], cuts - cuts[0]


def _stored_texts(column: pa.Array, end: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, ids and cuts of runs of stored texts of about ``HELD_IDS`` ids."""
    if not len(column):
        return
    held, ends = _unpacked(column, end)
    row = 0
    while row < len(column):
        stop = max(int(np.searchsorted(ends, ends[row] + HELD_IDS, side="right")) - 1, row + 1)
        yield row, held[ends[row]: ends[stop]].astype(np.int64), ends[row: stop + 1] - ends[row]
        row = stop


def _gradients(batches: Iterator[pa.RecordBatch], model: Attention, end: int) -> Iterator[pa.RecordBatch]:
    """The summed gradients of all windows of the task's texts, in parts."""
    np.empty(KEPT_BYTES, np.uint8)
    total = None
    for batch in batches:
        if not len(batch):
            continue
        ids, cuts = _unpacked(batch.column(0), end)
        slots, ends = model.slot_of[ids], np.cumsum(-(-np.diff(cuts) // STRIDE))
        row = 0
        while row < len(ends):
            stop = max(int(np.searchsorted(ends, (ends[row - 1] if row else 0) + HELD_WINDOWS, side="right")), row + 1)
            own, some = slots[cuts[row]: cuts[stop]], cuts[row: stop + 1] - cuts[row]
            n = len(places(some)[0])
            for at in range(0, n, HELD_WINDOWS):
                inputs, targets, _ = windows(own, some, model.start, np.arange(at, min(at + HELD_WINDOWS, n)))
                found = model.gradient_sum(inputs, np.where(targets >= 0, own[np.maximum(targets, 0)], -1))
                total = found if total is None else total + found
            row = stop
    if total is not None:
        yield pa.RecordBatch.from_arrays([
            pa.array(np.arange(PARTS), pa.int32()), pa.array([p.tobytes() for p in np.array_split(total, PARTS)], pa.binary())], ["part", "held"])


def _summed(parts: pa.Table) -> pa.Table:
    """One part of the gradients of all tasks."""
    total = np.frombuffer(parts.column("held")[0].as_py(), np.float64).copy()
    for held in parts.column("held")[1:]:
        total += np.frombuffer(held.as_py(), np.float64)
    return pa.table({"part": parts.column("part")[:1], "held": pa.array([total.tobytes()], pa.binary())})


def _learn(texts: DataFrame, model: Attention, end: int) -> None:
    """Move the weights by the gradients of all windows of the texts, each text in the round that its hash names."""
    spark, adam = texts.sparkSession, Adam(model)
    for number in range(ROUNDS):
        sent = spark.sparkContext.broadcast(model)
        parts = texts.where(F.col("round") == number).select("held").mapInArrow(
            lambda batches: _gradients(batches, sent.value, end), "part int, held binary")
        found = parts.groupBy("part").applyInArrow(_summed, "part int, held binary").collect()
        sent.unpersist()
        if found:
            total = np.concatenate([np.frombuffer(r.held, np.float64) for r in sorted(found, key=lambda r: r.part)])
            adam.move(model.by_name(total[:-1] / total[-1]), ROUND_RATE * (1 - number / (ROUNDS + 1)) ** 0.7)


def _fit(windows_seen: list[bytes], id_counts: np.ndarray, end: int) -> Attention:
    model = Attention(id_counts, end)
    held = np.frombuffer(b"".join(windows_seen), dtype=np.int32).reshape(-1, CONTEXT + STRIDE)
    slots = np.where(held >= 0, model.slot_of[np.maximum(held, 0)], -1)
    model.train(slots[:, :CONTEXT], slots[:, CONTEXT:])
    return model


def score(docs: DataFrame, training, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``, ``n_ids``.

    ``training`` is a condition on the documents. Scores are log10 probabilities.
    """
    spark = docs.sparkSession
    own = T.StructField("own", docs.schema[key].dataType)
    seen = docs.select(text, F.col(key).alias("_key"), F.coalesce(training, F.lit(False)).alias("_learnt")).mapInArrow(
        lambda batches: _count(batches, path),
        T.StructType([*T.StructType.fromDDL("key long, n long, held binary"), own, *T.StructType.fromDDL("kind int, round int")]))
    # a folder per kind, and of the texts per round: a round reads its own texts alone
    place = scratch_path(spark, "counted")
    seen.write.partitionBy("kind", "round").parquet(place)
    seen = spark.read.schema(seen.schema).parquet(place)
    counts = cut_lineage(seen.where(F.col("kind") == _WORDS).groupBy("key").agg(F.sum("n").alias("c")), "word-counts")
    tokens, vocabulary = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    counted = seen.where(F.col("kind") == _PHRASES)
    repeated = cut_lineage(counted.groupBy("key").agg(F.sum("n").alias("c")).where("c > 1"), "phrase-counts")
    n_phrases = counted.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # log10 of the attention's weight; phrases seen once all belong to it
    weight = np.log10(1 - repeated.agg(F.coalesce(F.sum(F.col("c") - 1), F.lit(0))).first()[0] / max(n_phrases, 1))
    common = _sorted_counts(counts.where(F.col("c") * FREQUENT >= tokens))
    known = _sorted_counts(repeated.where(F.col("c") * FREQUENT >= n_phrases))
    end = _coder(path)[1]
    id_counts = np.zeros(end + 1, dtype=np.int64)
    by_id = seen.where(F.col("kind") == _IDS).groupBy("key").agg(F.sum("n").alias("n")).toPandas()
    id_counts[by_id.key.to_numpy()] = by_id.n.to_numpy()
    # a cut by quantile first: about as many rows as are wanted come to the driver, from any number of tasks
    offered = seen.where(F.col("kind") == _WINDOWS).select("key", "held")
    n_offered = offered.count()
    if n_offered > SAMPLED_WINDOWS:
        cut = offered.agg(F.percentile_approx("key", SAMPLED_WINDOWS / n_offered)).first()[0]
        offered = offered.where(F.col("key") <= cut)
    drawn = offered.toPandas().sort_values(["key", "held"])[:SAMPLED_WINDOWS]
    model = _fit([bytes(h) for h in drawn.held], id_counts, end)
    texts = seen.where(F.col("kind") == _TEXTS)
    if (texts.agg(F.sum(F.ceil(F.col("n") / STRIDE))).first()[0] or 0) > SAMPLED_WINDOWS:
        _learn(texts, model, end)
    sent = spark.sparkContext.broadcast((common, known, n_phrases, weight, model))

    rows = seen.where(F.col("kind").isin(_TEXTS, _OTHERS)).select("own", "held").mapInArrow(
        lambda batches: _score(batches, path, *sent.value),
        T.StructType([T.StructField("row", T.LongType()), T.StructField("word", T.LongType()), T.StructField("times", T.LongType()),
                      T.StructField("_key", own.dataType), T.StructField("n_tokens", T.LongType()),
                      T.StructField("n_known", T.LongType()), T.StructField("logs", T.DoubleType()),
                      T.StructField("score", T.DoubleType()), T.StructField("n_ids", T.LongType()),
                      T.StructField("phrase", T.DoubleType())]))
    rare = counts.where(F.col("c") * FREQUENT < tokens).unionAll(repeated.where(F.col("c") * FREQUENT < n_phrases))
    met = rows.join(rare.select(F.col("key").alias("word"), "c"), "word", "left")
    found = F.col("c").isNotNull() & F.col("times").isNotNull()
    own = F.col("phrase") + F.lit(float(weight))
    from_counts = F.log10((F.col("c") - 1) / F.lit(float(max(n_phrases, 1))) + F.pow(F.lit(10.0), own))
    summed = met.groupBy("row").agg(
        F.max("_key").alias("_key"), F.max("n_tokens").alias("n_tokens"),
        (F.max("n_known") + F.sum(F.when(found, F.col("times")).otherwise(0))).alias("n_known"),
        (F.max("logs") + F.sum(F.when(found, F.col("times") * F.log10(F.col("c") + 1)).otherwise(0.0))).alias("logs"),
        (F.max("score") + F.coalesce(F.sum(F.when(F.col("c").isNotNull(), from_counts).otherwise(own)), F.lit(0.0))).alias("score"),
        F.max("n_ids").alias("n_ids"))
    return summed.select(F.col("_key").alias(key), "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"),
                         (F.col("logs") - F.col("n_tokens") * F.log10(F.lit(float(tokens + vocabulary + 1)))).alias("base_score"),
                         "score", "n_ids")


def _look_up(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys the table holds, and their values (0 where it doesn't)."""
    names, values = table
    if not len(names):
        return np.zeros(len(keys), bool), np.zeros(len(keys))
    at = np.minimum(np.searchsorted(names, keys), len(names) - 1)
    there = names[at] == keys
    return there, np.where(there, values[at], 0)


def _sorted_counts(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Keys in order and their counts; the caller knows a bound of their number."""
    held = counts.toPandas().sort_values("key")
    return held.key.to_numpy(), held.c.to_numpy()


def _score(batches: Iterator[pa.RecordBatch], path: str, common: tuple[np.ndarray, np.ndarray], repeated: tuple[np.ndarray, np.ndarray],
           n_phrases: int, weight: float, model: Attention) -> Iterator[pa.RecordBatch]:
    """A row per text, a row per text and word that is not common, and a row per phrase that is not known to repeat.

    Rows of texts have a word of their own that no count meets, so that they spread like the others.
    """
    names, counts = common
    logs = np.log10(counts + 1.0)
    end_at = int(np.searchsorted(names, END_WORD))
    end_known = end_at < len(names) and names[end_at] == END_WORD
    number = TaskContext.get().partitionId() << 40
    np.empty(KEPT_BYTES, np.uint8)
    for batch in batches:
        for row, ids, cuts in _stored_texts(batch.column(1), len(_openers(path)) - 1):
            n = len(cuts) - 1
            words, first = _words_of(ids, cuts, path)
            codes, different = pd.factorize(words.view(np.int64))
            text = np.repeat(np.arange(n), np.diff(first))
            known, gain = _look_up((names, logs), different)
            n_known = np.bincount(text, weights=known[codes], minlength=n).astype(np.int64)
            sums = np.bincount(text, weights=gain[codes], minlength=n).astype(np.float64)
            if end_known:
                n_known, sums = n_known + 1, sums + logs[end_at]
            owner = np.arange(number, number + n)
            number += n
            rare = ~known[codes]
            pairs, times = np.unique(text[rare] * len(different) + codes[rare], return_counts=True)
            r_text, r_word = pairs // max(len(different), 1), different[pairs % max(len(different), 1)]
            if not end_known:
                r_text, r_word = np.append(r_text, np.arange(n)), np.append(r_word, np.full(n, END_WORD))
                times = np.append(times, np.ones(n, np.int64))
            own_words = ta.mix(owner.astype(np.uint64)).view(np.int64)
            p_text, p_hash = phrases(ids, cuts)
            by_window = model.window_scores(ids, cuts) / np.log(10)
            p_first = np.flatnonzero(places(cuts)[1] % PHRASE == 0)
            p_own = np.add.reduceat(by_window, p_first) if len(p_first) else by_window
            there, c = _look_up(repeated, p_hash.view(np.int64))
            # 10 ** a below the least double counts as nothing beside a repeat
            p_known = np.log10((c[there] - 1) / max(n_phrases, 1) + 10.0 ** (p_own[there] + weight))
            scores = np.bincount(p_text[there], weights=p_known, minlength=n).astype(np.float64)
            p_text, p_hash, p_own = p_text[~there], p_hash[~there].view(np.int64), p_own[~there]
            r_text, r_word = np.append(r_text, p_text), np.append(r_word, p_hash)
            m, o = len(times), len(p_text)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.append(owner, owner[r_text.astype(np.int64)])), pa.array(np.append(own_words, r_word).astype(np.int64)),
                pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(times.astype(np.int64)), pa.nulls(o, pa.int64())]),
                pa.concat_arrays([batch.column(0).slice(row, n), pa.nulls(m + o, batch.column(0).type)]),
                *[pa.concat_arrays([pa.array(v), pa.nulls(m + o, pa.array(v).type)]) for v in (
                    np.diff(first) + 1, n_known, sums, scores, np.diff(cuts).astype(np.int64))],
                pa.concat_arrays([pa.nulls(n + m, pa.float64()), pa.array(p_own)]),
            ], ["row", "word", "times", "_key", "n_tokens", "n_known", "logs", "score", "n_ids", "phrase"])
