"""Operator 11: alignment of the tokens that two tokenizers make of one text.

Both tokenizers read the text after one blank: A is a byte-level BPE (``tokenizers`` file), B a BPE of pieces with byte
fallback (``sentencepiece`` model, which puts the blank there itself). A token has the bytes it stands for, so each
tokenizer gives an ascending list of byte offsets at which its tokens end. The shorter list of a document is looked up in
the longer by galloping: from a first guess steps double until the end is bracketed, then the bracket is halved. Ends that
both lists have cut the text into groups; the differences of the ranks of neighbouring common ends are the ranges of A and
B tokens that overlap. All searches of a run of texts go on side by side.

All A-B pairs of occurrences in a group are links. The count of a pair of ids is the number of documents that hold it
linked, over the whole corpus. Pairs that make up at least one part in ``FREQUENT`` of all (document, pair) rows, at most
``FREQUENT`` of them by that rule, go to the tasks; all other pairs are joined, and none of those is frequent enough to make
a hot key. A document's pairs are told by ``row``, which a task numbers anew in the same way when it is run again.

Defined results: a text that is null, empty, or not given back byte by byte by both tokenizers has no tokens: zeros, no
groups and an empty digest. Rows count one by one, repeated rows and rows without a key too. Strings of special tokens are
plain text. An empty table gives an empty result. Extra columns are left out. Texts are whole, however long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridscope.llm import textarrays as ta
from gridscope.llm.bpe import PieceCoder
from gridscope.llm.byte_level import coder, flat, token_bytes
from gridscope.sources.tables import cut_lineage

#: At most so many pairs of ids are sent to all tasks.
FREQUENT = 1 << 18
#: Links that are laid out at once, and distinct pairs in one row.
LINKS = 1 << 21
PAIRS = 1 << 16
#: Ids that are spelt out at once.
SPELT = 1 << 18
#: A group of more links than this is reduced to its different ids before its pairs are laid out.
WIDE_GROUP = 1 << 12

_BLANK = 0x20
#: The sign that stands for a blank in pieces. Fixed value.
PIECE_BLANK = "▁"


class TokenBytes:
    """The bytes of each id."""

    def __init__(self, tokens: list[bytes]) -> None:
        self.lengths = np.array([len(t) for t in tokens], dtype=np.int64)
        self.places = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(tokens), dtype=np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        lengths = self.lengths[ids]
        return self.bytes[np.repeat(self.places[ids], lengths) + ta.ramp(lengths)]


class Tokenizer:
    """Ids of a run of texts (bytes that begin with a blank), with the bytes of each id."""

    def __init__(self, coder: PieceCoder, tokens: list[bytes], spans) -> None:
        self.coder, self.tokens, self.spans, self.size = coder, TokenBytes(tokens), spans, len(tokens)

    def encode(self, data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the ``n + 1`` cuts between the texts."""
        starts, ends, first = self.spans(data, cuts)
        held, places, counts = self.coder.lookup(data, starts, ends)
        ids = held[np.repeat(places, counts) + ta.ramp(counts)].astype(np.int64)
        return ids, np.append(0, np.cumsum(counts))[first]


def _spaced(texts: pa.Array) -> pa.Array:
    """Each text after one blank."""
    blank, nothing = pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string())
    return pc.binary_join_element_wise(blank, texts.fill_null("").cast(pa.large_string()), nothing)


@lru_cache(maxsize=2)
def byte_level(path: str) -> Tokenizer:
    """A ``tokenizers`` file of a byte-level BPE; its pieces are encoded each by itself."""
    return Tokenizer(coder(path), token_bytes(path), ta.pieces)


def _blank_runs(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans that begin where blanks follow something else; each text begins with a blank."""
    blank = data == _BLANK
    start = blank.copy()
    start[1:] &= ~blank[:-1]
    start[cuts[:-1]] = True
    starts = np.flatnonzero(start)
    return starts, np.append(starts[1:], len(data)), np.searchsorted(starts, cuts)


def _whole(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return cuts[:-1], cuts[1:], np.arange(len(cuts))


@lru_cache(maxsize=2)
def pieces(path: str) -> Tokenizer:
    """A ``sentencepiece`` model.

    Where no piece holds a blank after another character, no merge reaches over such a place, so the spans between them
    are encoded each by itself, and each different one once; else texts are encoded whole.
    """
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [library.id_to_piece(i) for i in range(library.get_piece_size())]
    tokens = [bytes([int(name[3:-1], 16)]) if library.is_byte(i) else name.replace(PIECE_BLANK, " ").encode("utf-8")
              for i, name in enumerate(names)]
    apart = not any(PIECE_BLANK in name.lstrip(PIECE_BLANK) for name in names)
    lone = library.piece_to_id(PIECE_BLANK)

    def encode(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # the library adds the blank that each span begins with, but to nothing it adds none
        held = data.tobytes()
        texts = [held[a + 1: b].decode("utf-8") for a, b in zip(starts.tolist(), ends.tolist())]
        return flat([ids if text else [lone] for text, ids in zip(texts, library.encode(texts, num_threads=1))])

    return Tokenizer(PieceCoder(encode), tokens, _blank_runs if apart else _whole)


def gallop(values: np.ndarray, ends: np.ndarray, guess: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """For each value the first place from ``low`` on whose end is not less, known to be below ``high``.

    Steps from the guess double until the value is bracketed, then the bracket is halved.
    """
    ahead = ends[guess] < values
    # ends[under] < value <= ends[over]
    under, over = np.where(ahead, guess, low - 1), np.where(ahead, high - 1, guess)
    way, going, step = np.where(ahead, 1, -1), np.arange(len(values)), 1
    while len(going):
        probe = guess[going] + way[going] * step
        inside = (probe > under[going]) & (probe < over[going])
        going, probe = going[inside], probe[inside]
        less = ends[probe] < values[going]
        under[going[less]], over[going[~less]] = probe[less], probe[~less]
        going, step = going[less == ahead[going]], step * 2
    going = np.flatnonzero(over - under > 1)
    while len(going):
        middle = (under[going] + over[going]) >> 1
        less = ends[middle] < values[going]
        under[going[less]], over[going[~less]] = middle[less], middle[~less]
        going = going[over[going] - under[going] > 1]
    return over


def common_ends(a_ends: np.ndarray, a_cuts: np.ndarray, b_ends: np.ndarray, b_cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in the A list and in the B list of the ends that both have, in order.

    The cuts say where the tokens of each text begin; texts lie one after the other and none is without tokens.
    """
    a_common, b_common = np.zeros(len(a_ends), dtype=bool), np.zeros(len(b_ends), dtype=bool)
    a_count, b_count = np.diff(a_cuts), np.diff(b_cuts)
    a_drives = a_count <= b_count
    for drives, mine, others in ((a_drives, (a_ends, a_cuts, a_count, a_common), (b_ends, b_cuts, b_count, b_common)),
                                 (~a_drives, (b_ends, b_cuts, b_count, b_common), (a_ends, a_cuts, a_count, a_common))):
        ends, cuts, count, common = mine
        texts = np.flatnonzero(drives)
        if not len(texts):
            continue
        number, rank = np.repeat(texts, count[texts]), ta.ramp(count[texts])
        at, low = cuts[number] + rank, others[1][number]
        guess = low + rank * others[2][number] // count[number]
        place = gallop(ends[at], others[0], guess, low, others[1][number + 1])
        hit = others[0][place] == ends[at]
        common[at[hit]], others[3][place[hit]] = True, True
    return np.flatnonzero(a_common), np.flatnonzero(b_common)


def _same_bytes(tokens: TokenBytes, ids: np.ndarray, token_cuts: np.ndarray, data: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Which texts the tokens give back byte by byte."""
    size, count = np.diff(cuts), np.diff(token_cuts)
    ends = np.append(0, np.cumsum(tokens.lengths[ids]))
    same = np.diff(ends[token_cuts]) == size
    given, wanted = tokens.joined(ids[np.repeat(same, count)]), data[np.repeat(same, size)]
    texts = np.flatnonzero(same)
    wrong = np.searchsorted(np.cumsum(size[texts]), np.flatnonzero(given != wanted), side="right")
    same[texts[wrong]] = False
    return same


def _distinct(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))[: len(keys)]
    return keys[first], np.add.reduceat(times[order], first) if len(first) else times[:0]


class Names:
    """Decimal ids, each followed by one of the signs ``,`` ``|`` ``;`` (code ``id * 3 + sign``)."""

    def __init__(self, size: int) -> None:
        names = [str(i).encode() + sign for i in range(size) for sign in (b",", b"|", b";")]
        self.lengths = np.array([len(name) for name in names], dtype=np.uint8)
        self.cells = np.array(names, dtype=f"S{max(map(len, names))}").view(np.uint8).reshape(len(names), -1)

    def spelt(self, codes: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The names one after the other, and the ``n + 1`` cuts between them."""
        lengths = self.lengths[codes]
        cells = self.cells[codes]
        held = cells[np.arange(cells.shape[1], dtype=np.uint8) < lengths[:, None]]
        return held.tobytes(), np.append(0, np.cumsum(lengths, dtype=np.int64))


class Aligned:
    """Groups of a run of texts: ids of both sides, the ends of the groups on each side, and the text of each group."""

    def __init__(self, a: Tokenizer, b: Tokenizer, data: np.ndarray, cuts: np.ndarray) -> None:
        a_ids, a_cuts = a.encode(data, cuts)
        b_ids, b_cuts = b.encode(data, cuts)
        good = (np.diff(cuts) > 1) & _same_bytes(a.tokens, a_ids, a_cuts, data, cuts) & _same_bytes(b.tokens, b_ids, b_cuts, data, cuts)
        self.n_a, self.n_b = np.where(good, np.diff(a_cuts), 0), np.where(good, np.diff(b_cuts), 0)
        self.a, self.b = a_ids[np.repeat(good, np.diff(a_cuts))], b_ids[np.repeat(good, np.diff(b_cuts))]
        self.a_cuts, self.b_cuts = np.append(0, np.cumsum(self.n_a)), np.append(0, np.cumsum(self.n_b))
        kept = np.flatnonzero(good)
        self.a_last, self.b_last = common_ends(
            np.cumsum(a.tokens.lengths[self.a]), np.append(self.a_cuts[kept], len(self.a)),
            np.cumsum(b.tokens.lengths[self.b]), np.append(self.b_cuts[kept], len(self.b)))
        self.wide = np.diff(self.a_last, prepend=-1), np.diff(self.b_last, prepend=-1)
        self.cuts = np.searchsorted(self.a_last, self.a_cuts)
        self.text = np.repeat(np.arange(len(good)), np.diff(self.cuts))
        links = np.append(0, np.cumsum(self.wide[0] * self.wide[1]))
        self.n_groups, self.n_links = np.diff(self.cuts), np.diff(links[self.cuts])

    def pairs(self, b_size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Different linked pairs of ids (``a * b_size + b``) in order of texts, how often each is linked, and cuts by text."""
        a_wide, b_wide = self.wide
        a_from, b_from = self.a_last + 1 - a_wide, self.b_last + 1 - b_wide
        links = a_wide * b_wide
        span = np.int64(1) << 31
        keys, times = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]

        def take(groups: np.ndarray, a_id: np.ndarray, b_id: np.ndarray, n: np.ndarray) -> None:
            found = _distinct(self.text[groups] * span + a_id * b_size + b_id, n)
            keys.append(found[0])
            times.append(found[1])

        small = np.flatnonzero(links <= WIDE_GROUP)
        filled = np.append(0, np.cumsum(links[small]))
        at = 0
        while at < len(small):
            stop = max(at + 1, int(np.searchsorted(filled, filled[at] + LINKS, side="right")) - 1)
            some = small[at:stop]
            group, inside = np.repeat(some, links[some]), ta.ramp(links[some])
            take(group, self.a[a_from[group] + inside // b_wide[group]], self.b[b_from[group] + inside % b_wide[group]],
                 np.ones(len(group), np.int64))
            at = stop
        for group in np.flatnonzero(links > WIDE_GROUP).tolist():
            a_id, a_n = np.unique(self.a[a_from[group]: self.a_last[group] + 1], return_counts=True)
            b_id, b_n = np.unique(self.b[b_from[group]: self.b_last[group] + 1], return_counts=True)
            step = max(1, LINKS // len(b_id))
            for low in range(0, len(a_id), step):
                ids, n = a_id[low: low + step], a_n[low: low + step]
                take(np.full(len(ids) * len(b_id), group), np.repeat(ids, len(b_id)), np.tile(b_id, len(ids)),
                     np.outer(n, b_n).ravel())
        found, often = _distinct(np.concatenate(keys), np.concatenate(times))
        return found % span, often, np.searchsorted(found, np.arange(len(self.n_a) + 1) * span)

    def written(self, names: Names) -> list[str]:
        """Each text's groups as ``a1,a2|b1;a3|b2,b3``, as its SHA-256; an empty text without groups."""
        a_wide, b_wide = self.wide
        order = np.zeros(len(self.a) + len(self.b), dtype=np.int64)
        a_at = np.arange(len(self.a)) + np.repeat(self.b_last + 1 - b_wide, a_wide)
        b_at = np.arange(len(self.b)) + np.repeat(self.a_last + 1, b_wide)
        order[a_at], order[b_at] = self.a * 3, self.b * 3
        order[a_at[self.a_last]] += 1
        order[b_at[self.b_last]] += 2
        both = (self.a_cuts + self.b_cuts).tolist()
        digests = [hashlib.sha256() for _ in both[1:]]
        text = 0
        for low in range(0, len(order), SPELT):
            held, cuts = names.spelt(order[low: low + SPELT])
            high = min(low + SPELT, len(order))
            while text < len(digests) and both[text] < high:
                start, end = max(both[text], low), min(both[text + 1], high)
                # the last sign of a text is left out
                digests[text].update(held[cuts[start - low]: cuts[end - low] - (end == both[text + 1] and end > start)])
                if both[text + 1] > high:
                    break
                text += 1
        return [digest.hexdigest() if end > start else "" for digest, start, end in zip(digests, both[:-1], both[1:])]


def _lists(flat: np.ndarray, cuts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(flat, pa.int32()))


def align(docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text", groups: bool = False) -> DataFrame:
    """One row per document: ``row``, the key, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``groups_sha256``, ``pairs``, ``times``.

    ``pairs`` are the different linked pairs as ``a * (number of B ids) + b`` and ``times`` how often each is linked; a document
    of very many pairs has further rows with its ``row`` and pairs alone. With ``groups`` the groups themselves are added:
    ``a_ids``, ``b_ids`` and the group's ends ``a_ends``, ``b_ends`` as counts of ids.
    """
    kind, numbers = docs.schema[key].dataType, T.ArrayType(T.IntegerType())
    schema = T.StructType().add("row", "long").add("key", kind)
    for name in ("n_a", "n_b", "n_groups", "n_links"):
        schema = schema.add(name, "long")
    schema = schema.add("groups_sha256", "string").add("pairs", numbers).add("times", numbers)
    for name in ("a_ids", "b_ids", "a_ends", "b_ends") if groups else ():
        schema = schema.add(name, numbers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = byte_level(a_path), pieces(b_path)
        if a.size * b.size > 1 << 31:
            raise ValueError("pairs of ids do not fit in 31 bits")
        names = Names(max(a.size, b.size))
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            keys = batch.column(0)
            for row, data, cuts in ta.chunks(_spaced(batch.column(1))):
                found, n = Aligned(a, b, data, cuts), len(cuts) - 1
                pair, often, at = found.pairs(b.size)
                tops = np.minimum(at[:-1] + PAIRS, at[1:])
                counts = [found.n_a, found.n_b, found.n_groups, found.n_links]
                digests = found.written(names)
                wanted = np.repeat(np.arange(n), np.ceil(np.diff(at) / PAIRS).astype(np.int64).clip(1))
                part = ta.ramp(np.bincount(wanted, minlength=n))
                lows = at[wanted] + part * PAIRS
                cut = np.append(lows, at[-1])
                first = pa.array(np.where(part == 0, wanted, -1), mask=part > 0)
                columns = [pa.array(number + wanted), keys.slice(row, n).take(first), *[pa.array(c).take(first) for c in counts],
                           pa.array(digests).take(first), _lists(pair, cut), _lists(often, cut)]
                if groups:
                    a_ends = found.a_last + 1 - found.a_cuts[found.text]
                    b_ends = found.b_last + 1 - found.b_cuts[found.text]
                    held = ((found.a, found.a_cuts), (found.b, found.b_cuts), (a_ends, found.cuts), (b_ends, found.cuts))
                    columns += [_lists(values, bounds).take(first) for values, bounds in held]
                number += n
                yield pa.RecordBatch.from_arrays([c.cast(f.type) if c.type != f.type else c for c, f in zip(columns, arrow)], schema.names)

    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = list(to_arrow_schema(schema))
    return docs.select(F.col(key), F.col(text)).mapInArrow(run, schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """Per linked pair of ids the number of documents that hold it (``pair``, ``n``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pair, n = np.unique(batch.column(0).flatten().to_numpy(zero_copy_only=False), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pair, pa.int32()), pa.array(n, pa.int64())], ["pair", "n"])

    return aligned.select("pairs").mapInArrow(run, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def link_sums(aligned: DataFrame, b_size: int, frequent: int = FREQUENT) -> DataFrame:
    """Per ``row`` the sum of its links' counts (``count_sum``) and the links whose count is their A id's highest (``n_best``)."""
    spark = aligned.sparkSession
    counts = cut_lineage(pair_counts(aligned), "pairs")
    # one row per A id, no more than the vocabulary has
    highest = counts.groupBy(F.floor(F.col("pair") / b_size).cast("int").alias("a")).agg(F.max("n").alias("most"))
    ranked = cut_lineage(counts.withColumn("a", F.floor(F.col("pair") / b_size).cast("int")).join(F.broadcast(highest), "a")
                         .select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "ranked")
    total = ranked.agg(F.sum("n")).first()[0] or 0
    often = ranked.where(F.col("n") * F.lit(frequent) >= F.lit(total)).toArrow().sort_by("pair")
    known = spark.sparkContext.broadcast([often.column(c).to_numpy() for c in ("pair", "n", "best")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = known.value
        for batch in batches:
            rows, lists = batch.column(0).to_numpy(), batch.column(1)
            flat, times = lists.flatten().to_numpy(), batch.column(2).flatten().to_numpy().astype(np.int64)
            owner = np.repeat(np.arange(len(rows)), lists.value_lengths().to_numpy())
            at = np.searchsorted(pair, flat)
            at[at == len(pair)] = 0
            hit = pair[at] == flat if len(pair) else np.zeros(len(flat), dtype=bool)
            sums = [_owned(owner[hit], times[hit] * weight[at[hit]], len(rows)) for weight in (n, best)]
            yield _sums(rows, *sums, np.zeros(len(rows), np.int32), np.zeros(len(rows), np.int64))
            rest = ~hit
            nothing = np.zeros(int(rest.sum()), np.int64)
            yield _sums(rows[owner[rest]], nothing, nothing, flat[rest], times[rest])

    # times is 0 in the rows of sums and at least 1 in those of pairs that are yet to be joined
    first = cut_lineage(aligned.select("row", "pairs", "times").mapInArrow(
        run, "row long, count_sum long, n_best long, pair int, times long"), "links")
    rare = ranked.where(F.col("n") * F.lit(frequent) < F.lit(total))
    joined = first.where("times > 0").join(rare, "pair").select(
        "row", (F.col("times") * F.col("n")).alias("count_sum"), F.when(F.col("best"), F.col("times")).otherwise(0).alias("n_best"))
    return first.where("times = 0").select("row", "count_sum", "n_best").unionByName(joined) \
        .groupBy("row").agg(F.sum("count_sum").alias("count_sum"), F.sum("n_best").alias("n_best"))


def _owned(owner: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of whole numbers by owner; owners ascend."""
    total = np.append(0, np.cumsum(values.astype(np.int64)))
    return np.diff(total[np.searchsorted(owner, np.arange(n + 1))])


def _sums(rows, count_sum, n_best, pair, times) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(count_sum), pa.array(n_best), pa.array(pair, pa.int32()),
                                       pa.array(times)], ["row", "count_sum", "n_best", "pair", "times"])


def measure(docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text", frequent: int = FREQUENT) -> DataFrame:
    """One row per document: its key, tokens of both sides, groups, links, ``n_best``, ``count_sum`` and ``groups_sha256``."""
    aligned = cut_lineage(align(docs, a_path, b_path, key, text), "aligned")
    sums = link_sums(aligned, pieces(b_path).size, frequent)
    return aligned.where("n_a is not null").join(sums, "row").select(
        F.col("key").alias(key), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
