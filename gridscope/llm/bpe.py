"""Operator 5: byte-level BPE encoding and decoding with a segment tree over byte positions.

Each piece of the split pattern is merged separately. The leaves of a piece's segment tree are
its byte positions; leaf ``i`` holds the rank of the pair that begins there, with the position as
low bits, so that the root is the leftmost pair of least rank. A merge changes three leaves (the
pair itself, the live neighbour before it, and the swallowed position), each by one walk to the
root. Trees of many pieces are kept in one array and merged side by side; a piece that occurs again
is taken from a bounded cache.

Defined results: a null or empty text has no ids and decodes to no bytes; repeated rows are encoded
each for itself; a null key is kept as it is; any byte sequence has an encoding, as all 256 single bytes have
ids. Texts are whole, however long: memory grows with the longest single text only.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from bisect import bisect_left
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from gridscope.llm import textarrays as ta

#: Pieces that a Python worker keeps with their ids; beyond it the cache starts anew.
CACHED_PIECES = 400_000
#: Bytes of text whose pieces are looked up together.
LOOKUP_BYTES = 1 << 20
#: Tree cells that are merged side by side.
TREE_CELLS = 1 << 21

_NONE = np.iinfo(np.int64).max
#: With no more trees than this alive, each is merged by itself.
FEW_TREES = 32


def default_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Merges:
    """The rank file: tokens, their bytes, and the rank of each pair that merges."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}
        size = max(self.ranks.values()) + 1
        self.tokens: list[bytes] = [b""] * size
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        self.lengths = np.array([len(t) for t in self.tokens], dtype=np.int64)
        self.places = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(self.tokens), dtype=np.uint8)
        pairs, ranks = array("q"), array("q")
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs.append(left * size + right)
                    ranks.append(rank)
        self.size = size
        order = np.argsort(np.frombuffer(pairs, dtype=np.int64))
        self.pairs = np.frombuffer(pairs, dtype=np.int64)[order]
        self.pair_ranks = np.frombuffer(ranks, dtype=np.int64)[order]

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where it doesn't merge."""
        pair = left * self.size + right
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return np.where(self.pairs[at] == pair, self.pair_ranks[at], -1)

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the ids, one after the other."""
        lengths = self.lengths[ids]
        return self.bytes[np.repeat(self.places[ids], lengths) + ta.ramp(lengths)]


@lru_cache(maxsize=4)
def merges(path: str) -> Merges:
    return Merges(path)


def _merge_trees(table: Merges, ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge pieces of one tree size: ``ids`` is rows x leaves, padded; returns ids and what lives."""
    rows, leaves = ids.shape
    shift = leaves.bit_length()
    place = np.arange(leaves, dtype=np.int64)
    live = place < lengths[:, None]
    after = np.broadcast_to(place + 1, ids.shape).copy()
    before = np.broadcast_to(place - 1, ids.shape).copy()
    tree = np.full((rows, 2 * leaves), _NONE, dtype=np.int64)
    joined = np.where(place[:-1] + 1 < lengths[:, None], table.rank_of(ids[:, :-1], ids[:, 1:]), -1)
    tree[:, leaves: 2 * leaves - 1] = np.where(joined >= 0, joined << shift | place[:-1], _NONE)
    width = leaves
    while width > 1:
        width //= 2
        tree[:, width: 2 * width] = np.minimum(tree[:, 2 * width: 4 * width: 2], tree[:, 2 * width + 1: 4 * width: 2])
    cells, flat_ids, flat_live = tree.reshape(-1), ids.reshape(-1), live.reshape(-1)
    flat_after, flat_before = after.reshape(-1), before.reshape(-1)

    def put(base: np.ndarray, leaf: np.ndarray, value: np.ndarray) -> None:
        at = leaf + leaves
        cells[base + at] = value
        at = at >> 1
        while at[0] >= 1:
            twins = base + 2 * at
            cells[base + at] = np.minimum(cells[twins], cells[twins + 1])
            at = at >> 1

    def pair_at(row: np.ndarray, left: np.ndarray) -> np.ndarray:
        right = flat_after[row * leaves + left]
        there = right < lengths[row]
        rank = table.rank_of(flat_ids[row * leaves + left], flat_ids[row * leaves + np.where(there, right, 0)])
        return np.where(there & (rank >= 0), rank << shift | left, _NONE)

    row = np.flatnonzero(tree[:, 1] != _NONE)
    while len(row) > FEW_TREES:
        best = cells[row * 2 * leaves + 1]
        left = best & ((1 << shift) - 1)
        own = row * leaves
        right = flat_after[own + left]
        flat_ids[own + left] = best >> shift
        flat_live[own + right] = False
        further = flat_after[own + right]
        flat_after[own + left] = further
        inner = further < lengths[row]
        flat_before[(own + further)[inner]] = left[inner]
        put(row * 2 * leaves, right, np.full(len(row), _NONE))
        put(row * 2 * leaves, left, pair_at(row, left))
        earlier = flat_before[own + left]
        some = earlier >= 0
        if some.any():
            put(row[some] * 2 * leaves, earlier[some], pair_at(row[some], earlier[some]))
        row = row[cells[row * 2 * leaves + 1] != _NONE]
    for r in row.tolist():
        ids[r], live[r] = _merge_tree(table, tree[r].tolist(), ids[r].tolist(), live[r].tolist(), after[r].tolist(), before[r].tolist(),
                                      int(lengths[r]), shift)
    return ids, live


def _merge_tree(table: Merges, cells: list[int], ids: list[int], live: list[bool], after: list[int], before: list[int],
                length: int, shift: int) -> tuple[list[int], list[bool]]:
    """The same merges in one tree by itself, where too few are left for steps side by side to pay."""
    leaves, none, size = len(ids), int(_NONE), table.size
    # views, so that no second table of Python numbers is held
    pairs, ranks = memoryview(table.pairs), memoryview(table.pair_ranks)

    def put(leaf: int, value: int) -> None:
        at = leaf + leaves
        cells[at] = value
        while at > 1:
            at >>= 1
            left, right = cells[2 * at], cells[2 * at + 1]
            least = left if left < right else right
            if cells[at] == least:
                return
            cells[at] = least

    def pair_at(left: int) -> int:
        right = after[left]
        if right >= length:
            return none
        pair = ids[left] * size + ids[right]
        at = bisect_left(pairs, pair)
        return ranks[at] << shift | left if at < len(pairs) and pairs[at] == pair else none

    while cells[1] != none:
        left = cells[1] & ((1 << shift) - 1)
        right = after[left]
        ids[left] = cells[1] >> shift
        live[right] = False
        after[left] = after[right]
        if after[left] < length:
            before[after[left]] = left
        put(right, none)
        put(left, pair_at(left))
        if before[left] >= 0:
            put(before[left], pair_at(before[left]))
    return ids, live


def merge_pieces(table: Merges, data: np.ndarray, starts: np.ndarray, ends: np.ndarray
                 ) -> tuple[np.ndarray, np.ndarray]:
    """Ids of pieces (spans of ``data``), one after the other, and how many each piece has."""
    lengths = ends - starts
    counts = np.zeros(len(starts), dtype=np.int64)
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    whole = np.array([table.ranks.get(data[a:b].tobytes(), -1) for a, b in zip(starts.tolist(), ends.tolist())],
                     dtype=np.int64)
    done = np.flatnonzero(whole >= 0)
    counts[done] = 1
    parts.append((done, whole[done]))
    left = np.flatnonzero(whole < 0)
    sizes = np.left_shift(1, np.ceil(np.log2(np.maximum(lengths[left], 2))).astype(np.int64))
    for size in np.unique(sizes):
        group = left[sizes == size]
        step = max(1, TREE_CELLS // int(size))
        for at in range(0, len(group), step):
            some = group[at: at + step]
            place = np.arange(size, dtype=np.int64)
            inside = place < lengths[some, None]
            spots = np.where(inside, starts[some, None] + place, 0)
            ids, live = _merge_trees(table, table.single[data[spots]], lengths[some])
            counts[some] = live.sum(axis=1)
            parts.append((some, ids[live]))
    offsets = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), dtype=np.int64)
    for some, ids in parts:
        out[np.repeat(offsets[some], counts[some]) + ta.ramp(counts[some])] = ids
    return out, counts


class PieceCoder:
    """Ids of all pieces of a run of texts, each different piece encoded once while it is cached.

    ``encode`` takes bytes, starts and ends of different pieces and returns ids and counts.
    Pieces are told apart by a 64-bit hash.
    """

    def __init__(self, encode: Callable[[np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]],
                 limit: int = CACHED_PIECES) -> None:
        self.encode, self.limit = encode, limit
        self._reset()

    def _reset(self) -> None:
        self.hashes, self.entries = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(1 << 16, dtype=np.int32)
        self.counts = np.zeros(1 << 14, dtype=np.int64)
        self.places = np.zeros(1 << 14, dtype=np.int64)
        self.used = 0

    @staticmethod
    def _fit(held: np.ndarray, need: int) -> np.ndarray:
        return held if need <= len(held) else np.concatenate([held, np.zeros(max(need - len(held), len(held)), held.dtype)])

    def lookup(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the pieces, one after the other, and of each piece its place and count therein."""
        held, at, codes, _ = self.distinct(data, starts, ends)
        return held, self.places[at][codes], self.counts[at][codes]

    def distinct(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray
                 ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Held ids, the entry of each different piece, which of them each piece is, and their hashes."""
        codes, different = pd.factorize(ta.hash_spans(data, starts, ends))
        if len(self.hashes) + len(different) > self.limit and len(self.hashes):
            self._reset()
        place = np.searchsorted(self.hashes, different)
        at = np.full(len(different), -1, dtype=np.int64)
        if len(self.hashes):
            near = np.minimum(place, len(self.hashes) - 1)
            at = np.where(self.hashes[near] == different, self.entries[near], -1)
        new = np.flatnonzero(at < 0)
        if len(new):
            sample = np.zeros(len(different), dtype=np.int64)
            sample[codes] = np.arange(len(codes))
            ids, counts = self.encode(data, starts[sample[new]], ends[sample[new]])
            base, total = len(self.hashes), len(ids)
            self.ids = self._fit(self.ids, self.used + total)
            self.counts = self._fit(self.counts, base + len(new))
            self.places = self._fit(self.places, base + len(new))
            self.ids[self.used: self.used + total] = ids
            self.counts[base: base + len(new)] = counts
            self.places[base: base + len(new)] = self.used + np.cumsum(counts) - counts
            self.used += total
            at[new] = np.arange(base, base + len(new))
            order = new[np.argsort(different[new])]
            self.hashes = np.insert(self.hashes, place[order], different[order])
            self.entries = np.insert(self.entries, place[order], at[order])
        return self.ids, at, codes, different

    def texts(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """First row, ids of a run of texts, and the ``n + 1`` cuts between the texts."""
        for row, data, cuts in ta.chunks(column, LOOKUP_BYTES):
            starts, ends, first = ta.pieces(data, cuts)
            held, places, counts = self.lookup(data, starts, ends)
            flat = held[np.repeat(places, counts) + ta.ramp(counts)]
            before = np.append(0, np.cumsum(counts))
            yield row, flat, before[first]


@lru_cache(maxsize=2)
def _coder(path: str) -> PieceCoder:
    table = merges(path)
    return PieceCoder(lambda data, starts, ends: merge_pieces(table, data, starts, ends))


def encode_column(column: pa.Array, path: str) -> pa.Array:
    """A list of ids per text."""
    parts = []
    for _, ids, cuts in _coder(path).texts(column):
        parts.append(pa.LargeListArray.from_arrays(pa.array(cuts), pa.array(ids, type=pa.int32())))
    return pa.chunked_array(parts, type=pa.large_list(pa.int32())).combine_chunks()


def decode_column(ids: pa.Array, path: str) -> pa.Array:
    """The bytes of each list of ids; null counts as an empty list."""
    table, out = merges(path), []
    for row in range(0, len(ids), 256):
        part = ids.slice(row, 256)
        flat = part.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        counts = part.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        cuts = np.append(0, np.cumsum(np.add.reduceat(np.append(table.lengths[flat], 0), np.append(0, np.cumsum(counts))[:-1])
                                      * (counts > 0)))
        held = table.decode(flat).tobytes()
        out.extend(held[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()))
    return pa.array(out, type=pa.binary())


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its key and ``ids array<int>``."""
    schema = docs.select(key).schema.add("ids", T.ArrayType(T.IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = encode_column(batch.column(1), path).cast(pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], [key, "ids"])

    return docs.select(key, text).mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """One row per document: its key and the decoded ``bytes``."""
    schema = encoded.select(key).schema.add("bytes", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), decode_column(batch.column(1), path)], [key, "bytes"])

    return encoded.select(key, ids).mapInArrow(run, schema)


def round_trips(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", keep_ids: bool = False) -> DataFrame:
    """Encode and decode in one pass; per document the number of ids and digests of ids and bytes.

    ``ids_sha256`` is over the decimal ids joined by one space, ``decoded_sha256`` over the
    decoded bytes, both in lower-case hex. With ``keep_ids`` the ids are returned too.
    """
    schema = docs.select(key).schema.add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")
    if keep_ids:
        schema = schema.add("ids", T.ArrayType(T.IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [str(i).encode() for i in range(merges(path).size)]
        for batch in batches:
            ids = encode_column(batch.column(1), path)
            flat = ids.values.to_numpy(zero_copy_only=False)
            cuts = ids.offsets.to_numpy().tolist()
            written = [hashlib.sha256(b" ".join(map(names.__getitem__, flat[a:b].tolist()))).hexdigest()
                       for a, b in zip(cuts[:-1], cuts[1:])]
            read = [hashlib.sha256(held.as_buffer()).hexdigest() for held in decode_column(ids, path)]
            columns = [batch.column(0), pa.array(np.diff(cuts), type=pa.int64()), pa.array(written), pa.array(read)]
            columns += [ids.cast(pa.list_(pa.int32()))] if keep_ids else []
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return docs.select(key, text).mapInArrow(run, schema)
