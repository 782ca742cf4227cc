"""Texts of an Arrow batch as flat numpy arrays: words, pieces, hashes.

All functions work on the UTF-8 bytes of many texts at once. Nothing here knows Spark;
tasks call it on the batches that Spark hands them.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; a longer text is handled alone.
CHUNK_BYTES = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def seeds(n: int, salt: int = 0) -> np.ndarray:
    """``n`` fixed odd 64-bit multipliers."""
    steps = (np.arange(1, n + 1, dtype=np.uint64) + np.uint64(salt << 32)) * np.uint64(0x9E3779B97F4A7C15)
    return mix(steps) | np.uint64(1)


class _Multipliers:
    """Multipliers by place in a span, grown to the longest span so far."""

    def __init__(self) -> None:
        self.values = seeds(1024)

    def first(self, n: int) -> np.ndarray:
        if n > len(self.values):
            self.values = seeds(1 << int(n - 1).bit_length())
        return self.values


_MULTIPLIERS = _Multipliers()


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and the ``n + 1`` offsets of ``n`` texts; null counts as empty."""
    texts = texts.fill_null("").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    cuts = np.frombuffer(offsets, dtype=np.int64)[texts.offset: texts.offset + len(texts) + 1]
    held = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return held[cuts[0]: cuts[-1]], cuts - cuts[0]


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, bytes and offsets of runs of texts of about ``limit`` bytes."""
    if len(texts) == 0:
        return
    data, cuts = flat(texts)
    row = 0
    while row < len(texts):
        stop = int(np.searchsorted(cuts, cuts[row] + limit, side="right")) - 1
        stop = min(max(stop, row + 1), len(texts))
        yield row, data[cuts[row]: cuts[stop]], cuts[row: stop + 1] - cuts[row]
        row = stop


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, all other bytes as they are."""
    return _LOWER[data]


def words(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and the ``n + 1`` places of each text's first word.

    A word is a longest run of characters other than blank and the controls 9 to 13.
    """
    if len(data) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(cuts), np.int64)
    inside = ~_SPACE[data]
    first = np.zeros(len(data) + 1, dtype=bool)
    first[cuts] = True
    before, after = np.empty_like(inside), np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    after[-1], after[:-1] = False, inside[1:]
    starts = np.flatnonzero(inside & (~before | first[:-1]))
    ends = np.flatnonzero(inside & (~after | first[1:])) + 1
    return starts, ends, np.searchsorted(starts, cuts)


def ramp(lengths: np.ndarray) -> np.ndarray:
    """0, 1, ... within each of the spans of the given lengths."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) - np.repeat(before, lengths)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash per non-empty span of bytes."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    place = ramp(lengths)
    held = data[np.repeat(starts, lengths) + place].astype(np.uint64)
    held += np.uint64(1)
    held *= _MULTIPLIERS.first(int(lengths.max()))[place]
    sums = np.add.reduceat(held, np.cumsum(lengths) - lengths)
    return mix(sums + lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Class of each code point: 0 other, 1 letter, 2 number, 3 white space."""
    import regex

    points = "".join(map(chr, (p for p in range(sys.maxunicode + 1) if not 0xD800 <= p < 0xE000)))
    table = np.zeros(sys.maxunicode + 1, dtype=np.uint8)
    for kind, pattern in ((1, r"\p{L}"), (2, r"\p{N}"), (3, r"\p{White_Space}")):
        for run in regex.finditer(pattern + "+", points):
            low, high = ord(run[0][0]), ord(run[0][-1])
            table[low: high + 1] = kind
    table[0xD800:0xE000] = 0
    return table


#: What follows an apostrophe in the contractions of the split pattern. Fixed values.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


def pieces(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the pieces that a byte-level BPE merges, and each text's first piece.

    The pieces are the matches of ``public_tokenizers.PATTERN``, found from runs of letters,
    numbers, white space and other characters: a run takes one blank before it, white space
    before a run ends one character early, and a contraction begins where a piece begins.
    """
    if len(data) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(cuts), np.int64)
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    if len(lead) == len(data):
        points = data.astype(np.uint32)
    else:
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
    n = len(points)
    kind = _classes()[points]
    first = np.zeros(n + 1, dtype=bool)
    first[np.searchsorted(lead, cuts)] = True
    first[n] = True
    run = first[:n].copy()
    run[1:] |= kind[1:] != kind[:-1]
    white = kind == 3
    start = run.copy()
    # a run after a blank of the same text begins with that blank
    blank = (points == 0x20)
    after_blank = np.zeros(n, dtype=bool)
    after_blank[1:] = blank[:-1]
    after_blank &= ~first[:n]
    start &= white | ~after_blank
    # the last character of white space that a run follows is a piece or part of one
    run_next = np.append(run[1:], True)
    start |= white & run_next & ~first[1:]
    tick = points == 0x27
    if tick.any():
        _split_contractions(points, kind, first, start, np.flatnonzero(tick & start))
    begins = np.flatnonzero(start)
    starts = lead[begins]
    ends = np.append(starts[1:], len(data))
    return starts, ends, np.searchsorted(starts, cuts)


def _split_contractions(points, kind, first, start, places) -> None:
    """Cut contractions at the apostrophes where pieces begin, from left to right in each run."""
    n, done = len(points), -1
    for at in places.tolist():
        while at > done and at < n and points[at] == 0x27:
            follow = "".join(map(chr, points[at + 1: at + 3].tolist()))
            took = 0
            for end in CONTRACTIONS:
                if follow.startswith(end) and not first[at + 1: at + 1 + len(end)].any():
                    took = 1 + len(end)
                    break
            if not took:
                break
            done = at
            start[at: at + took] = False
            start[at] = True
            at += took
            if at >= n or first[at]:
                break
            # the rest of the letters is a piece of its own
            start[at] = start[at] or kind[at] != 3
            if points[at] != 0x27:
                break
