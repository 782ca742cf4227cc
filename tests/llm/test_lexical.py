"""Ranked search against a plain reading of its score."""

import math
import random
import re
from collections import Counter

import pytest

from gridscope.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def found(text):
    return TERM.findall((text or "").translate(ASCII))


def expected(docs, items, top):
    held = [(key, Counter(found(text)), len(found(text))) for key, text in docs]
    corpus, length = sum(n > 0 for *_, n in held), sum(n for *_, n in held)
    df = Counter(t for _, tf, _ in held for t in tf)
    for item, text in dict.fromkeys((i, t) for i, t in items if t is not None):
        asked, scores = Counter(found(text)), []
        for key, tf, n in held:
            m = 75 + 25 * n * corpus // max(length, 1)
            score = sum(k * math.floor(1000 * math.log((2 * corpus + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 12 * m))
                        for t, k in asked.items() if t in tf)
            if score > 0:
                scores.append((-score, key is None, key))
        scores.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        for rank, (score, _, key) in enumerate(scores[:top], 1):
            yield item, rank, key, -score


def drawn(seed, n):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["É", "é", "中文", "A1", "a1", "__", "\x80x"]
    rows = [(i, " ".join(draw.choices(words, weights=[1 / (k + 1) for k in range(len(words))], k=draw.randint(0, 40)))) for i in range(n)]
    long = " ".join(f"w{i}" for i in range(20_000))
    return rows + [(None, "w1 w2"), (None, "w1 w2"), (None, None), (1, "w1 w2"), (1, "w1 w2"), (n, ""), (n + 1, long), (n + 2, "w3 " * 5000)]


ITEMS = [(1, "w1 w2 w2 W3"), (2, "w50 é 中文"), (2, "w50 é 中文"), (2, "A1 a1"), (None, "w4"), (3, None), (4, ""), (5, "..."), (6, "unknown"),
         (7, " ".join(f"w{i}" for i in range(300)))]


@pytest.mark.parametrize("top,block,cells", [(20, lexical.BLOCK_TERMS, lexical.CELLS), (3, 20, 2000)])
def test_search_equals_brute_force(spark, top, block, cells, monkeypatch):
    monkeypatch.setattr(lexical, "CELLS", cells)
    docs, items = drawn(4, 600), ITEMS
    frame = spark.createDataFrame([(k, t, "c", 1) for k, t in docs], "doc_id long, text string, item string, rank int").repartition(3)
    asked = spark.createDataFrame([(i, t, "c") for i, t in items], "item_id long, text string, doc_id string")
    got = lexical.search(frame, asked, top=top, block_terms=block)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, expected(docs, items, top)))


def test_bounds_are_never_less_than_scores():
    import numpy as np
    import pyarrow as pa
    from gridscope.llm import textarrays as ta

    items = lexical.Items([t or "" for _, t in ITEMS])
    items.weigh(600, 20_000, {int(h): 3 for h in items.vocabulary.tolist()})
    seen = []

    class Watch(lexical.Best):
        def add(self, item, score, keys):
            seen.extend(zip(item.tolist(), score.tolist(), keys.to_pylist()))
            super().add(item, score, keys)

    docs = [t for _, t in drawn(9, 200) if t]
    whole, bounded = Watch(len(ITEMS), 10**6), Watch(len(ITEMS), 2)
    for best in (whole, bounded):
        for row, data, cuts in ta.chunks(pa.array(docs)):
            lexical._rank(items, best, pa.array(range(row, row + len(cuts) - 1)), *lexical.terms(data, cuts))
    # with few wanted, many documents are never scored, yet the best are the same
    assert len(bounded.item) < len(whole.item) and np.all(bounded.least <= whole.score.max())
    for n in range(len(ITEMS)):
        both = [sorted((-s, k) for s, k in zip(b.score[b.item == n].tolist(), b.keys.take(pa.array(np.flatnonzero(b.item == n))).to_pylist()))
                for b in (whole, bounded)]
        assert both[0][:2] == both[1]


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert [tuple(r)[:3] for r in lexical.search(docs, items).collect()] == [(1, 1, 1)]
    assert lexical.search(docs.limit(0), items).collect() == []
    assert lexical.search(docs, items.limit(0)).collect() == []
