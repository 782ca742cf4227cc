"""Alignment of two tokenizers against a plain reading of its definition."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from gridscope.llm import alignment, bpe
from gridscope.llm.byte_level import byte_alphabet

A, B = bpe.default_path("byte_bpe_50k.json"), bpe.default_path("piece_bpe_32k.model")
PARTS = ["'", "s", " ", "  ", "   ", "\n", "\t", "a", "é", "1", "!", "中", "\xa0", "\x00", "😀", "ing", "tion", "the", "<s>", "<unk>",
         "<|endoftext|>", "ﬁ", "　", "▁", "</s>", "<0x41>"]


def groups_of(texts):
    """Ids and groups of each text, None where it has no tokens."""
    import sentencepiece
    import tokenizers

    a, b = tokenizers.Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    alphabet = byte_alphabet()
    for text in texts:
        if not text:
            yield None
            continue
        left = a.encode(" " + text, add_special_tokens=False)
        right = b.encode(text)
        a_bytes = [bytes(alphabet[c] for c in token) for token in left.tokens]
        b_bytes = [bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
                   for i in right]
        if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
            yield None
            continue
        a_ends, b_ends = (np.cumsum([len(t) for t in side]).tolist() for side in (a_bytes, b_bytes))
        groups, i, j = [], 0, 0
        for end in sorted(set(a_ends) & set(b_ends)):
            p, q = a_ends.index(end, i) + 1, b_ends.index(end, j) + 1
            groups.append((left.ids[i:p], right[j:q]))
            i, j = p, q
        yield left.ids, right, groups


def expected(rows):
    found = list(groups_of([text for _, text in rows]))
    links = [Counter((u, v) for p, q in f[2] for u in p for v in q) if f else Counter() for f in found]
    count = Counter(pair for held in links for pair in held)
    highest = defaultdict(int)
    for (u, _), n in count.items():
        highest[u] = max(highest[u], n)
    for (key, _), f, held in zip(rows, found, links):
        if f is None:
            yield key, 0, 0, 0, 0, 0, 0, ""
            continue
        written = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in f[2])
        yield (key, len(f[0]), len(f[1]), len(f[2]), sum(held.values()),
               sum(n for pair, n in held.items() if count[pair] == highest[pair[0]]),
               sum(n * count[pair] for pair, n in held.items()), hashlib.sha256(written.encode()).hexdigest())


@pytest.fixture(scope="module")
def rows(spark, sf):
    draw = random.Random(5)
    drawn = [(10_000 + i, "".join(draw.choices(PARTS, k=draw.randint(0, 25)))) for i in range(1500)]
    hard = [(None, None), (None, ""), (1, " "), (1, "a a"), (1, "a a"), (None, "x" * 4000), (3, "中" * 1500 + "ab" * 1500), (4, "9" * 3000)]
    return hard + drawn + [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]


@pytest.mark.parametrize("frequent", [alignment.FREQUENT, 100, 1])
def test_measures_equal_brute_force(spark, rows, frequent):
    clashing = spark.createDataFrame([(k, t, "x", 1, 2) for k, t in rows], "doc_id long, text string, n_a string, row int, pair int")
    got = alignment.measure(clashing.repartition(5), A, B, frequent=frequent)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, expected(rows)))


def test_groups_and_split_pair_lists(spark, rows, monkeypatch):
    monkeypatch.setattr(alignment, "PAIRS", 7)
    monkeypatch.setattr(alignment, "LINKS", 50)
    monkeypatch.setattr(alignment, "WIDE_GROUP", 6)
    some = rows[:8] + rows[300:330] + rows[-5:]
    # the limits of this process hold in the tasks only if the work is done here
    a, b = alignment.byte_level(A), alignment.pieces(B)
    import pyarrow as pa
    from gridscope.llm import textarrays as ta

    (_, data, cuts), = ta.chunks(alignment._spaced(pa.array([t for _, t in some])))
    held = alignment.Aligned(a, b, data, cuts)
    pair, times, at = held.pairs(b.size)
    for n, found in enumerate(groups_of([t for _, t in some])):
        links = Counter((u, v) for p, q in found[2] for u in p for v in q) if found else {}
        got = {(int(k) // b.size, int(k) % b.size): int(v) for k, v in zip(pair[at[n]: at[n + 1]], times[at[n]: at[n + 1]])}
        assert got == links


def test_group_columns(spark, rows):
    some = [(i, t) for i, (_, t) in enumerate(rows[-20:])]
    frame = alignment.align(spark.createDataFrame(some, "doc_id long, text string"), A, B, groups=True)
    found = dict(enumerate(groups_of([t for _, t in some])))
    for r in frame.collect():
        ids_a, ids_b, groups = found[r.key]
        assert (r.a_ids, r.b_ids) == (ids_a, ids_b)
        cut = [(ids_a[i:p], ids_b[j:q]) for i, p, j, q in zip([0, *r.a_ends], r.a_ends, [0, *r.b_ends], r.b_ends)]
        assert cut == groups


def test_gallop_equals_search():
    draw = np.random.default_rng(1)
    ends = np.unique(draw.integers(0, 10_000, 2000))
    values = np.unique(draw.choice(np.arange(int(ends[-1]) + 1), 500))
    guess = draw.integers(0, len(ends), len(values))
    low, high = np.zeros(len(values), np.int64), np.full(len(values), len(ends))
    assert alignment.gallop(values, ends, guess, low, high).tolist() == np.searchsorted(ends, values).tolist()


def test_empty_table(spark):
    assert alignment.measure(spark.createDataFrame([], "doc_id long, text string"), A, B).collect() == []
