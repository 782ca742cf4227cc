"""Operators of the subpackage against brute force and on hard cases: nulls, empty, long and repeated texts."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gridscope.llm import (attention, bpe, components, decontam, jaccard_join, langid, line_dedup, lm, quality, secrets, textarrays,
                           token_store, url_filters)
from gridscope.sources.tables import scratch_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
RANKS = bpe.default_path("byte_bpe_50k.tiktoken")
DOCS = "text string, doc_id bigint, lang string, source string, n_chars bigint, n_words string, _t int, kept int, node int"
LONG = " ".join(f"w{i}" for i in range(30_000))
HARD = [None, "", "   \n\t ", "one", "a b c d e f", "a b c d e f", "é中😀 ß\x01\x02", LONG, LONG + " end", "x" * 5000]


@pytest.fixture(scope="module")
def hard(spark):
    rows = [(t, i, None, None, None, "clash", 1, 2, 3) for i, t in enumerate(HARD)] + [("a b c d e f", None, "en", "s", 1, "", 1, 1, 1)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def empty(hard):
    return hard.limit(0)


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}


def tiktoken_encoding():
    import public_tokenizers
    import tiktoken

    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.merges(RANKS).ranks, special_tokens={})


def test_pieces_and_merges_equal_the_library():
    draw = random.Random(3)
    parts = ["'", "s", "re", "ll", " ", "  ", "\n", "\t", "a", "é", "1", "²", "!", "中", "\xa0", "\x1c", "\x85", "😀", "'S", "́", "ing", "tion"]
    texts = ["".join(draw.choices(parts, k=draw.randint(0, 25))) for _ in range(3000)] + [None, "", "a" * 3000, "'s't're" * 50]
    column = pa.array(texts)
    encoding = tiktoken_encoding()
    ids = bpe.encode_column(column, RANKS)
    assert ids.to_pylist() == [encoding.encode_ordinary(t or "") for t in texts]
    assert bpe.decode_column(ids, RANKS).to_pylist() == [(t or "").encode() for t in texts]


def test_bounded_piece_cache():
    table = bpe.merges(RANKS)
    coder = bpe.PieceCoder(lambda *spans: bpe.merge_pieces(table, *spans), limit=50)
    texts = pa.array([f"word{i} again{i % 7}" for i in range(400)])
    encoding = tiktoken_encoding()
    got = [ids[a:b].tolist() for _, ids, cuts in coder.texts(texts) for a, b in zip(cuts[:-1], cuts[1:])]
    assert got == [encoding.encode_ordinary(t) for t in texts.to_pylist()]


def test_round_trips(hard, empty):
    encoding = tiktoken_encoding()
    rows = bpe.round_trips(hard, RANKS).collect()
    assert len(rows) == len(HARD) + 1 and bpe.round_trips(empty, RANKS).count() == 0
    for r in rows:
        text = (HARD[r.doc_id] if r.doc_id is not None else "a b c d e f") or ""
        ids = encoding.encode_ordinary(text)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    decoded = bpe.decode(bpe.encode(hard, RANKS), RANKS).where("doc_id = 6").first()
    assert bytes(decoded.bytes) == HARD[6].encode()


def test_segment_gives_single_ids():
    draw = np.random.default_rng(1)
    ids = draw.choice([0, 5, 255, 256, 50256, 70_000, 2**24 + 3], size=5000)
    held = token_store.Segment(token_store.pack(np.arange(2), np.array([1, 0]), np.array([4000, 1000]), ids))
    assert (held.ids() == ids).all() and [held.get(i) for i in range(0, 5000, 13)] == ids[::13].tolist()
    with pytest.raises(IndexError):
        held.get(5000)
    nothing = token_store.Segment(token_store.pack(np.zeros(0, int), np.zeros(0, int), np.zeros(0, int), np.zeros(0, int)))
    assert len(nothing.ids()) == 0


@pytest.mark.parametrize("segment_ids", [1 << 20, 500])
def test_token_files(spark, hard, docs, texts, segment_ids):
    from tokenizers import Tokenizer

    path = bpe.default_path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    folder = scratch_path(spark, "tokens")
    token_store.write(docs, folder, path, segment_ids=segment_ids)
    got = {r.doc_id: r for r in token_store.read_documents(spark, folder).collect()}
    start = 0
    for doc_id in sorted(texts):
        ids = tokenizer.encode(texts[doc_id] or "", add_special_tokens=False).ids + [0]
        assert (got[doc_id].start, got[doc_id].n_tokens) == (start, len(ids))
        assert got[doc_id].ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    folder = scratch_path(spark, "tokens")
    token_store.write(hard, folder, path, segment_ids=segment_ids)
    rows = sorted(token_store.read_documents(spark, folder).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, *range(len(HARD))] and rows[1].n_tokens == 1
    part, segment = spark.read.parquet(folder).select("part", "segment").orderBy("part", "segment").first()
    assert len(token_store.read_tokens(spark, folder, part, segment, [0, 1])) == 2


def test_token_files_with_a_hot_or_odd_key(spark):
    rows = [(None, f"text {i}") for i in range(300)] + [("no number", "x"), ("7", "y"), ("-3", None)]
    folder = scratch_path(spark, "tokens")
    token_store.write(spark.createDataFrame(rows, "doc_id string, text string").repartition(3), folder, bpe.default_path("byte_bpe_50k.json"))
    got = sorted(token_store.read_documents(spark, folder).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None] * 301 + [-3, 7] and got[-2].n_tokens == 1
    assert [r.start for r in got[1:]] == np.cumsum([r.n_tokens for r in got])[:-1].tolist()
    # the null keys lie in more than one range
    assert spark.read.parquet(folder).select("part").distinct().count() > 1


def brute_quality(text):
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for k in range(5)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered), failed)


def test_quality(spark, hard, empty):
    repeated = ["a b c d e a b c d e f", "x y z\nx y z\n\nx y z ok 1 2 3 4 5", "## | | a b", "of " * 40]
    rows = [(t, 100 + i, *[None] * 7) for i, t in enumerate(repeated)]
    everything = hard.unionByName(spark.createDataFrame(rows, DOCS))
    known = {i: t for i, t in enumerate(HARD)} | {100 + i: t for i, t in enumerate(repeated)} | {None: "a b c d e f"}
    judged = quality.judge(everything).collect()
    for r in judged:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute_quality(known[r.doc_id])
        assert not (r.base_failed and r.kept)
    assert quality.judge(empty).count() == 0 and quality.keep(empty).columns == empty.columns
    kept = quality.keep(everything)
    assert kept.columns == everything.columns and kept.count() == sum(r.kept for r in judged)


def test_quality_keeps_good_documents(spark, sf, docs):
    labels = spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1")
    judged = quality.judge(docs).join(labels, "doc_id").where("not base_failed")
    assert judged.where("kept").count() >= 0.98 * judged.count()


ASSIGN = re.compile(r"""((?:%s))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""" % "|".join(
    "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key")))


def test_secrets(spark, hard, empty):
    texts = [
        'my Password = "abc.def" and token:short then API_KEY=ABCDEFGH\x01tail', "AKIA" + "A" * 16 + " AKIAshort", "0123456789abcdef" * 2,
        "secret='" + "f" * 30, "password=token : abcdefgh", "key aB3dE5fG7hJ9kL1mN3pQ5xY7 here", "plain/words/and-more/words-here2",
        "😀 token=" + "z9" * 10, "zzzzzzzzzzzzzzzzzzzzzzzzz1", "t0ken EXAMPLEaB3dE5fG7hJ9kL1mN3",
    ]
    everything = hard.unionByName(spark.createDataFrame([(t, 100 + i, *[None] * 7) for i, t in enumerate(texts)], DOCS))
    rows = {r.doc_id: r for r in secrets.scan(everything).collect()}
    for i, text in enumerate(texts):
        spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
        spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        assert rows[100 + i].base_text == ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans)), text
    assert rows[105].spans_text == "entropy:4:28" and not rows[106].spans and not rows[108].spans and not rows[109].spans
    assert rows[0].spans == [] and rows[0].n_assign == 0 and secrets.scan(empty).count() == 0
    redacted = {r.doc_id: r.text for r in secrets.redact(everything).collect()}
    assert redacted[100] == 'my [secret]" and token:short then [secret]\x01tail' and redacted[103] == "[secret]"
    assert redacted[107] == "😀 [secret]" and redacted[None] == "a b c d e f" and redacted[0] is None
    assert secrets.redact(everything).columns == everything.columns


def test_entropy_of_windows(spark):
    def entropy(text):
        return -sum(n / len(text) * math.log2(n / len(text)) for n in Counter(text).values())

    runs = ["aB3dE5fG7hJ9kL1mN3pQ5", "a" * 25, "abc" * 9 + "123xyz", "0123456789" * 3]
    rows = spark.createDataFrame([(r,) for r in runs], "r string").select("r", secrets.highest_entropy(F.col("r")).alias("e")).collect()
    for r in rows:
        assert r.e == pytest.approx(max(entropy(r.r[i:i + 20]) for i in range(len(r.r) - 19)), abs=1e-9)


def brute_links(texts):
    sets = {}
    for key, text in texts.items():
        words = WORD.findall(text or "")
        sets[key] = {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    linked = defaultdict(set)
    keys = sorted(sets)
    for at, a in enumerate(keys):
        for b in keys[at + 1:]:
            if sets[a] and sets[b] and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]):
                linked[a].add(b)
                linked[b].add(a)
    classes = {}
    for key in keys:
        if key not in classes:
            stack = [key]
            while stack:
                now = stack.pop()
                if now not in classes:
                    classes[now] = key
                    stack += linked[now]
    return {key: (classes[key], len(linked[key])) for key in keys}


def test_jaccard_join(spark, hard, empty, docs, texts, monkeypatch):
    draw = random.Random(5)
    base = [f"t{draw.randrange(400)}" for _ in range(120)]
    copies = {}
    for i in range(90):  # a large group of near copies, in blocks and splits of small buckets
        words = list(base)
        for _ in range(draw.randrange(3)):
            words[draw.randrange(len(words))] = f"u{draw.randrange(10_000)}"
        copies[10_000 + i] = " ".join(words)
    frame = docs.select("doc_id", "text").unionByName(spark.createDataFrame(list(copies.items()), "doc_id bigint, text string"))
    want = brute_links(texts | copies)
    for block in (jaccard_join.BLOCK, 20):
        monkeypatch.setattr(jaccard_join, "BLOCK", block)
        rows = jaccard_join.links(frame).collect()
        assert len(rows) == len(want) and {r.doc_id: (r.class_id, r.n_links) for r in rows} == want
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard_join.links(hard).collect()}
    assert got[0] == (0, 0) and got[1] == (1, 0) and got[4] == (4, 2) and got[5] == (4, 2) and got[None] == (4, 2)
    assert got[7][0] == got[8][0] == 7 and jaccard_join.links(empty).count() == 0
    kept = jaccard_join.keep_one(hard.unionByName(hard))
    assert kept.columns == hard.columns and sorted(r.doc_id for r in kept.collect()) == [0, 1, 2, 3, 4, 6, 7, 9]


def test_connected_components(spark):
    chain = [(i, i + 1) for i in range(0, 30)] + [(100, 105), (105, 103), (7, 7)]
    roots = {r.node: r.root for r in components.connected_components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert roots == {i: 0 for i in range(1, 31)} | {103: 100, 105: 100}


def test_line_dedup(spark, hard, empty):
    rows = [("keep this first long line\nshort\nunique line number one here", 1), ("Keep  this FIRST long line\n\nshort\nother words come along now", 2),
            ("new line of many words\nnew line of many words", 3), ("", 4), (None, 5), ("short\nand more\nshort", 6)]
    frame = spark.createDataFrame(rows, "text string, doc_id bigint")
    got = {r.doc_id: (r.text, [tuple(s) for s in r.removed]) for r in line_dedup.deduplicate(frame, unit="line", min_words=5).collect()}
    assert got[1] == (rows[0][0], [])
    # a short repeat goes with the long one beside it, and stays where it stands alone
    assert got[2] == ("\nother words come along now", [(0, 26), (28, 33)])
    assert got[3] == ("new line of many words", [(23, 45)]) and got[4] == ("", []) and got[5] == (None, []) and got[6] == (rows[5][0], [])
    hard_rows = {r.doc_id: r.text for r in line_dedup.deduplicate(hard, min_words=5).collect()}
    assert hard_rows[4] == "a b c d e f" and hard_rows[5] == "" and hard_rows[7] == LONG and hard_rows[0] is None
    assert line_dedup.deduplicate(empty).count() == 0
    paragraphs = spark.createDataFrame([("one two three four five\nsix\n\nrest of it", 1),
                                        ("two kept\n\nOne two three four five six\n \nmore\n\nlast", 2)], "text string, doc_id bigint")
    kept = line_dedup.deduplicate(paragraphs, unit="paragraph", min_words=5).orderBy("doc_id").collect()
    assert kept[1].text == "two kept\n\nmore\n\nlast" and kept[0].text == "one two three four five\nsix\n\nrest of it"


def test_passages_go_however_lines_are_cut(spark):
    draw = random.Random(8)
    sentences = [" ".join(f"w{draw.randrange(10**6)}" for _ in range(draw.randint(4, 12))) + "." for _ in range(60)]
    boiler = "All rights reserved."
    source = f"{' '.join(sentences[:30])}\n{boiler}"
    copy = f"{sentences[40]} {' '.join(sentences[5:12])} {sentences[41]}\n{boiler}\n{sentences[42]}"
    other = f"{sentences[50]}\n{boiler}"
    frame = spark.createDataFrame([(1, source), (2, copy), (3, other), (None, copy)], "doc_id long, text string")
    got = {r.doc_id: r for r in line_dedup.deduplicate(frame).collect()}
    assert got[1].text == source and got[3].text == other and got[None].text == copy
    assert got[2].text == f"{sentences[40]} {sentences[41]}\n{boiler}\n{sentences[42]}"
    assert "".join(copy[a:b] + " " for a, b in got[2].removed[:7]) == " ".join(sentences[5:12]) + " "


def test_heavy_digests_go_with_the_tasks(spark, docs, monkeypatch):
    monkeypatch.setattr(line_dedup, "HEAVY", 0)
    joined = line_dedup.repeats(docs).collect()
    monkeypatch.setattr(line_dedup, "HEAVY", 1 << 40)
    assert len(joined) > 10 and sorted(map(repr, joined)) == sorted(map(repr, line_dedup.repeats(docs).collect()))


def test_language_id(spark, docs, hard, empty):
    held = langid.held_out(F.col("doc_id"), 2, 4)
    model = langid.train(docs.where(~held))
    scored = langid.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where(held)
    assert scored.where("lang = lang_pred").count() >= 0.95 * scored.count()
    assert scored.where("score < 0 or score > 1").isEmpty()
    rows = {r.doc_id: r for r in langid.predict(hard, model).collect()}
    assert all(rows[i].lang_pred == "und" and rows[i].score == 0 for i in (0, 1, 2)) and len(rows) == len(HARD) + 1
    assert langid.train(empty) is None and langid.predict(hard, None).where("lang_pred <> 'und'").isEmpty()
    assert langid.predict(empty, model).count() == 0


def test_decontamination(spark, sf, docs, hard, empty):
    benchmark = spark.read.parquet(f"{sf}/benchmark.parquet")
    items = {r.item_id: r.text for r in benchmark.collect()}
    want = {r.doc_id for r in docs.collect() if any(t in (r.text or "") for t in items.values())}
    judged = decontam.judge(docs, benchmark).collect()
    assert {r.doc_id for r in judged if r.contaminated} == want and len(judged) == docs.count()
    asked = "If Maria buys 12 apples for 30 dollars and sells 12 apples again, how much does Maria pay for each of them?"
    own = spark.createDataFrame([(1, asked), (2, "tiny item here"), (3, None), (4, "")], "item_id bigint, text string")
    cases = [
        ("Intro text. " + asked.replace("12", "45").replace("30", "99").replace("Maria", "Peter") + " And more.", 1),
        ("if maria buys twelve apples for a price she is glad", 2),
        ("Well, if Maria buys 12 apples for 30 dollars and sells 13 apples again, who knows?", 3),
        ("Tiny item, HERE!", 4), ("nothing of it", 5)]
    frame = spark.createDataFrame(cases, "text string, doc_id bigint")
    got = {r.doc_id for r in decontam.judge(frame, own).collect() if r.contaminated}
    assert 1 in got and 4 in got and 2 not in got and 5 not in got
    # the slot 12 stands for two values in case 3, so the windows that hold it do not count
    slots = {r.doc_id: r.n_windows for r in decontam.contaminations(frame, own, matches=1).where("item_id = 1").collect()}
    assert slots.get(3, 0) < slots[1]
    assert decontam.judge(hard, own).where("contaminated").isEmpty() and decontam.judge(empty, own).count() == 0
    assert decontam.judge(hard, own.limit(0)).where("contaminated").isEmpty()
    kept = decontam.keep_clean(frame.withColumn("_hash", F.lit(1)), own)
    assert kept.columns == ["text", "doc_id", "_hash"] and kept.where("doc_id in (1, 4)").isEmpty()


def test_url_filters(spark):
    entries = spark.sql("""
        select list, pattern, cast(entered as timestamp) entered, action from values
          ('block', 'example.com', '2024-01-10', 'add'), ('block', 'example.com', '2024-03-01', 'remove'),
          ('block', 'example.com', '2024-01-10', 'add'), ('allow', 'a.example.com/en/', '2024-02-01', 'add'),
          ('block', 'x.org', '2024-01-01', 'add'), ('block', 'x.org', '2024-01-01', 'remove'),
          (null, 'y.org', '2024-01-01', 'add'), ('block', null, '2024-01-01', 'add') as t(list, pattern, entered, action)""")
    captures = spark.sql("""
        select page_id, url, cast(fetched as timestamp) fetched, 1 as list from values
          (1, 'https://a.example.com/en/1', '2024-01-09 23:59:59'), (2, 'https://a.example.com/en/1', '2024-01-10'),
          (3, 'https://u@A.Example.com:80/en/x?q', '2024-02-02'), (4, 'https://a.example.com/de/x', '2024-02-29 23:59:59'),
          (5, 'http://example.com', '2024-03-01'), (6, 'http://x.org/', '2024-02-01'), (7, null, '2024-02-01'), (8, '', null),
          (9, 'not a url', '2024-02-01'), (10, 'http://b.example.com', '2024-02-01'), (10, 'http://b.example.com', '2024-02-01')
          as t(page_id, url, fetched)""")
    rows = url_filters.evaluate(captures, entries).collect()
    blocked = sorted(r.page_id for r in rows if r.blocked)
    assert len(rows) == 11 and blocked == [2, 4, 10, 10]
    third = next(r for r in rows if r.page_id == 3)
    assert (third.list, third.pattern, third.n_active) == ("allow", "a.example.com/en/", 2)
    assert url_filters.evaluate(captures, entries.limit(0)).where("blocked").isEmpty()
    assert url_filters.evaluate(captures.limit(0), entries).count() == 0


def test_attention_learns_and_adds_up_to_one():
    draw = np.random.default_rng(0)
    counts = np.zeros(701, dtype=np.int64)
    counts[:650] = draw.integers(1, 50, size=650)
    model = attention.Attention(counts, end=700)
    # the chances of all one-id texts' first ids add up to one
    total = sum(np.exp(model.score(np.array([i]), np.array([0, 1])))[0] for i in range(701))
    assert total == pytest.approx(1, abs=1e-3)
    texts = [np.append(np.tile([1, 2, 3], 20), 700) for _ in range(40)]
    ids, cuts = np.concatenate(texts), np.cumsum([0] + [len(t) for t in texts])
    inputs, targets, _ = attention.windows(ids, cuts, 700)
    assert np.sort(targets[targets >= 0]).tolist() == list(range(len(ids)))  # each id once
    before = model.score(ids, cuts).sum()
    wanted = np.where(targets >= 0, ids[np.maximum(targets, 0)], -1)
    slots = [np.where(x >= 0, model.slot_of[np.maximum(x, 0)], -1) for x in (inputs, wanted)]
    model.train(*slots, steps=60)
    assert model.score(ids, cuts).sum() > before / 4


def test_scores_equal_a_plain_forward_pass():
    draw = np.random.default_rng(3)
    counts = draw.integers(1, 50, size=900)
    model = attention.Attention(counts, end=899)
    model.w = {name: (value + draw.normal(0, 0.3, value.shape)).astype(np.float32) for name, value in model.w.items()}
    texts = [np.append(draw.integers(0, 899, size=n), 899) for n in (0, 1, 15, 16, 40, 70)]
    w, context, stride = {k: v.astype(np.float64) for k, v in model.w.items()}, attention.CONTEXT, attention.STRIDE

    def plain(ids):
        slots, total = [model.start, *model.slot_of[ids]], 0.0
        for n, target in enumerate(ids):
            # the window in which the id is a target, and the inputs it can see there
            low = max(0, n // stride * stride - (context - stride))
            seen = slots[low: n + 1]
            q = w["embed"][seen[-1]] @ w["q"] / attention.WIDTH ** 0.5
            logits = [q @ (w["embed"][s] @ w["k"]) + w["near"][len(seen) - 1 - i] for i, s in enumerate(seen)]
            share = np.exp(np.array(logits) - max(logits))
            share /= share.sum()
            c = sum(a * (w["embed"][s] @ w["v"]) for a, s in zip(share, seen))
            before = seen[-2] if len(seen) > 1 else 0
            h = np.tanh(c @ w["join"] + w["join_b"] + w["last"][seen[-1]] + w["before"][before])
            slot = model.slot_of[target]
            for scores, at in ((h @ w["group"] + w["group_b"], slot // attention.MEMBERS),
                               (h @ w["member"][slot // attention.MEMBERS] + w["member_b"][slot // attention.MEMBERS], slot % attention.MEMBERS)):
                total += scores[at] - max(scores) - np.log(np.exp(scores - max(scores)).sum())
            total += model.log_share[target]
        return total

    for factor in (1, 40):
        model.w["group"] *= factor
        w["group"] = model.w["group"].astype(np.float64)
        ids, cuts = np.concatenate(texts), np.cumsum([0] + [len(t) for t in texts])
        assert model.score(ids, cuts) == pytest.approx([plain(t) for t in texts], rel=2e-4)


def test_scores_do_not_follow_the_partitions(short_training, docs, monkeypatch):
    monkeypatch.setattr(lm, "SAMPLED_WINDOWS", 300)
    one, many = ({r.doc_id: r.score for r in lm.score(docs.repartition(n), F.lit(True), RANKS).collect()} for n in (1, 7))
    assert len(one) > 100 and all(many[k] == pytest.approx(v, rel=1e-6) for k, v in one.items())


@pytest.fixture
def short_training(monkeypatch):
    whole = attention.Attention.train
    monkeypatch.setattr(attention.Attention, "train", lambda self, *windows: whole(self, *windows, steps=20))


def test_lm_scores(short_training, spark, docs, texts, hard, empty):
    held = langid.held_out(F.col("doc_id"), 2, 7)
    rows = lm.score(docs, ~held, RANKS).collect()
    lower = {i: re.sub("[A-Z]", lambda m: m[0].lower(), t or "") for i, t in texts.items()}
    tokens = {i: [*WORD.findall(t), "\0"] for i, t in lower.items()}
    counts = Counter(w for i, ws in tokens.items() if zlib.crc32(str(i).encode()) % 7 != 2 for w in ws)
    n, v = sum(counts.values()), len(counts)
    assert len(rows) == len(texts)
    for r in rows:
        words = tokens[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words), sum(w in counts for w in words), n)
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words), rel=1e-9)
        assert r.score < 0
    scored = {r.doc_id: r for r in lm.score(hard, F.col("doc_id") >= 0, RANKS).collect()}
    assert len(scored) == len(HARD) + 1 and scored[0].n_tokens == 1 and scored[4].score == pytest.approx(scored[5].score)
    assert lm.score(empty, F.lit(True), RANKS).count() == 0
    untrained = lm.score(hard, F.lit(False), RANKS).first()
    assert untrained.base_score == 0 and untrained.n_known == 0


def test_phrase_probabilities_add_up_and_follow_the_counts(spark, monkeypatch):
    """The score beside a plain restatement of the mixture, with the attention's own window scores."""
    made = []
    whole = lm._fit
    monkeypatch.setattr(lm, "_fit", lambda *a: made.append(whole(*a)) or made[-1])
    monkeypatch.setattr(attention.Attention, "train", lambda self, *windows: None)
    draw = random.Random(4)
    texts = [" ".join(draw.choice(["sun", "moon", "rain", "wind", "tree", "stone"]) for _ in range(n)) for n in (5, 40, 80, 150, 200)]
    texts = [*texts, texts[3], texts[3] + " star", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    ids = list(lm._texts(pa.array([t or "" for t in texts]), RANKS))[0][4:]
    per_text = [ids[0][a:b].tolist() for a, b in zip(ids[1][:-1], ids[1][1:])]
    runs = [[tuple(t[i: i + lm.PHRASE]) for i in range(0, len(t), lm.PHRASE)] for t in per_text]
    for training in (F.col("doc_id") < 7, F.lit(True), F.lit(False)):
        for frequent in (1 << 20, 1):
            monkeypatch.setattr(lm, "FREQUENT", frequent)
            got = {r.doc_id: r.score for r in lm.score(docs, training, RANKS).collect()}
            learned = {r.doc_id for r in docs.where(training).collect()}
            seen = Counter(p for i in learned for p in runs[i])
            n, different = max(sum(seen.values()), 1), len(seen) or 1
            for i, phrases in enumerate(runs):
                by_window = made[-1].window_scores(np.array(per_text[i]), np.array([0, len(per_text[i])]))
                wanted = sum(math.log10(max(seen[p] - 1, 0) / n + different / n * math.exp(by_window[2 * k: 2 * k + 2].sum()))
                             for k, p in enumerate(phrases))
                assert got[i] == pytest.approx(wanted, rel=1e-5)


def test_texts_that_occur_twice_score_apart(short_training, spark):
    draw = random.Random(5)
    words = ["".join(draw.choices("abcdefghij", k=4)) for _ in range(300)]
    texts = [" ".join(draw.choices(words, k=120)) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts + texts[:6])), "doc_id long, text string")
    rows = {r.doc_id: r.score / r.n_ids for r in lm.score(docs, F.lit(True), RANKS).collect()}
    assert min(rows[i] for i in [*range(6), *range(60, 66)]) > max(rows[i] for i in range(6, 60)) + 0.5


def test_rare_words_meet_their_counts_in_the_join(short_training, docs, monkeypatch):
    plain = {r.doc_id: r for r in lm.score(docs, F.lit(True), RANKS).collect()}
    monkeypatch.setattr(lm, "FREQUENT", 50)
    for r in lm.score(docs, F.lit(True), RANKS).collect():
        assert r.n_known == plain[r.doc_id].n_known and r.base_score == pytest.approx(plain[r.doc_id].base_score, rel=1e-9)


def test_every_window_of_the_training_texts_moves_the_weights(short_training, docs, texts, monkeypatch):
    """Beyond the first steps: each round's gradient is that of all windows of its texts, and each id is a target once."""
    monkeypatch.setattr(lm, "SAMPLED_WINDOWS", 300)
    made, whole = [], lm._learn
    held = langid.held_out(F.col("doc_id"), 2, 7)
    monkeypatch.setattr(lm, "_learn", lambda found, model, end: (made.append({k: v.copy() for k, v in model.w.items()}),
                                                                 whole(found, model, end), made.append(model)))
    assert lm.score(docs, ~held, RANKS).count() == len(texts)
    start, model = made
    assert any(np.abs(start[name] - model.w[name]).max() > 1e-3 for name in start)
    learned = [texts[i] or "" for i in sorted(texts) if zlib.crc32(str(i).encode()) % 7 != 2]
    seen = list(lm._texts(pa.array(learned), RANKS))
    keys = np.concatenate([textarrays.mix(lm._text_hash(names, codes, first)) for _, names, codes, first, _, _ in seen]).view(np.int64)
    ids = np.concatenate([s[4] for s in seen])
    sizes = np.concatenate([np.diff(s[5]) for s in seen])
    cuts = np.append(0, np.cumsum(sizes))
    slots = model.slot_of[ids]
    inputs, targets, text = attention.windows(slots, cuts, model.start)
    wanted = np.where(targets >= 0, slots[np.maximum(targets, 0)], -1)
    again = attention.Attention(np.bincount(ids, minlength=lm._coder(RANKS)[1] + 1), lm._coder(RANKS)[1])
    again.w = dict(start)
    adam, n_targets = attention.Adam(again), 0
    for number in range(lm.ROUNDS):
        some = (keys % lm.ROUNDS == number)[text]
        total = again.gradient_sum(inputs[some], wanted[some])
        n_targets += total[-1]
        if total[-1]:
            adam.move(again.by_name(total[:-1] / total[-1]), lm.ROUND_RATE * (1 - number / (lm.ROUNDS + 1)) ** 0.7)
    assert n_targets == len(ids)
    assert again.score(ids, cuts) == pytest.approx(model.score(ids, cuts), rel=1e-4)


def test_gradients_follow_the_loss():
    """Beside differences of the loss that the scores give, along a drawn direction of each weight."""
    draw = np.random.default_rng(9)
    counts = draw.integers(1, 50, size=900)
    model = attention.Attention(counts, end=899)
    sizes = np.array([3, 400, 17, 5000])
    ids, cuts = draw.integers(0, 899, size=sizes.sum()), np.append(0, np.cumsum(sizes))
    slots = model.slot_of[ids]
    inputs, targets, _ = attention.windows(slots, cuts, model.start)
    wanted = np.where(targets >= 0, slots[np.maximum(targets, 0)], -1)
    for factor in (1, 40):
        model.w = {name: (value * (factor if name == "group" else 1)).astype(np.float32) for name, value in model.w.items()}
        start, total = dict(model.w), model.gradient_sum(inputs, wanted)
        assert total[-1] == len(ids)
        for name, gradient in model.by_name(total[:-1]).items():
            way, losses = np.sign(gradient) * draw.uniform(0.5, 1.5, gradient.shape), []
            for step in (1e-3, -1e-3):
                model.w = {**start, name: (start[name] + step * way).astype(np.float32)}
                losses.append(-model._window_sums(inputs, wanted).sum())
            assert (losses[0] - losses[1]) / 2e-3 == pytest.approx((gradient * way).sum(), rel=2e-2), name
        model.w = start


def test_texts_are_encoded_once_and_rounds_read_their_own(short_training, docs, texts, monkeypatch):
    monkeypatch.setattr(lm, "SAMPLED_WINDOWS", 300)
    read = []

    def plans(found, model, end):
        for number in range(lm.ROUNDS):
            some = found.where(F.col("round") == number)
            plan = some._jdf.queryExecution().executedPlan().toString()
            read.append((plan.split("PartitionFilters: [")[1].split("]")[0], some.count()))

    monkeypatch.setattr(lm, "_learn", plans)
    scored = lm.score(docs, ~langid.held_out(F.col("doc_id"), 2, 7), RANKS)
    assert not set(docs.inputFiles()) & set(scored.inputFiles())  # the last pass reads ids, not texts
    assert scored.count() == len(texts)
    assert all("round" in filters for filters, _ in read)
    assert sum(n for _, n in read) == sum(zlib.crc32(str(i).encode()) % 7 != 2 for i in texts)


def test_words_follow_from_the_ids():
    draw = random.Random(8)
    parts = ["'s", "re", "a", "é", "12", "²", "!", "\xa0", "\x1c", "\u3000", "\x85", "中", "ing", "<|endoftext|>", "😀"]
    held = ["", " ", "abba baab abab abba", *[" \n".join("".join(draw.choices(parts, k=draw.randint(1, 6))) for _ in range(n)) for n in (1, 3, 900)], ""]
    _, names, codes, first, ids, cuts = next(iter(lm._texts(pa.array(held), RANKS)))
    found, begin = lm._words_of(ids, cuts, RANKS)
    assert begin.tolist() == first.tolist() and len(found) == len(codes)
    # equal where the words are equal, and there alone
    assert len(set(zip(names[codes].tolist(), found.tolist()))) == len(set(found.tolist())) == len(names)


def test_gradients_of_stored_texts_in_pieces(monkeypatch):
    monkeypatch.setattr(lm, "HELD_WINDOWS", 7)
    draw = np.random.default_rng(6)
    for end in (900, 70_000):
        sizes = np.array([1, 400, 16, 17, 3, 90])
        cuts = np.append(0, np.cumsum(sizes))
        ids = draw.integers(0, end, size=cuts[-1])
        model = attention.Attention(np.bincount(ids, minlength=end + 1), end)
        stored = pa.RecordBatch.from_arrays([lm._packed(ids, cuts, end)], ["held"])
        for low, high in ((0, 6), (1, 4)):
            some = slice(cuts[low], cuts[high])
            slots = model.slot_of[ids[some]]
            inputs, targets, _ = attention.windows(slots, cuts[low: high + 1] - cuts[low], model.start)
            wanted = model.gradient_sum(inputs, np.where(targets >= 0, slots[np.maximum(targets, 0)], -1))
            batches = [stored.slice(low, high - low), stored.slice(0, 0)]
            parts = pa.Table.from_batches(list(lm._gradients(iter(batches), model, end)))
            found = np.concatenate([np.frombuffer(p, np.float64) for p in parts.column("held").to_pylist()])
            assert found[-1] == sizes[low:high].sum() and found == pytest.approx(wanted, rel=1e-4, abs=1e-4)


def test_words_encoded_in_one_text_have_their_own_ids():
    draw = random.Random(8)
    parts = ["'s", "re", "a", "é", "12", "²", "!", "\xa0", "\x1c", "\u3000", "\x85", "中", "ing", "<|endoftext|>", "😀"]
    words = ["".join(draw.choices(parts, k=draw.randint(1, 6))) for _ in range(2000)] + ["\xa0", "\u3000\u3000", "a\xa0"]
    library = tiktoken_encoding()
    for some in (words, [w for w in words if w.split() == [w]], ["\xa0"], []):
        data = np.frombuffer("".join(some).encode(), dtype=np.uint8)
        ends = np.cumsum([len(w.encode()) for w in some]).astype(np.int64)
        ids, counts = lm._coder(RANKS)[0].encode(data, np.append(0, ends)[:-1], ends)
        assert [p.tolist() for p in np.split(ids, np.cumsum(counts))[:-1]] == [library.encode_ordinary(" " + w) for w in some]


def test_hash_spans_tell_words_apart():
    data = np.frombuffer(b"abc abd abc \0\0 \0", dtype=np.uint8)
    starts, ends, _ = textarrays.words(data, np.array([0, len(data)]))
    hashes = textarrays.hash_spans(data, starts, ends)
    assert hashes[0] == hashes[2] and len(set(hashes.tolist())) == 4


def test_decontamination_of_windows_that_lie_apart(spark):
    """Four windows of an item, each between other words, whatever their places in the document."""
    words = [f"word{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(60)]
    item = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")

    def apart(windows, gap):
        return " ".join(" ".join(f"other{chr(97 + i)}{chr(97 + k)}" for k in range(gap)) + " " + " ".join(words[i * 11: i * 11 + 8])
                        for i in range(windows))

    rows = [(gap * 10 + windows, apart(windows, gap)) for gap in (1, 2, 3, 5) for windows in (3, 4)]
    judged = decontam.judge(spark.createDataFrame(rows, "doc_id long, text string"), item).collect()
    assert {r.doc_id: r.contaminated for r in judged} == {key: key % 10 == 4 for key, _ in rows}


def test_long_unbroken_pieces_equal_the_library():
    import public_tokenizers
    import tiktoken

    table = bpe.merges(RANKS)
    plain = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table.ranks, special_tokens={})
    draw = random.Random(6)
    for few in (0, bpe.FEW_TREES):  # all trees side by side, or the last ones each by itself
        for n in (40_000, 3_000) if few else (3_000,):
            texts = ["".join(draw.choices(alphabet, k=n)) for alphabet in ("abcdefghij", "aeiounrst", "x", "é中")]
            data = np.frombuffer("".join(texts).encode(), dtype=np.uint8)
            ends = np.cumsum([len(t.encode()) for t in texts])
            with pytest.MonkeyPatch.context() as patch:
                patch.setattr(bpe, "FEW_TREES", few)
                ids, counts = bpe.merge_pieces(table, data, np.append(0, ends[:-1]), ends)
            wanted = [plain.encode_ordinary(t) for t in texts]
            assert counts.tolist() == [len(w) for w in wanted] and ids.tolist() == [i for w in wanted for i in w]


def test_language_statistics_and_training_equal_a_plain_restatement():
    draw = random.Random(7)
    texts = ["".join(draw.choices("abc dé中 ", k=n)) for n in (0, 1, 3, 30, 200)] + ["aaaa", "aaaa", None]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
    got = {r["place"]: r["n"] for part in langid._document_frequencies(iter([batch, batch])) for r in part.to_pylist()}
    per_text = [langid.grams(*textarrays.flat(pa.array([t], pa.string())))[0].tolist() for t in texts]
    wanted = Counter(p for found in per_text for p in set(found))
    assert got == {-1: 2 * len(texts)} | {p: 2 * n for p, n in wanted.items()}

    idf = np.linspace(0.5, 2, langid.BUCKETS)
    sample = []
    for i in range(12):
        held = sorted(draw.sample(range(40), k=6))
        sample.append(("ab"[i % 2], np.array(held), np.array([draw.random() for _ in held])))
    model = langid.fit(sample, idf)
    z, n = defaultdict(float), defaultdict(float)

    def weight(place, k):
        if abs(z[place, k]) <= langid.L1:
            return 0.0
        sign = 1 if z[place, k] > 0 else -1
        return -(z[place, k] - sign * langid.L1) / ((langid.BETA + math.sqrt(n[place, k])) / langid.ALPHA + langid.L2)

    def shares(logits):
        top = [math.exp(x - max(logits)) for x in logits]
        return [x / sum(top) for x in top]

    rows = [("ab".index(lang), [*zip(map(int, at), (v * idf[at] * langid.SCALE).tolist()), (langid.BUCKETS, 1.0)]) for lang, at, v in sample]
    train, aside = [r for i, r in enumerate(rows) if i % 5], [r for i, r in enumerate(rows) if i % 5 == 0]
    for epoch in range(langid.EPOCHS):
        for i in np.random.default_rng(epoch).permutation(len(train)):
            truth, values = train[i]
            before = {(place, k): weight(place, k) for place, _ in values for k in (0, 1)}
            error = shares([sum(v * before[place, k] for place, v in values) for k in (0, 1)])
            error[truth] -= 1
            for place, v in values:
                for k in (0, 1):
                    g = v * error[k]
                    sigma = (math.sqrt(n[place, k] + g * g) - math.sqrt(n[place, k])) / langid.ALPHA
                    z[place, k] += g - sigma * before[place, k]
                    n[place, k] += g * g
    for place in range(40):
        assert model.weights[place] == pytest.approx([weight(place, k) * idf[place] * langid.SCALE for k in (0, 1)], abs=1e-9)
    assert model.bias == pytest.approx([weight(langid.BUCKETS, k) for k in (0, 1)], abs=1e-9)

    def loss(temperature):
        found = [shares([sum(v * weight(place, k) for place, v in values) / temperature for k in (0, 1)])[truth] for truth, values in aside]
        return -sum(math.log(p + 1e-300) for p in found) / len(found)

    assert loss(model.temperature) == pytest.approx(min(map(loss, np.geomspace(0.05, 20, 121))), rel=1e-9)


def test_equal_language_scores_go_to_the_first_language(spark):
    model = langid.Model(["aa", "bb"], np.zeros((langid.BUCKETS, 2)), np.zeros(2), 1.0)
    rows = langid.predict(spark.createDataFrame([(1, "any text")], "doc_id long, text string"), model).collect()
    assert (rows[0].lang_pred, rows[0].score) == ("aa", 0.5)
