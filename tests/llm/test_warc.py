"""Archives: round trips against a plain reading of the definition, the index, damaged files."""

import base64
import gzip
import hashlib
import zlib

import pytest

from gridscope.llm import warc
from gridscope.sources.tables import scratch_path

ROWS = [(1, "http://a/x", "same"), (7, "http://b/y", "same"), (3, None, "same"), (4, "", ""), (5, "http://c/\r\nWARC-Type: no", None),
        (6, "http://é/中", "é中😀\r\n\r\nWARC/1.1\r\n\r\n"), (None, "http://d", "same"), (None, "http://e", "keyless"), (None, None, "keyless"),
        (9, "http://f", "z" * 3_000_000), (10, "http://f", "z" * 3_000_000), (11, "u", "twice"), (11, "u", "twice"), (2, "u", "twice")]


def expected(rows, least=0):
    largest = {}
    for key, _, html in rows:
        if key is not None:
            largest[html or ""] = max(key, largest.get(html or "", key))
    for key, _, html in rows:
        held = (html or "").encode()
        of = largest.get(html or "") if len(held) >= least else None
        revisit = of is not None and of != key
        yield (key, len(held), base64.b32encode(hashlib.sha1(held).digest()).decode(), "revisit" if revisit else "response",
               of if revisit else None)


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*r, "clash", 1) for r in ROWS], "page_id long, url string, html string, _sha1 string, archive int")


@pytest.mark.parametrize("least,size", [(0, warc.ARCHIVE_BYTES), (5, 2000)])
def test_round_trip(spark, pages, least, size):
    got = warc.round_trip(spark, pages.repartition(3), scratch_path(spark, "warc-test"), least_bytes=least, archive_bytes=size)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, expected(ROWS, least)))


def test_heavy_and_joined_digests_agree(spark, pages, monkeypatch):
    monkeypatch.setattr(warc, "HEAVY", 3)
    few = {tuple(r) for r in warc.digests(pages, "page_id", "html", "url", 0).select("_key", "_url", "_of").collect()}
    monkeypatch.setattr(warc, "HEAVY", 0)
    none = {tuple(r) for r in warc.digests(pages, "page_id", "html", "url", 0).select("_key", "_url", "_of").collect()}
    assert few == none


def test_each_member_is_one_record_at_its_offset(spark, pages):
    folder = scratch_path(spark, "warc-test")
    archives = warc.write(pages.repartition(2), f"{folder}/streams")
    streams = {r.archive for r in archives.collect()}
    index = warc.normalise(archives, f"{folder}/streams", f"{folder}/members")
    local = folder.removeprefix("file:").replace("//", "/")
    for name in streams:
        inflate = zlib.decompressobj(31)
        with open(f"{local}/streams/{name}", "rb") as held:
            inflate.decompress(held.read())
        assert inflate.eof and not inflate.unused_data
    rows = index.collect()
    assert len(rows) == len(ROWS) and not streams & {r.archive for r in rows}
    for archive in {r.archive for r in rows}:
        ends = 0
        with open(f"{local}/members/{archive}", "rb") as held:
            whole = held.read()
        for r in sorted((r for r in rows if r.archive == archive), key=lambda r: r.offset):
            assert r.offset == ends
            ends += r.length
            text = gzip.decompress(whole[r.offset: ends])
            assert text.startswith(b"WARC/1.1\r\n") and f"WARC-Record-ID: {r.record_id}".encode() in text
        assert ends == len(whole)
    one = index.where("record_type = 'response' and url = 'http://f'")
    assert [bytes(r.payload) for r in warc.read(one, f"{folder}/members").collect()] == [b"z" * 3_000_000]
    # archives with a member a record are normalised the same way
    again = warc.normalise(index.select("archive").distinct(), f"{folder}/members", f"{folder}/again")
    assert sorted(r.record_id for r in again.collect()) == sorted(r.record_id for r in rows)


def test_damaged_archives_name_themselves():
    held = gzip.compress(b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 100)

    class Source:
        def __init__(self, data):
            self.data = data

        def read(self, n):
            piece, self.data = self.data[:7], self.data[7:]
            return piece

    def count(data):
        records, n = warc.Records(warc.inflated(Source(data), "x.warc.gz"), "x.warc.gz"), 0
        while (found := records.head()) is not None:
            assert b"".join(records.block(int(found[0]["content-length"]))) == b"abc"
            n += 1
        return n

    assert count(held) == 100 and count(held + held) == 200 and count(b"") == 0
    for bad in (held[:-20], held[:20] + b"???" + held[23:], gzip.compress(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc"),
                gzip.compress(b"WARC/1.1\r\nContent"), gzip.compress(b"no record\r\n\r\n")):
        with pytest.raises(ValueError, match="x.warc.gz"):
            count(bad)


def test_text_keys_and_empty_table(spark):
    rows = [("k:1\r\n", "u", "p"), ("é", "u", "p")]
    pages = spark.createDataFrame(rows, "page_id string, url string, html string")
    got = {r.page_id: r.refers_to for r in warc.round_trip(spark, pages, scratch_path(spark, "warc-test")).collect()}
    assert got == {"k:1\r\n": "é", "é": None}
    assert warc.round_trip(spark, pages.limit(0), scratch_path(spark, "warc-test")).collect() == []
