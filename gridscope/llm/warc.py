"""Operator 12: WARC archives, and their normalisation from one gzip stream to one member a record.

``write`` puts records into archives of one gzip stream each, as many web crawls hand them over. Records of equal payloads of
at least ``least_bytes`` bytes are one ``response``, that of the largest key; the others are ``revisit`` records that name it.
``normalise`` inflates each archive once from end to end in pieces of bounded size, writes every record as a gzip member of
its own, and returns the offset index: one row per record with its archive, offset and length. Written as a table beside the
archives it is the sidecar by which ``read`` takes single records or all of them, many tasks to a large archive.

Archives lie in a folder that the driver and all executors reach, under names that no two attempts of a task share; the index
names those of the attempts that count, so a lost executor leaves no more than files that nothing names.

Heavy payloads: counts per digest are combined before their shuffle. Digests with at least one part in ``HEAVY`` of all rows,
at most ``HEAVY`` of them, go to the tasks, all others are joined.

Defined results: a null payload is an empty one; rows without a key are never chosen before rows with one, and all are responses
where no equal payload has a key; repeated rows of the chosen key are responses each; a null or empty address is left out of the record, control characters
in it are percent-encoded; an empty table gives no archive and an empty index. Extra columns are left out. A damaged or cut archive
raises ``ValueError`` with its name. Archives that have one member a record already are normalised the same way.
"""

from __future__ import annotations

import base64
import hashlib
import math
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridscope.sources.tables import cut_lineage

#: A new archive is begun after so many bytes of records.
ARCHIVE_BYTES = 256 << 20
#: Bytes of an archive that one task reads by the index.
READ_BYTES = 16 << 20
#: Bytes read, inflated or written at once.
PIECE_BYTES = 1 << 20
#: Digests of at least one part in so many of all rows are sent to the tasks.
HEAVY = 1024
LEVEL = 6

VERSION = b"WARC/1.1"
#: What a revisit states, as the format names it. Fixed value.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX_SCHEMA = "archive string, offset long, length long, record_id string, record_type string, url string"
_CONTROL = re.compile(r"[\x00-\x20\x7f]")


def _filesystem(place: str):
    from pyarrow import fs

    place = re.sub(r"^file:/+", "/", place)
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", place))


def base32(sha1_hex: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def digests(pages: DataFrame, key: str, payload: str, url: str, least_bytes: int) -> DataFrame:
    """Rows ``_key``, ``_url``, ``_payload``, ``_sha1`` and ``_of``, the key of the response that a revisit names."""
    rows = pages.select(F.col(key).alias("_key"), F.col(url).cast("string").alias("_url"),
                        F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("_payload"))
    rows = rows.withColumn("_sha1", F.sha1("_payload"))
    counts = cut_lineage(rows.where(F.octet_length("_payload") >= least_bytes).groupBy("_sha1")
                         .agg(F.max("_key").alias("_of"), F.count(F.lit(1)).alias("_n")), "digests")
    total = counts.agg(F.sum("_n")).first()[0] or 0
    heavy = F.col("_n") * HEAVY >= F.lit(total)
    chosen = counts.where("_n > 1").select("_sha1", "_of", heavy.alias("_heavy"))
    # at most HEAVY rows by the rule above
    often = F.broadcast(chosen.where("_heavy").select("_sha1", F.col("_of").alias("_often")))
    # rows that are decided already have no partner and are dealt out by their number
    look = F.when(F.col("_often").isNull(), F.col("_sha1")).otherwise(F.concat(F.lit("-"), F.monotonically_increasing_id()))
    marked = rows.join(often, "_sha1", "left").withColumn("_look", look)
    return marked.join(chosen.where("not _heavy").select(F.col("_sha1").alias("_look"), "_of"), "_look", "left") \
        .select("_key", "_url", "_payload", "_sha1", F.coalesce("_often", "_of").alias("_of"))


def record_id(key: object, sha1: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{key}/{sha1}')}>"


def record(key: object, url: str | None, payload: bytes, sha1: str, refers: object | None) -> bytes:
    """One record; a revisit holds the headers of the answer and not its payload."""
    kind = "response" if refers is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers is not None else http + payload
    head = [f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(key, sha1)}", "WARC-Date: 1970-01-01T00:00:00Z"]
    if url:
        head.append("WARC-Target-URI: " + _CONTROL.sub(lambda c: f"%{ord(c[0]):02X}", url))
    if key is not None:
        head.append(f"X-Key: {quote(str(key))}")
    if refers is not None:
        head += [f"WARC-Refers-To: {record_id(refers, sha1)}", f"X-Refers-To-Key: {quote(str(refers))}", f"WARC-Profile: {PROFILE}"]
    head += [f"WARC-Payload-Digest: sha1:{base32(sha1)}", "Content-Type: application/http;msgtype=response",
             f"Content-Length: {len(block)}"]
    return VERSION + b"\r\n" + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class _Gzip:
    """A gzip stream or member written to an open file."""

    def __init__(self, out: BinaryIO) -> None:
        self.out, self.deflate = out, zlib.compressobj(LEVEL, zlib.DEFLATED, 31)

    def write(self, data: bytes) -> None:
        self.out.write(self.deflate.compress(data))

    def close(self) -> None:
        self.out.write(self.deflate.flush())


def write(pages: DataFrame, folder: str, key: str = "page_id", payload: str = "html", url: str = "url",
          least_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write all rows as records into archives of one gzip stream each; one row per archive (``archive``, ``records``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, place = _filesystem(folder)
        stream = None
        for batch in batches:
            for row in range(batch.num_rows):
                own, address, held, sha1, of = (batch.column(c)[row].as_py() for c in range(5))
                made = record(own, address, held, sha1, None if of is None or of == own else of)
                if stream is not None and size and size + len(made) > archive_bytes:
                    yield _closed(stream, out, name, n)
                    stream = None
                if stream is None:
                    name, n, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = files.open_output_stream(f"{place}/{name}", compression=None)
                    stream = _Gzip(out)
                stream.write(made)
                n, size = n + 1, size + len(made)
        if stream is not None:
            yield _closed(stream, out, name, n)

    _make(folder)
    return cut_lineage(digests(pages, key, payload, url, least_bytes).mapInArrow(run, "archive string, records long"), "archives")


def _closed(stream: _Gzip, out: BinaryIO, name: str, n: int) -> pa.RecordBatch:
    stream.close()
    out.close()
    return pa.RecordBatch.from_pydict({"archive": pa.array([name]), "records": pa.array([n], pa.int64())})


def _make(folder: str) -> None:
    files, place = _filesystem(folder)
    files.create_dir(place, recursive=True)


def inflated(source: BinaryIO, name: str) -> Iterator[bytes]:
    """The bytes of all gzip members of a file, one after the other, in pieces of bounded size."""
    inflate, held, inside = zlib.decompressobj(31), b"", False
    while True:
        held = held or source.read(PIECE_BYTES)
        if not held:
            break
        try:
            out = inflate.decompress(held, PIECE_BYTES)
        except zlib.error as bad:
            raise ValueError(f"damaged archive {name}: {bad}") from bad
        inside = True
        held = inflate.unconsumed_tail
        if inflate.eof:
            held, inflate, inside = inflate.unused_data, zlib.decompressobj(31), False
        if out:
            yield out
    if inside:
        rest = inflate.flush()
        if not inflate.eof:
            raise ValueError(f"archive {name} is cut off")
        yield rest


class Records:
    """Records of a stream of bytes: for each its headers and then its bytes in pieces."""

    def __init__(self, pieces: Iterator[bytes], name: str) -> None:
        self.pieces, self.name, self.held, self.at = pieces, name, b"", 0

    def _more(self) -> bool:
        piece = next(self.pieces, None)
        if piece is None:
            return False
        self.held, self.at = self.held[self.at:] + piece, 0
        return True

    def _skip_ends(self) -> bool:
        """Leave line ends before a record; whether anything follows."""
        while True:
            while self.held[self.at: self.at + 2] == b"\r\n":
                self.at += 2
            if len(self.held) - self.at >= 2:
                return True
            if not self._more():
                return self.at < len(self.held)

    def head(self) -> tuple[dict[str, str], bytes] | None:
        """Headers of the next record (names in lower case) and their bytes; None at the end."""
        if not self._skip_ends():
            return None
        while (end := self.held.find(b"\r\n\r\n", self.at)) < 0:
            if not self._more():
                raise ValueError(f"archive {self.name} ends within a record's headers")
        raw, self.at = self.held[self.at: end + 4], end + 4
        lines = raw[:-4].split(b"\r\n")
        if not lines[0].startswith(b"WARC/"):
            raise ValueError(f"no record at the place of one in {self.name}")
        fields = {}
        for line in lines[1:]:
            field, _, value = line.decode("utf-8", "replace").partition(":")
            fields[field.strip().lower()] = value.strip()
        if not fields.get("content-length", "").isdigit():
            raise ValueError(f"a record without a length in {self.name}")
        return fields, raw

    def block(self, size: int) -> Iterator[bytes]:
        """The ``size`` bytes that follow."""
        while size:
            if self.at == len(self.held) and not self._more():
                raise ValueError(f"archive {self.name} ends within a record")
            piece = self.held[self.at: self.at + size]
            self.at += len(piece)
            size -= len(piece)
            yield piece


def normalise(archives: DataFrame, source: str, target: str) -> DataFrame:
    """Rewrite each archive (column ``archive``, a name in ``source``) with one member a record; the offset index.

    The archives are dealt over the tasks one by one. The index is written beside the new archives.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        old, old_place = _filesystem(source)
        new, new_place = _filesystem(target)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                written, rows, offset = f"{uuid.uuid4().hex}.warc.gz", [], 0
                with old.open_input_stream(f"{old_place}/{name}", compression=None) as given, \
                        new.open_output_stream(f"{new_place}/{written}", compression=None) as out:
                    records = Records(inflated(given, name), name)
                    while (found := records.head()) is not None:
                        fields, raw = found
                        member = _Gzip(out)
                        member.write(raw)
                        for piece in records.block(int(fields["content-length"])):
                            member.write(piece)
                        member.write(b"\r\n\r\n")
                        member.close()
                        end = out.tell()
                        rows.append((written, offset, end - offset, fields.get("warc-record-id"), fields.get("warc-type"),
                                     fields.get("warc-target-uri")))
                        offset = end
                        if len(rows) == 10_000:
                            yield _index(rows)
                            rows = []
                yield _index(rows)

    _make(target)
    # one archive to a task, however few rows name them
    n = max(1, archives.count())
    dealt = archives.select("archive").repartition(n, "archive")
    index = dealt.mapInArrow(run, INDEX_SCHEMA)
    index.write.mode("error").parquet(f"{target}/index")
    return archives.sparkSession.read.schema(INDEX_SCHEMA).parquet(f"{target}/index")


def _index(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
    columns = zip(*rows) if rows else [[]] * 6
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)],
                                      [field.split()[0] for field in INDEX_SCHEMA.split(", ")])


def read(index: DataFrame, folder: str, key_type: str = "bigint") -> DataFrame:
    """The records that index rows name: key, address, type, refers-to key, size and digest of the payload, the payload.

    A large archive is read by several tasks, each its own ranges of members. Size and digest of a response are of
    the payload as read; those of a revisit are what its headers state.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, place = _filesystem(folder)
        name, source = None, None
        for batch in batches:
            rows = []
            for archive, offset, length in zip(*(batch.column(c).to_pylist() for c in range(3))):
                if archive != name:
                    if source is not None:
                        source.close()
                    name, source = archive, files.open_input_file(f"{place}/{archive}")
                source.seek(offset)
                rows.append(_parsed(source.read(length), archive))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows) if rows else [[]] * 7, kinds)], names)

    names = ["key", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]
    kinds = [pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
    schema = "key string, url string, record_type string, refers_to string, payload_bytes long, payload_digest string, payload binary"
    ranges = index.select("archive", "offset", "length", F.floor(F.col("offset") / READ_BYTES).alias("_range"))
    # index rows are small and what they name is not: as many parts as there are ranges
    n = max(1, math.ceil((index.agg(F.sum("length")).first()[0] or 0) / READ_BYTES))
    dealt = ranges.repartition(n, "archive", "_range").sortWithinPartitions("archive", "offset").drop("_range")
    found = dealt.mapInArrow(run, schema)
    return found.withColumns({"key": F.col("key").cast(key_type), "refers_to": F.col("refers_to").cast(key_type)})


def _parsed(member: bytes, name: str) -> tuple:
    records = Records(inflated(pa.BufferReader(member), name), name)
    fields, _ = records.head()
    block = b"".join(records.block(int(fields["content-length"])))
    head, _, payload = block.partition(b"\r\n\r\n")
    revisit = fields["warc-type"] == "revisit"
    if revisit:
        stated = re.search(rb"(?im)^content-length:\s*(\d+)", head)
        size, digest = int(stated[1]) if stated else 0, fields.get("warc-payload-digest", "").removeprefix("sha1:")
    else:
        size, digest = len(payload), base32(hashlib.sha1(payload).hexdigest())
    own, of = (unquote(fields[name]) if name in fields else None for name in ("x-key", "x-refers-to-key"))
    return own, fields.get("warc-target-uri"), fields["warc-type"], of, size, digest, None if revisit else payload


def round_trip(spark: SparkSession, pages: DataFrame, folder: str, key: str = "page_id", **options) -> DataFrame:
    """Write archives, normalise them, and read all records back by the index."""
    archives = write(pages, f"{folder}/streams", key, **options)
    index = normalise(archives, f"{folder}/streams", f"{folder}/members")
    found = read(index, f"{folder}/members", pages.schema[key].dataType.simpleString())
    return found.select(F.col("key").alias(key), "payload_bytes", "payload_digest", "record_type", "refers_to")
