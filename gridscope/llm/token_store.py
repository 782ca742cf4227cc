"""Operator 9: token ids in a binary format of directly addressable codes.

Documents are put in ascending key order by a range partitioning, encoded, and written in
segments. A segment holds whole documents: their keys and counts, and all their ids as chunk
levels. Level 0 has the low 8 bits of every id, level 1 the next 8 bits of those ids that have
more, and so on; each level has a bitmap that tells which of its entries go on and a directory of
ranks before each 512 bits. One id is read by at most one byte and one rank per level, without
decoding anything else (``Segment.get``).

Segments are the binary cells of a Parquet table, so that any store Spark can write to can hold them
and a lost task's attempt leaves nothing behind. The place of a document among all ids
follows from the ids per segment, summed per range and then over the ranges.

Defined results: a null or empty text has the end id alone; null keys come first, keys that are no whole number count
as null; rows of one key are ordered by the hash of their text, so that a hot key is dealt over many ranges; an empty table
gives an empty table of segments.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridscope.llm.byte_level import coder

MAGIC = b"DAC1"
CHUNK_BITS = 8
BLOCK_BITS = 512
#: A segment is closed when it has so many ids; a longer document has a segment of its own.
SEGMENT_IDS = 1 << 20
END_ID = 0

SEGMENT_SCHEMA = "part int, segment int, documents long, ids long, payload binary"


def pack(keys: np.ndarray, known: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> bytes:
    """A segment: document keys (and whether they are known), ids per document, all ids."""
    values, levels = ids.astype(np.uint32), []
    while True:
        rest = values >> np.uint32(CHUNK_BITS)
        more = rest > 0
        bits = np.packbits(more, bitorder="little")
        bits = np.concatenate([bits, np.zeros(-len(bits) % (BLOCK_BITS // 8), dtype=np.uint8)])
        in_block = np.bitwise_count(bits.reshape(-1, BLOCK_BITS // 8)).sum(axis=1, dtype=np.uint32)
        ranks = (np.cumsum(in_block, dtype=np.uint32) - in_block).astype("<u4")
        levels.append((len(values), (values & np.uint32((1 << CHUNK_BITS) - 1)).astype(np.uint8), bits, ranks))
        values = rest[more]
        if not len(values):
            break
    head = struct.pack("<4sIQQ", MAGIC, len(levels), len(keys), len(ids))
    body = [keys.astype("<i8").tobytes(), known.astype(np.uint8).tobytes(), counts.astype("<u8").tobytes()]
    for n, chunk, bits, ranks in levels:
        body += [struct.pack("<QQ", n, len(bits)), chunk.tobytes(), bits.tobytes(), ranks.tobytes()]
    return head + b"".join(body)


class Segment:
    """A segment read from its bytes."""

    def __init__(self, payload: bytes) -> None:
        magic, levels, documents, self.size = struct.unpack_from("<4sIQQ", payload)
        if magic != MAGIC:
            raise ValueError("not a segment of token ids")
        at = struct.calcsize("<4sIQQ")

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            held = np.frombuffer(payload, dtype=kind, count=n, offset=at)
            at += held.nbytes
            return held

        self.keys, self.known, self.counts = take("<i8", documents), take("u1", documents) > 0, take("<u8", documents)
        self.levels = []
        for _ in range(levels):
            n, width = struct.unpack_from("<QQ", payload, at)
            at += struct.calcsize("<QQ")
            self.levels.append((take("u1", n), take("u1", width), take("<u4", width * 8 // BLOCK_BITS)))

    def get(self, place: int) -> int:
        """The id at one place, without reading others."""
        if not 0 <= place < self.size:
            raise IndexError(place)
        value = 0
        for level, (chunk, bits, ranks) in enumerate(self.levels):
            value |= int(chunk[place]) << (CHUNK_BITS * level)
            if not bits[place >> 3] >> (place & 7) & 1:
                break
            block = place // BLOCK_BITS
            first = block * BLOCK_BITS // 8
            whole = int(np.bitwise_count(bits[first: place >> 3]).sum())
            part = int(bits[place >> 3] & ((1 << (place & 7)) - 1)).bit_count()
            place = int(ranks[block]) + whole + part
        return value

    def ids(self) -> np.ndarray:
        """All ids in order."""
        values = np.zeros(0, dtype=np.uint32)
        for chunk, bits, _ in reversed(self.levels):
            upper = values
            values = chunk.astype(np.uint32)
            if len(upper):
                values[np.unpackbits(bits, count=len(chunk), bitorder="little").astype(bool)] |= upper << np.uint32(CHUNK_BITS)
        return values


def _segments(batches: Iterator[pa.RecordBatch], path: str, limit: int) -> Iterator[pa.RecordBatch]:
    part, number = TaskContext.get().partitionId(), 0
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []

    def close() -> pa.RecordBatch:
        nonlocal number, held
        keys, known, counts, ids = (np.concatenate(x) for x in zip(*held))
        row = [[part], [number], [len(keys)], [len(ids)], [pack(keys, known, counts, ids)]]
        number, held = number + 1, []
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, kinds)],
                                          ["part", "segment", "documents", "ids", "payload"])

    size = 0
    for batch in batches:
        known = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
        keys = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        for row, ids, cuts in coder(path).texts(batch.column(1)):
            counts = np.diff(cuts)
            rows = slice(row, row + len(counts))
            ended = np.insert(ids, cuts[1:], END_ID)
            bounds = np.append(0, np.cumsum(counts + 1))
            first = 0
            while first < len(counts):
                last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + limit - size, side="right")) - 1)
                last = min(last, len(counts))
                if size and size + bounds[last] - bounds[first] > limit:
                    yield close()
                    size = 0
                    continue
                held.append((keys[rows][first:last], known[rows][first:last], counts[first:last] + 1,
                             ended[bounds[first]: bounds[last]]))
                size += int(bounds[last] - bounds[first])
                first = last
    if held:
        yield close()


def write(docs: DataFrame, folder: str, tokenizer: str, key: str = "doc_id", text: str = "text",
          segment_ids: int = SEGMENT_IDS) -> None:
    """Encode all texts with the ``tokenizers`` file and write their ids in ascending key order."""
    rows = docs.select(F.expr(f"try_cast(`{key}` as long)").alias("key"), F.col(text).alias("text"), F.xxhash64(text).alias("hash"))
    ranged = rows.repartitionByRange(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "key", "hash") \
        .sortWithinPartitions("key", "hash", "text")
    ranged.select("key", "text").mapInArrow(lambda batches: _segments(batches, tokenizer, segment_ids), SEGMENT_SCHEMA) \
        .write.mode("error").parquet(folder)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            segment = Segment(batch.column(2)[row].as_py())
            counts = segment.counts.astype(np.int64)
            ends = np.cumsum(counts)
            written = segment.ids().astype("<u4")
            crcs = [zlib.crc32(written[a:b]) for a, b in zip((ends - counts).tolist(), ends.tolist())]
            n = len(counts)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(n, batch.column(0)[row].as_py()), pa.int32()),
                pa.array(np.full(n, batch.column(1)[row].as_py()), pa.int32()),
                pa.array(segment.keys, pa.int64(), mask=~segment.known),
                pa.array(ends - counts), pa.array(counts), pa.array(crcs, pa.int64()),
            ], ["part", "segment", "doc_id", "inside", "n_tokens", "ids_crc32"])


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Per document from the files: ``doc_id``, ``start`` (ids before it), ``n_tokens``, ``ids_crc32``."""
    stored = spark.read.schema(SEGMENT_SCHEMA).parquet(folder)
    documents = stored.select("part", "segment", "payload").mapInArrow(
        _documents, "part int, segment int, doc_id long, inside long, n_tokens long, ids_crc32 long")
    sizes = stored.select("part", "segment", "ids")
    # one row per range: as many as there are partitions
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = sizes.groupBy("part").agg(F.sum("ids").alias("ids")) \
        .select("part", F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("earlier", F.coalesce(F.sum("ids").over(inside), F.lit(0))).join(ranges, "part") \
        .select("part", "segment", (F.col("before") + F.col("earlier")).alias("first"))
    return documents.join(starts, ["part", "segment"]).select(
        "doc_id", (F.col("first") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def read_tokens(spark: SparkSession, folder: str, part: int, segment: int, places: list[int]) -> list[int]:
    """Single ids of one segment by their places."""
    found = spark.read.schema(SEGMENT_SCHEMA).parquet(folder) \
        .where((F.col("part") == part) & (F.col("segment") == segment)).select("payload").first()
    held = Segment(bytes(found.payload))
    return [held.get(place) for place in places]
