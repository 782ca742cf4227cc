"""Operator 4: substring dedup by hashed lines, paragraphs or sentences of lines.

A unit is normalised (lower case, one blank between words) and hashed to 128 bits. Digests are grouped over the whole corpus
with map-side combination; the earliest unit by (key, place) stays. A later one is a repeat. Repeats that stand next to each other in a
text (units without words aside) are a run, and a run goes if its units have at least ``min_words`` words together: a
passage goes however it is cut, and a short unit that repeats by chance stays. Offsets are code points of the original text, end
exclusive.

Sentences end at a line feed, and at the white space after ``.``, ``!``, ``?`` or ``…``.

Heavy digests, at least one part in ``HEAVY`` of all units and so at most ``HEAVY`` of them, go to the tasks; all others are joined.

Repeats belong to a text under its key (told by a 64-bit hash of the text), so that rows of one key with different
texts, or rows without a key, lose only what was measured on themselves.

Defined results: a null or empty text has no units and stays as it is; rows of one key and text fare alike; a unit that
rows of one key share is no later copy among them; rows without a key lose their inner repeats only; kept units are
joined by what stood after the first of two neighbours; an empty table gives an empty result. Texts are whole, no unit is skipped
for its size.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridscope.sources.tables import cut_lineage

#: Words that a run of repeats has at least.
MIN_WORDS = 20
#: Digests of at least one part in so many of all units are sent to the tasks.
HEAVY = 1024

#: What separates units.
SEPARATORS = {"line": re.compile(r"\n"), "paragraph": re.compile(r"\n[ \t\r]*\n\s*"),
              "sentence": re.compile(r"\n|(?<=[.!?…])[ \t\r]")}

#: Columns that tell a text under its key.
ROW = ["_key", "_hash"]

UNIT_SCHEMA = "place int, high long, low long, again boolean"


def _spans(text: str, separator: re.Pattern) -> Iterator[tuple[int, int, list[str]]]:
    """Start, end and normalised words of the units that have any."""
    at = 0
    for cut in separator.finditer(text):
        if words := text[at: cut.start()].lower().split():
            yield at, cut.start(), words
        at = cut.end()
    if words := text[at:].lower().split():
        yield at, len(text), words


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Key, hash of the text, and the text."""
    return docs.select(F.col(key).alias("_key"), F.xxhash64(text).alias("_hash"), F.col(text).alias("_text"))


def units(docs: DataFrame, key: str, text: str, unit: str = "sentence") -> DataFrame:
    """One row per unit: key and text hash, number in the text, digest, and whether it came earlier in the text."""
    import xxhash

    separator = SEPARATORS[unit]
    texts = _rows(docs, key, text)
    schema = T.StructType(texts.select(*ROW).schema.fields + T.StructType.fromDDL(UNIT_SCHEMA).fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, places, highs, lows, agains = [], [], [], [], []
            for row, whole in enumerate(batch.column(2).to_pylist()):
                seen = set()
                for place, (_, _, words) in enumerate(_spans(whole or "", separator)):
                    digest = xxhash.xxh3_128_intdigest(" ".join(words).encode())
                    rows.append(row)
                    places.append(place)
                    highs.append((digest >> 64) - (1 << 63))
                    lows.append((digest & ((1 << 64) - 1)) - (1 << 63))
                    agains.append(digest in seen)
                    seen.add(digest)
            at = pa.array(rows, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k).take(at) for k in range(2)], pa.array(places, pa.int32()), pa.array(highs, pa.int64()),
                 pa.array(lows, pa.int64()), pa.array(agains, pa.bool_())], schema.names)

    return texts.mapInArrow(run, schema)


def repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", unit: str = "sentence") -> DataFrame:
    """Per text with any: key, text hash, and ``places``, the numbers of its units that came earlier."""
    found = cut_lineage(units(docs, key, text, unit), "units")
    total = found.count()
    firsts = cut_lineage(found.groupBy("high", "low").agg(F.min("_key").alias("_first"), F.count(F.lit(1)).alias("_n"))
                         .where("_n > 1"), "firsts")
    # at most HEAVY rows by this rule
    heavy = F.col("_n") * HEAVY >= F.lit(total)
    often, seldom = F.broadcast(firsts.where(heavy).drop("_n")), firsts.where(~heavy).drop("_n")
    met = found.join(often, ["high", "low"]).unionByName(
        found.join(often.select("high", "low"), ["high", "low"], "left_anti").join(seldom, ["high", "low"]))
    later = met.where(F.col("again") | (F.col("_key") > F.col("_first")))
    return later.groupBy(*ROW).agg(F.array_sort(F.collect_set("place")).alias("places"))


def _cut(text: str, places: list[int], separator: re.Pattern, min_words: int) -> tuple[str, list[dict]]:
    """The text without its long runs of repeats, and the spans that went."""
    spans, later = list(_spans(text, separator)), set(places)
    gone, run, words = [], [], 0
    for place, (start, end, found) in enumerate(spans):
        if place in later:
            run.append((start, end))
            words += len(found)
        if place not in later or place == len(spans) - 1:
            gone += run if words >= min_words else []
            run, words = [], 0
    if not gone:
        return text, []
    held, starts, at = [], {start: end for start, end in gone}, 0
    for cut in [*separator.finditer(text), None]:
        stop, after = (len(text), len(text)) if cut is None else cut.span()
        if at not in starts:
            held += [text[at:stop], text[stop:after]]
        at = after
    return "".join(held[:-1]), [{"start": start, "end": end} for start, end in gone]


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", unit: str = "sentence",
                min_words: int = MIN_WORDS) -> DataFrame:
    """One row per document: key, text without long runs of repeats, and ``removed``, the spans of the original that went."""
    later = repeats(docs, key, text, unit)
    separator = SEPARATORS[unit]
    joined = _rows(docs, key, text).join(
        later.withColumnsRenamed({"_key": "_other", "_hash": "_of"}),
        F.col("_key").eqNullSafe(F.col("_other")) & (F.col("_hash") == F.col("_of")), "left").select("_key", "_text", "places")
    spans = T.ArrayType(T.StructType().add("start", "integer").add("end", "integer"))
    schema = T.StructType([T.StructField(key, joined.schema["_key"].dataType)]).add("text", "string").add("removed", spans)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            cut = [(whole, []) if not places else _cut(whole, places, separator, min_words)
                   for whole, places in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([t for t, _ in cut], pa.string()),
                                              pa.array([gone for _, gone in cut], kind)], schema.names)

    return joined.mapInArrow(run, schema)
