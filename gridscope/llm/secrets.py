"""Operator 10: secret scans, all as column expressions.

Three base kinds are regular expressions: ``assign`` (a name, a sign, a value), ``access`` (key ids) and ``hex``.
A fourth, ``entropy``, looks at long runs of key characters: a window slides over the run, the counts of
its characters are kept up to date by one that enters and one that leaves, and with them the
Shannon entropy; a run with a window above the threshold of its character class is a secret, unless
an allow-list pattern matches it. Characters of base spans end a run: what stands outside them is a run of its own.

Offsets are code points, end exclusive. Defined results: a null or empty text has no spans; repeated rows are scanned each
for itself; matches of one kind never overlap, those of different base kinds may. Texts are scanned whole.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "entropy")

#: The base patterns. Fixed values.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"

WINDOW = 20
CANDIDATE = r"[A-Za-z0-9+/_-]{%d,}" % WINDOW
#: Character classes of a run, the first that fits, and the least entropy in bits of one of its windows.
CLASSES = (("hex", r"^[0-9A-Fa-f]+$", 3.0), ("letters of one case and digits", r"^(?:[a-z0-9]+|[A-Z0-9]+)$", 3.5),
           ("letters and digits", r"^[A-Za-z0-9]+$", 3.7), ("base64", r"", 3.75))
#: What a word looks like inside a run: capitals before small letters, small letters, two letters as in "Is" or "to", an acronym,
#: a "V" before a number.
WORD = r"(?:[A-Z]{1,7}[a-z]{2,}+|[a-z]{3,}+|[A-Za-z][sftnoyrdpk](?![a-z])|[A-Z]{3,6}+(?![a-z])|V(?=[0-9]))"
#: Runs that are no secrets: letters of one case without a digit, runs without a letter, paths, slugs and names made of words (with short
#: numbers after them, or standing alone between signs), samples. Nothing in them is tried twice, so that no run takes longer than
#: its length.
ALLOWED = (r"^[^0-9A-Z]*$", r"^[^0-9a-z]*$", r"^[^A-Za-z]*$",
           rf"^[/_-]*+(?:{WORD}|(?<=[a-zA-Z])[0-9]{{1,4}}+(?=$|[A-Z/_-])|(?<![A-Za-z0-9])[a-z]{{1,2}}+(?=$|[/_-])"
           r"|[/_-][0-9]{0,4}+(?![0-9a-z])|[/_-])++$",
           r"(?i)example|sample|placeholder")

_OPEN, _CLOSE, _HIDDEN = "\x01", "\x02", "\x03"
_SPAN = "struct<start:int,kind:int,end:int>"


def _matches(text: Column, pattern: str, kind: int, good) -> Column:
    """Spans of the matches that are ``good``: matches are marked, the text is cut at the marks and lengths add up."""
    parts = F.split(F.regexp_replace(text, f"({pattern})", f"{_OPEN}$1{_CLOSE}"), f"[{_OPEN}{_CLOSE}]")
    none = F.array().cast(f"array<{_SPAN}>")
    state = F.struct(F.lit(0).alias("at"), F.lit(False).alias("inside"), none.alias("spans"))

    def step(s: Column, part: Column) -> Column:
        end = s["at"] + F.char_length(part)
        span = F.struct(s["at"].alias("start"), F.lit(kind).alias("kind"), end.alias("end"))
        spans = F.when(s["inside"] & good(part), F.concat(s["spans"], F.array(span))).otherwise(s["spans"])
        return F.struct(end.alias("at"), (~s["inside"]).alias("inside"), spans.alias("spans"))

    return F.when(text.rlike(pattern), F.aggregate(parts, state, step, lambda s: s["spans"])).otherwise(none)


def _c_log_c(count: Column) -> Column:
    return F.when(count > 0, count * F.log2(F.greatest(count, F.lit(1)).cast("double"))).otherwise(F.lit(0.0))


def highest_entropy(run: Column, window: int = WINDOW) -> Column:
    """Highest Shannon entropy, in bits, of the windows of a run of ASCII characters."""
    chars = F.transform(F.split(run, ""), lambda c: F.ascii(c))
    start = F.struct(F.array_repeat(F.lit(0), 128).alias("counts"), F.lit(0.0).alias("sum"),
                     F.lit(0).alias("at"), F.lit(None).cast("double").alias("least"))

    def step(s: Column, code: Column) -> Column:
        # a code of -1 stands for no character
        leaving = F.coalesce(F.get(chars, s["at"] - window), F.lit(-1))
        before = F.get(s["counts"], code)
        entered = s["sum"] - _c_log_c(before) + _c_log_c(before + 1)
        old = F.when(leaving == code, before + 1).otherwise(F.when(leaving >= 0, F.get(s["counts"], F.greatest(leaving, F.lit(0)))))
        total = F.when(leaving >= 0, entered - _c_log_c(old) + _c_log_c(old - 1)).otherwise(entered)
        counts = F.transform(s["counts"], lambda c, i: c + F.when(i == code, 1).otherwise(0) - F.when(i == leaving, 1).otherwise(0))
        full = s["at"] >= window - 1
        least = F.when(full, F.least(s["least"], total)).otherwise(s["least"])
        return F.struct(counts.alias("counts"), total.alias("sum"), (s["at"] + 1).alias("at"), least.alias("least"))

    # with n characters the entropy is log2(n) - sum(c log2 c) / n, so the least sum has the highest entropy
    return F.aggregate(chars, start, step, lambda s: F.lit(math.log2(window)) - s["least"] / window)


def _is_secret(allowed: Sequence[str]):
    def good(run: Column) -> Column:
        suppressed = reduce(lambda a, b: a | b, [run.rlike(p) for p in allowed], F.lit(False))
        threshold = F.lit(CLASSES[-1][2])
        for _, pattern, least in reversed(CLASSES[:-1]):
            threshold = F.when(run.rlike(pattern), F.lit(least)).otherwise(threshold)
        return F.when(suppressed, F.lit(False)).otherwise(highest_entropy(run) >= threshold)

    return good


def _without(text: Column, spans: Column) -> Column:
    """The text with each character of the spans (in order) replaced by one that no pattern takes."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(s: Column, span: Column) -> Column:
        gap = F.substring(text, s["at"] + 1, F.greatest(span["start"] - s["at"], F.lit(0)))
        hidden = F.repeat(F.lit(_HIDDEN), F.greatest(span["end"] - F.greatest(s["at"], span["start"]), F.lit(0)))
        return F.struct(F.greatest(s["at"], span["end"]).alias("at"), F.concat(s["parts"], F.array(gap, hidden)).alias("parts"))

    return F.aggregate(spans, start, step, lambda s: F.concat(
        F.array_join(s["parts"], ""), F.substring(text, s["at"] + 1, F.char_length(text))))


def _with_spans(docs: DataFrame, text: str, allowed: Sequence[str]) -> DataFrame:
    """The frame with ``_base`` and ``_spans``, arrays of (start, kind, end) in order."""
    # the two marks become a third control character: no pattern tells them apart
    rows = docs.withColumn("_t", F.translate(F.coalesce(F.col(text), F.lit("")), _OPEN + _CLOSE, _HIDDEN * 2))
    t = F.col("_t")
    rows = rows.withColumn("_base", F.sort_array(F.concat(
        _matches(t, ASSIGN, 0, lambda part: F.char_length(F.regexp_extract(part, ASSIGN, 1)) >= 6),
        _matches(t, ACCESS, 1, lambda part: F.lit(True)),
        _matches(t, HEX, 2, lambda part: F.lit(True)),
    ))).withColumn("_rest", F.when((F.size("_base") > 0) & t.rlike(CANDIDATE), _without(t, F.col("_base"))).otherwise(t)) \
        .withColumn("_runs", _matches(F.col("_rest"), CANDIDATE, 3, _is_secret(allowed)))
    return rows.withColumn("_spans", F.when(F.size("_runs") == 0, F.col("_base"))
                           .otherwise(F.sort_array(F.concat("_base", "_runs"))))


def _written(spans: str) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])), ",")


def _of_kind(kind: int) -> Column:
    return F.size(F.filter("_spans", lambda span: span["kind"] == kind))


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", allowed: Sequence[str] = ALLOWED) -> DataFrame:
    """One row per document: key, counts per kind, ``base`` and ``spans`` as arrays, and both written as text."""
    rows = _with_spans(docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")), "_text", allowed)
    counts = [_of_kind(k).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return rows.select(F.col("_key").alias(key), *counts, F.col("_base").alias("base"), F.col("_spans").alias("spans"),
                       _written("_base").alias("base_text"), _written("_spans").alias("spans_text"))


def redact(docs: DataFrame, text: str = "text", mark: str = "[secret]", allowed: Sequence[str] = ALLOWED) -> DataFrame:
    """The documents, all columns, with each run of covered characters replaced by ``mark``."""
    names = docs.columns
    places = [f"_c{i}" for i in range(len(names))]
    column = places[names.index(text)]
    rows = _with_spans(docs.toDF(*places), column, allowed)
    whole = F.col(column)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(s: Column, span: Column) -> Column:
        # a span that begins inside the last one only extends it
        gap = F.when(span["start"] >= s["at"], F.array(F.substring(whole, s["at"] + 1, span["start"] - s["at"]), F.lit(mark))) \
            .otherwise(F.array().cast("array<string>"))
        return F.struct(F.greatest(s["at"], span["end"]).alias("at"), F.concat(s["parts"], gap).alias("parts"))

    # the rest needs no length: one past the end is enough
    cleaned = F.aggregate("_spans", start, step, lambda s: F.concat(
        F.array_join(s["parts"], ""), F.substring(whole, s["at"] + 1, F.char_length(whole))))
    clean = F.when(F.size("_spans") > 0, cleaned).otherwise(whole)
    return rows.withColumn(column, clean).select(*places).toDF(*names)
