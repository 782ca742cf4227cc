"""Operator 6: quality rules, a threshold table compiled into one projection.

Everything is a column expression over the text; no user function runs. Words are longest runs of
characters other than blank and the controls 9 to 13.

Defined results: a null or empty text has no words, all counts 0, and fails the base rules; repeated rows
are judged each for itself; ratios of a text without words count as 0; a measure exactly at a limit passes.
Texts are read whole. Five-word windows are compared by their 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\f\r"
SPACE = r"[\x20\x09-\x0D]"
SYMBOL = r"[#*$%&|<>]"
WINDOW = 5

#: Frequent function words of the languages that the rules know. Fixed values.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "was", "on", "with", "as", "be", "at", "by", "this",
    "are", "or", "from", "an", "he", "not", "you",
    "der", "die", "und", "das", "den", "von", "zu", "mit", "auf", "ist", "im", "ein", "eine", "nicht", "des", "dem", "für",
    "le", "la", "les", "de", "et", "un", "une", "en", "du", "que", "qui", "dans", "par", "pour", "sur", "au", "est", "avec",
    "el", "los", "las", "y", "se", "una", "del", "por", "con", "para", "su", "como", "al", "lo", "no",
)


@dataclass(frozen=True)
class Rule:
    """A measure must lie in [low, high] in texts of ``from_words`` words or more."""

    measure: str
    low: float | None = None
    high: float | None = None
    from_words: int = 0


RULES = (
    Rule("n_words", low=10),
    Rule("chars_per_word", low=2, high=14),
    Rule("symbols_per_word", high=0.25),
    Rule("stop_ratio", low=0.02, from_words=50),
    Rule("dup_line_ratio", high=0.5, from_words=50),
    Rule("marked_line_ratio", high=0.9, from_words=50),
)


def _measures(docs: DataFrame, text: str) -> DataFrame:
    """The frame with a struct ``_m`` of all counts, built in steps so that each part is computed once."""
    whole = docs.withColumn("_t", F.coalesce(F.col(text), F.lit("")))
    split = whole.withColumn("_trimmed", F.btrim("_t", F.lit(SPACES))).withColumn(
        "_words", F.when(F.col("_trimmed") == "", F.array().cast("array<string>")).otherwise(F.split("_trimmed", SPACE + "+"))
    ).withColumn("_lines", F.filter(F.split("_t", "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != ""))
    hashed = split.withColumn("_n", F.size("_words")).withColumn(
        "_windows",
        F.when(F.col("_n") >= WINDOW,
               F.transform(F.sequence(F.lit(1), F.col("_n") - (WINDOW - 1)),
                           lambda i: F.xxhash64(F.slice("_words", i, WINDOW)))))
    repeats = hashed.withColumn(
        "_sorted",
        F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"),
               F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("p"))))))
    places = repeats.withColumn("_places", F.sort_array(F.transform(
        F.filter("_sorted", lambda e, i: F.coalesce(F.get("_sorted", i - 1)["h"] == e["h"], F.lit(False))
                 | F.coalesce(F.get("_sorted", i + 1)["h"] == e["h"], F.lit(False))),
        lambda e: e["p"])))
    covered = F.aggregate(
        F.transform("_places", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get("_places", i + 1) - p, F.lit(WINDOW)))),
        F.lit(0), lambda total, x: total + x)
    # as a generated column, so that a filter on it is not unfolded into all the steps before
    return places.withColumn("_m", F.explode(F.array(F.struct(
        F.col("_n").cast("long").alias("n_words"),
        F.char_length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        (F.octet_length("_t") - F.octet_length(F.regexp_replace("_t", SYMBOL, ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size(F.filter("_words", lambda w: F.lower(w).isin(*STOP_WORDS))).cast("long").alias("n_stop"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.size(F.filter("_lines", lambda line: line.rlike(rf"(?:^{SPACE}*[-*•]|(?:\.\.\.|…){SPACE}*$)"))).cast("long").alias("n_marked"),
    ))))


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _verdict(rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Whether the base rules reject, and whether every rule of the table passes."""
    m = F.col("_m")
    values = {
        "n_words": m["n_words"],
        "chars_per_word": _ratio(m["word_chars"], m["n_words"]),
        "symbols_per_word": _ratio(m["n_symbols"], m["n_words"]),
        "stop_ratio": _ratio(m["n_stop"], m["n_words"]),
        "dup_line_ratio": _ratio(m["n_dup_lines"], m["n_lines"]),
        "marked_line_ratio": _ratio(m["n_marked"], m["n_lines"]),
    }
    failed = (m["n_words"] < 10) | (100 * m["n_repeat_words"] > 20 * m["n_words"])
    passes = F.lit(True)
    for rule in rules:
        value, good = values[rule.measure], F.lit(True)
        if rule.low is not None:
            good = good & (value >= rule.low)
        if rule.high is not None:
            good = good & (value <= rule.high)
        passes = passes & (good | (m["n_words"] < rule.from_words))
    return failed, passes


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row per document: its key, the counts, ``base_failed`` and ``kept``."""
    rows = _measures(docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")), "_text")
    failed, passes = _verdict(rules)
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_stop", "n_lines")
    return rows.select(F.col("_key").alias(key), *[F.col("_m")[c].alias(c) for c in counts],
                       failed.alias("base_failed"), (~failed & passes).alias("kept"))


def keep(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """The documents that pass, with all their columns."""
    names = docs.columns
    places = [f"_c{i}" for i in range(len(names))]
    rows = _measures(docs.toDF(*places), places[names.index(text)])
    failed, passes = _verdict(rules)
    return rows.where(~failed & passes).select(*places).toDF(*names)
