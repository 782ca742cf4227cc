"""Operator 8: benchmark decontamination by templates.

Tokens are longest runs of letters and digits, in lower case. A template replaces the parts that a
re-parameterised question changes by typed placeholders: numbers, units after a number, and
names (a capitalised word inside a sentence). Windows of template tokens are hashed and joined
with those of the benchmark. For the windows that meet, the replaced values are compared: within an occurrence
(windows of a text and an item at one distance of their places) each slot value of the item must stand for one value
of the document, and the other way round; a window with the item's own values counts in any case.
A document is contaminated by an item if enough consistent windows meet, wherever in the document they lie.

An item shorter than a window is one window of its whole length, and documents are cut at the lengths of such items
too, so that it is found inside longer texts. Whether a first word is a name depends on what stands before it, and windows
dense in numbers or names have too few plain tokens; an item with fewer than the wanted windows without these has
windows of its plain values besides, and is also found where those stand as they are.

Only DataFrame functions are used. A document is its key and text together (told by two 64-bit hashes), so rows of one key
with different texts, and rows without a key, are judged each by its own text. Defined results: null texts and texts without
tokens are clean, and items without tokens are not found; repeated rows are judged alike; items without an id are one item, which
contaminates like others and is not among the named ``items``. A short item (under ``LEAST_TOKENS`` tokens) is reported, but a
document that holds only such is a ``weak_match`` and kept by ``keep_clean``. Extra columns may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridscope.sources.tables import cut_lineage

#: Tokens of a window, and of these at least so many that are no placeholders.
WINDOW = 8
LITERALS = 5
#: So many different windows of an item make a document contaminated, or all that a short item has.
MATCHES = 4
#: Items of fewer tokens do not remove documents.
LEAST_TOKENS = 3

#: Columns that tell a document.
DOC = ["_one", "_two"]

NUMBER, NAME, UNIT = "\ue001", "\ue002", "\ue003"
_TOKEN = rf"\p{{L}}\p{{N}}{NUMBER}{NAME}{UNIT}"

#: Units that may follow a number. Fixed values.
UNITS = ("kg", "km", "cm", "mm", "mg", "ml", "ms", "usd", "eur", "percent", "dollars?", "euros?", "hours?", "minutes?", "seconds?",
         "days?", "weeks?", "months?", "years?", "miles?", "meters?", "metres?", "feet", "inches", "pounds?", "grams?", "liters?", "litres?")


def _tokens(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), rf"[^{_TOKEN}]+"), "")


def _template(text: Column) -> Column:
    """The text with placeholders; token by token in line with the text itself."""
    named = F.regexp_replace(text, r"\p{Lu}(?<=[\p{L}\p{N},;:] \p{Lu})\p{Ll}+(?![\p{L}\p{N}])", NAME)
    measured = F.regexp_replace(named, rf"([0-9]) (?i:{'|'.join(UNITS)})(?![\p{{L}}\p{{N}}])", f"$1 {UNIT}")
    return F.regexp_replace(measured, "[0-9]+", NUMBER)


def _windows(tokens: Column, window: Column) -> Column:
    """Hashes of the windows at all places; none where there are fewer tokens."""
    return F.when((window > 0) & (F.size(tokens) >= window), F.transform(
        F.sequence(F.lit(1), F.size(tokens) - (window - 1)), lambda i: F.xxhash64(F.slice(tokens, i, window)))) \
        .otherwise(F.array().cast("array<bigint>"))


def _cut(cuts: list[tuple[bool, int]]) -> Column:
    """The windows of a text of each kind (of templates, or of plain values) and length: hash, place, length, kind."""
    def kind(plain: bool, size: int) -> Column:
        return F.transform(_windows(F.col("_values" if plain else "_template"), F.lit(size)), lambda h, i: F.struct(
            h.alias("hash"), i.alias("at"), F.lit(size).alias("size"), F.lit(plain).alias("plain")))

    return F.concat(*[kind(plain, size) for plain, size in cuts])


def _place(form: str, at: str) -> Column:
    """The place of a window that has slots; others need none, as nothing in them can differ."""
    return F.when(F.exists(form, lambda t: t.rlike(f"[{NUMBER}{NAME}{UNIT}]")), F.col(at))


def _literals(tokens: Column) -> Column:
    return F.size(F.filter(tokens, lambda t: ~t.rlike(f"[{NUMBER}{NAME}{UNIT}]")))


def _documents(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Key, text, and the two hashes that tell a document."""
    told = [F.xxhash64(F.lit(seed), F.col(key).isNull(), F.col(key), F.col(text)).alias(name) for seed, name in enumerate(DOC)]
    return docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"), *told)


def _hits(docs: DataFrame, benchmark: DataFrame, item: str = "item_id", item_text: str = "text", window: int = WINDOW,
          literals: int = LITERALS, matches: int = MATCHES) -> DataFrame:
    """One row per document (``_documents``) and item that contaminates it."""
    items = benchmark.select(F.xxhash64(F.col(item).isNull(), F.col(item)).alias("_id"), F.col(item).alias("_item"),
                             F.col(item_text).alias("_text")).where("_text is not null") \
        .withColumn("_template", _tokens(_template(F.col("_text")))).withColumn("_values", _tokens(F.col("_text")))
    items = items.withColumn("_size", F.least(F.lit(window), F.size("_template")))
    spread = items.select("_id", "_template", "_values", "_size", F.posexplode(_windows(F.col("_template"), F.col("_size"))).alias("_at", "_hash")) \
        .withColumn("_slots", F.slice("_values", F.col("_at") + 1, F.col("_size"))) \
        .withColumn("_form", F.slice("_template", F.col("_at") + 1, F.col("_size"))) \
        .where(_literals(F.col("_form")) >= F.least(F.lit(literals), F.size("_form"))) \
        .select("_id", "_hash", "_form", "_slots", "_at", F.lit(False).alias("_plain"))
    places = F.sequence(F.lit(1), F.size("_template") - F.col("_size"))
    steady = F.when(F.size("_template") > F.col("_size"), F.size(F.array_distinct(F.filter(
        F.transform(places, lambda i: F.slice("_template", i + 1, F.col("_size"))), lambda w: _literals(w) >= F.least(F.lit(literals), F.size(w))))))
    poor = items.where(F.coalesce(steady, F.lit(0)) < matches) \
        .select("_id", "_values", "_size", F.posexplode(_windows(F.col("_values"), F.col("_size"))).alias("_at", "_hash")) \
        .withColumn("_slots", F.slice("_values", F.col("_at") + 1, F.col("_size"))) \
        .select("_id", "_hash", F.col("_slots").alias("_form"), "_slots", "_at", F.lit(True).alias("_plain"))
    spread = spread.unionByName(poor)
    # written first, so that Spark knows its size when it chooses the join
    known = cut_lineage(spread.select("_id", "_hash", "_form", "_slots", _place("_form", "_at").alias("_item_at"), "_plain").distinct(),
                        "benchmark-windows")
    wanted = cut_lineage(known.select("_hash").distinct(), "benchmark-hashes")

    texts = docs.select(*DOC, "_text").where("_text is not null") \
        .withColumn("_template", _tokens(_template(F.col("_text")))).withColumn("_values", _tokens(F.col("_text")))
    # at most two kinds of each length up to a window
    lengths = known.select("_plain", F.size("_form").alias("n")).distinct().collect()
    cuts = sorted((r["_plain"], r["n"]) for r in lengths) or [(False, window)]
    found = texts.select(*DOC, F.explode(F.concat(*[
        _windows(F.col("_values" if plain else "_template"), F.lit(size)) for plain, size in cuts])).alias("_hash")) \
        .join(wanted, "_hash", "left_semi").select(*DOC).distinct()
    # few documents are left; all their windows are compared value by value
    suspects = cut_lineage(found, "suspects")
    form = F.slice(F.when(F.col("w.plain"), F.col("_values")).otherwise(F.col("_template")), F.col("w.at") + 1, F.col("w.size"))
    again = texts.join(suspects, DOC, "left_semi") \
        .select(*DOC, "_template", "_values", F.explode(_cut(cuts)).alias("w")) \
        .select(*DOC, F.col("w.hash").alias("_hash"), F.col("w.at").alias("_at"), form.alias("_doc_form"),
                F.slice("_values", F.col("w.at") + 1, F.col("w.size")).alias("_doc_slots")) \
        .withColumn("_at", _place("_doc_form", "_at"))
    met = again.join(wanted, "_hash", "left_semi").distinct().join(known, "_hash").where(F.col("_doc_form") == F.col("_form")) \
        .withColumn("_shift", F.col("_at") - F.col("_item_at"))
    pairs = met.withColumn("_pairs", F.filter(
        F.transform("_form", lambda t, i: F.when(
            t.rlike(f"[{NUMBER}{NAME}{UNIT}]"),
            F.struct(F.get("_slots", i).alias("item"), F.get("_doc_slots", i).alias("doc")))), lambda p: p.isNotNull()))
    # a slot value that stands for several values of one occurrence is inconsistent, as are the windows that hold it
    whose = [*DOC, "_id", "_shift"]
    slots = pairs.select(*whose, F.explode(F.array_distinct("_pairs")).alias("p")).select(*whose, "p.item", "p.doc").distinct()
    forth = slots.groupBy(*whose, "item").agg(F.count(F.lit(1)).alias("n")).where("n > 1") \
        .groupBy(*whose).agg(F.collect_set("item").alias("_bad_items"))
    back = slots.groupBy(*whose, "doc").agg(F.count(F.lit(1)).alias("n")).where("n > 1") \
        .groupBy(*whose).agg(F.collect_set("doc").alias("_bad_docs"))
    nothing = F.array().cast("array<string>")
    judged = pairs.join(forth, whose, "left").join(back, whose, "left").where(
        (F.col("_slots") == F.col("_doc_slots"))
        | ~F.exists("_pairs", lambda p: F.array_contains(F.coalesce("_bad_items", nothing), p["item"])
                    | F.array_contains(F.coalesce("_bad_docs", nothing), p["doc"])))
    counts = judged.groupBy(*DOC, "_id", "_plain").agg(F.count_distinct("_hash").alias("_n"))
    sizes = known.groupBy("_id", "_plain").agg(F.count_distinct("_hash").alias("_of"))
    named = items.groupBy("_id").agg(F.max("_item").alias("_item"), F.max(F.size("_template")).alias("_tokens"))
    return counts.join(sizes, ["_id", "_plain"]).where(F.col("_n") >= F.least(F.lit(matches), "_of")) \
        .groupBy(*DOC, "_id").agg(F.max(F.struct("_n", "_of")).alias("_most")).join(named, "_id") \
        .select(*DOC, "_item", F.col("_most._n").cast("long").alias("n_windows"), F.col("_most._of").cast("long").alias("item_windows"),
                F.col("_tokens").alias("item_tokens"))


def contaminations(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", **options) -> DataFrame:
    """One row per document and item that contaminates it: key, item, consistent windows, windows and tokens of the item."""
    rows = _documents(docs, key, text)
    hits = _hits(rows, benchmark, item=item, **options)
    return hits.join(rows.select("_key", *DOC).distinct(), DOC).select(
        F.col("_key").alias(key), F.col("_item").alias(item), "n_windows", "item_windows", "item_tokens")


def judge(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", least_tokens: int = LEAST_TOKENS,
          **options) -> DataFrame:
    """One row per document: its key, whether it is contaminated, by how many windows and which items, and whether by short items only."""
    rows = _documents(docs, key, text)
    hits = cut_lineage(_hits(rows, benchmark, **options), "contaminations")
    by_doc = hits.groupBy(*DOC).agg(
        F.sort_array(F.collect_set("_item")).alias("_items"), F.sum("n_windows").alias("_n"), F.max("item_tokens").alias("_tokens"))
    return rows.select("_key", *DOC).join(by_doc, DOC, "left").select(
        F.col("_key").alias(key), F.col("_n").isNotNull().alias("contaminated"), F.coalesce("_n", F.lit(0).cast("long")).alias("n_windows"),
        F.col("_items").alias("items"), F.coalesce(F.col("_tokens") < least_tokens, F.lit(False)).alias("weak_match"))


def keep_clean(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", least_tokens: int = LEAST_TOKENS,
               **options) -> DataFrame:
    """The documents that no item of at least ``least_tokens`` tokens contaminates, with all their columns."""
    names = docs.columns
    places = [f"_c{i}" for i in range(len(names))]
    placed = docs.toDF(*places)
    key, text = places[names.index(key)], places[names.index(text)]
    hits = cut_lineage(_hits(_documents(placed, key, text), benchmark, **options).where(F.col("item_tokens") >= least_tokens)
                       .select(*DOC).distinct(), "contaminated")
    told = [F.xxhash64(F.lit(seed), F.col(key).isNull(), F.col(key), F.col(text)) == F.col(name) for seed, name in enumerate(DOC)]
    return placed.join(hits, told, "left_anti").toDF(*names)
