"""Operator 1: URL filters as a temporal list join.

List entries are dated: an entry adds a pattern to a list or removes it. A pattern is a host, which
covers its subdomains, or a host with a path prefix that ends in ``/``. Entries become validity
intervals [from, to), cut at month borders; each capture asks for its host suffixes and path prefixes
in the month of its fetch, so that the as-of join is an equality join on (pattern, month) with a
range check. Only DataFrame functions are used.

Entries of one pattern and moment are combined before the window that dates them, so a pattern
with a very long list of entries has one row per moment. Of the active patterns the longest decides; of equal
ones an ``allow`` list wins over a ``block`` list.

Defined results: a null, empty or hostless url, or a null fetch time, matches nothing and passes; null patterns, times
or lists of entries are left out; entries that repeat count once; of an addition and a removal at one moment the
removal counts; empty lists let all captures pass; repeated captures are each returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FOREVER = "9999-12-31 00:00:00"


def intervals(entries: DataFrame) -> DataFrame:
    """Validity intervals of entries ``(list, pattern, entered, action)``, action ``add`` or ``remove``."""
    moments = entries.where("list is not null and pattern is not null and entered is not null") \
        .groupBy("list", F.lower("pattern").alias("pattern"), "entered") \
        .agg(F.max(F.col("action") == "remove").alias("removed"))
    ordered = Window.partitionBy("list", "pattern").orderBy("entered")
    return moments.withColumn("until", F.coalesce(F.lead("entered").over(ordered), F.to_timestamp(F.lit(FOREVER)))) \
        .where(~F.coalesce("removed", F.lit(False))) \
        .select("list", "pattern", F.col("entered").alias("since"), "until")


def host_of(url: Column) -> Column:
    """Host of a url in lower case, without user and port; empty if there is none."""
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def patterns_of(url: Column) -> Column:
    """All patterns that could cover a url: host suffixes, and the host with each path prefix."""
    host = host_of(url)
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*/)", 1)
    parts = F.split(F.lower(path), "/")
    prefixes = F.transform(F.sequence(F.lit(2), F.greatest(F.size(parts), F.lit(2))),
                           lambda i: F.concat(host, F.array_join(F.slice(parts, 1, i - 1), "/"), F.lit("/")))
    return F.when(host == "", F.array().cast("array<string>")) \
        .otherwise(F.array_distinct(F.concat(suffixes, F.filter(prefixes, lambda p: path != ""))))


def _month(time: Column) -> Column:
    return F.year(time) * 12 + F.month(time)


def evaluate(captures: DataFrame, entries: DataFrame, key: str = "page_id", url: str = "url",
             fetched: str = "fetched") -> DataFrame:
    """One row per capture: key, fetch time, ``blocked``, the deciding list, pattern and its interval, and ``n_active``."""
    rows = captures.select(F.col(key).alias("_key"), F.col(url).alias("_url"), F.col(fetched).alias("_at"))
    # a capture is told apart from its copies by their number alone
    distinct = rows.groupBy("_key", "_url", "_at").agg(F.count(F.lit(1)).alias("_copies"))
    asked = distinct.where("_url is not null and _at is not null") \
        .select("_key", "_url", "_at", F.explode(patterns_of(F.col("_url"))).alias("pattern"), _month(F.col("_at")).alias("month"))
    # months beyond the last capture are asked for by nobody
    last = distinct.agg(F.max("_at").alias("_last"))
    valid = intervals(entries).withColumn("_last", last.select("_last").scalar())
    valid = valid.where(F.col("since") <= F.col("_last")).select(
        "list", "pattern", "since", "until",
        F.explode(F.sequence(_month(F.col("since")), _month(F.least("until", "_last")))).alias("month"))
    met = asked.join(valid, ["pattern", "month"]).where((F.col("since") <= F.col("_at")) & (F.col("_at") < F.col("until")))
    best = met.groupBy("_key", "_url", "_at").agg(
        F.count(F.lit(1)).alias("_n"),
        F.max(F.struct(F.length("pattern").alias("length"), (F.col("list") == "allow").alias("allow"),
                       "pattern", "list", "since", "until")).alias("_best"))
    best = best.toDF("_key2", "_url2", "_at2", "_n", "_best")
    same = F.col("_key").eqNullSafe(F.col("_key2")) & F.col("_url").eqNullSafe(F.col("_url2")) & F.col("_at").eqNullSafe(F.col("_at2"))
    return distinct.join(best, same, "left").select(
        F.col("_key").alias(key), F.col("_at").alias("fetched"),
        F.coalesce(F.col("_best.list") != "allow", F.lit(False)).alias("blocked"),
        F.col("_best.list").alias("list"), F.col("_best.pattern").alias("pattern"), F.col("_best.since").alias("since"),
        F.coalesce("_n", F.lit(0).cast("long")).alias("n_active"),
        F.explode(F.array_repeat(F.lit(1), F.col("_copies").cast("int"))).alias("_copy")).drop("_copy")
