"""Registered queries of the subpackage: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridscope.llm import alignment, bpe, decontam, jaccard_join, langid, lexical, line_dedup, lm, quality, secrets, token_store, url_filters, warc
from gridscope.llm.queries_sql import SQL
from gridscope.sources.tables import scratch_path

__all__ = ["QUERIES", "SQL"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def derived_number(text, modulus: int):
    """A number below ``modulus`` that follows from a text (the first seven hex digits of its md5)."""
    return F.conv(F.substring(F.md5(text), 1, 7), 16, 10).cast("long") % modulus


def dated_captures(pages: DataFrame) -> DataFrame:
    """The pages with a fetch time in 2024 that follows from the url."""
    day = derived_number(F.coalesce("url", F.lit("")), 366)
    return pages.select("page_id", "url", F.timestamp_add("DAY", day, F.lit("2024-01-01 00:00:00").cast("timestamp")).alias("fetched"))


def dated_entries(pages: DataFrame) -> DataFrame:
    """List entries that follow from the hosts and first path parts of the pages.

    A third of the hosts are blocked for two spells, a quarter of their parent domains for one, and some
    host and path pairs are allowed.
    """
    host = url_filters.host_of(F.col("url"))
    named = pages.select(
        host.alias("host"),
        F.regexp_extract(F.lower("url"), r"^[a-z][a-z0-9+.-]*://[^/?#]*(/[^/?#]+/)", 1).alias("part")).where("host <> ''").distinct()
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")

    def dated(rows: DataFrame, kind: str, share: int, spells: tuple[tuple[str, int], ...]) -> DataFrame:
        number = derived_number("pattern", 1_000_000)
        changes = F.array(*[F.struct(F.lit(a).alias("action"), F.lit(d).alias("after")) for a, d in spells])
        return rows.distinct().where(number % share == 0).select("pattern", number.alias("n"), F.explode(changes).alias("c")) \
            .select(F.lit(kind).alias("list"), "pattern",
                    F.timestamp_add("DAY", F.col("n") % 200 + F.col("c.after"), start).alias("entered"), F.col("c.action").alias("action"))

    hosts = named.select(F.col("host").alias("pattern"))
    parents = named.select(F.regexp_extract("host", r"^[^.]+\.(.+\..+)$", 1).alias("pattern")).where("pattern <> ''")
    paths = named.where("part <> ''").select(F.concat("host", "part").alias("pattern"))
    return dated(hosts, "block", 3, (("add", 0), ("remove", 60), ("add", 120))) \
        .unionByName(dated(parents, "block", 4, (("add", 30), ("remove", 130)))) \
        .unionByName(dated(paths, "allow", 2, (("add", 10), ("remove", 200))))


@query
def op1_url_filters(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages")
    return url_filters.evaluate(dated_captures(pages), dated_entries(pages))


@query
def op4_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    docs = line_dedup.deduplicate(table(spark, sf, "documents"))
    return docs.select("doc_id", F.size("removed").cast("long").alias("n_removed"),
                       F.array_join(F.transform("removed", lambda s: F.concat_ws(":", s["start"], s["end"])), ",").alias("removed"), "text")


@query
def op5_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return bpe.round_trips(table(spark, sf, "documents"), bpe.default_path("byte_bpe_50k.tiktoken"))


@query
def op6_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality.judge(table(spark, sf, "documents")).drop("n_stop", "n_lines")


@query
def op7_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    held = langid.held_out(F.col("doc_id"), 2, 4)
    model = langid.train(docs.where(~held))
    return langid.predict(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score")


@query
def op8_benchmark_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    judged = decontam.judge(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return judged.withColumn("items", F.array_join("items", ","))


@query
def op9_token_output(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch_path(spark, "token-ids")
    token_store.write(table(spark, sf, "documents"), folder, bpe.default_path("byte_bpe_50k.json"))
    return token_store.read_documents(spark, folder)


@query
def op10_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    found = secrets.scan(table(spark, sf, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex",
                        F.sha2(F.col("base_text").cast("binary"), 256).alias("base_sha256"), F.col("spans_text").alias("spans"), "n_entropy")


@query
def op3_ngram_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard_join.links(table(spark, sf, "documents"))


@query
def op2_lm_scoring(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    held = langid.held_out(F.col("doc_id"), 2, 7)
    scored = lm.score(docs, ~held, bpe.default_path("byte_bpe_50k.tiktoken"))
    return scored.select("doc_id", langid.held_out(F.col("doc_id"), 2, 7).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                         "base_score", "score", "n_ids")


@query
def op11_token_alignment(spark: SparkSession, sf: str) -> DataFrame:
    return alignment.measure(table(spark, sf, "documents"), bpe.default_path("byte_bpe_50k.json"), bpe.default_path("piece_bpe_32k.model"))


@query
def op12_warc(spark: SparkSession, sf: str) -> DataFrame:
    return warc.round_trip(spark, table(spark, sf, "pages"), scratch_path(spark, "warc"))


@query
def op13_lexical_search(spark: SparkSession, sf: str) -> DataFrame:
    return lexical.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
