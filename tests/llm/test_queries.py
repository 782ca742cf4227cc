"""Registered queries against their SQL, and the pipeline against its stages done by hand."""

import pytest

import corpus_pipeline
from gridscope.llm import bpe, decontam, jaccard_join, quality, secrets
from gridscope.llm.queries import QUERIES, SQL
from gridscope_checks import compare as comparing


@pytest.fixture(scope="module")
def con(sf):
    return comparing.connect(sf)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, sf, name, monkeypatch):
    monkeypatch.setattr(comparing, "QUERIES", QUERIES)
    monkeypatch.setattr(comparing, "SQL", SQL)
    good, note = comparing.compare(spark, con, name, sf)
    assert good, note


def test_each_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_entry_registers_everything():
    import __spark_entry__

    assert set(QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())


def test_pipeline(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    benchmark = spark.read.parquet(f"{sf}/benchmark.parquet")
    good = {r.doc_id for r in quality.judge(docs).where("kept").collect()}
    left = docs.where(docs.doc_id.isin(*good))
    first = {r.doc_id for r in jaccard_join.links(left).where("doc_id = class_id").collect()}
    left = left.where(left.doc_id.isin(*first))
    clean = {r.doc_id for r in decontam.judge(left, benchmark).where("not contaminated").collect()}
    left = secrets.redact(left.where(left.doc_id.isin(*clean)))
    want = {r.doc_id: r.ids_sha256 for r in bpe.round_trips(left, bpe.default_path("byte_bpe_50k.tiktoken")).collect()}
    assert {r.doc_id: r.ids_sha256 for r in corpus_pipeline.run(spark, sf).collect()} == want
    assert 0 < len(want) < docs.count()


def test_stages_return_the_columns_of_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf).columns == docs.columns
