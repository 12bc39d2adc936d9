"""The registered queries: SQL where there is some, and the stages of the pipeline on edge cases."""

import os

import duckdb
import pytest

import corpus_pipeline
from tabwright.llm import catalogue

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("documents", "benchmark", "labels")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_same_as_sql(spark, duck, name):
    df = catalogue.QUERIES[name](spark, FOLDER)
    result = duck.execute(catalogue.ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert sorted(tuple(r) for r in df.select(*columns).collect()) == sorted(result.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLES)))
def test_one_row_or_more_per_document(spark, name):
    n = spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    found = catalogue.QUERIES[name](spark, FOLDER)
    ids = found.select("doc_id").distinct().count()
    assert 0 < ids < n if name == "op2_decontamination" else ids == n


def test_pipeline_gives_whole_sequences(spark):
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    n = spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert 0.5 * n < len({r.doc_id for r in rows}) < n
    lengths = {}
    for r in rows:
        lengths[r.sequence_id] = lengths.get(r.sequence_id, 0) + r.length
    assert [lengths[i] for i in range(len(lengths) - 1)] == [2048] * (len(lengths) - 1)


def test_stages_keep_the_columns(spark, edge_docs, no_docs):
    assert [n for n, _ in corpus_pipeline.STAGES][-1] == "packing"
    for docs in (edge_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, FOLDER)
            assert out.columns == docs.columns and out.count() <= docs.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
