"""The pipeline stage by stage, and the registered queries on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from reviewgrove.llm.queries import REGISTERED, SQL


def test_registered_queries_are_in_the_contract():
    names = {*REGISTERED, "pipeline"}
    assert names <= set(contract.queries()) and len(names) == 14
    assert set(SQL) <= set(contract.oracle_sql())


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    last = len(corpus_pipeline.STAGES) - 1
    for i, (_, function) in enumerate(corpus_pipeline.STAGES):
        before = docs.columns
        docs = function(spark, docs, sf_dir).persist()
        if i < last:
            assert docs.columns == before
            own = [r.doc_id for r in docs.select("doc_id").collect()]
            assert len(own) == len(set(own)) and set(own) <= ids
            ids = set(own)
    assert {r.doc_id for r in docs.select("doc_id").collect()} == ids


@pytest.mark.parametrize("name", sorted(REGISTERED))
def test_queries(spark, sf_dir, name):
    rows = REGISTERED[name](spark, sf_dir)
    assert rows.count() > 0
    if name in SQL:
        connection = duckdb.connect()
        for table in ("documents", "pages", "conversations", "benchmark"):
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
        expected = connection.execute(SQL[name])
        assert rows.columns == [column[0] for column in expected.description]
        assert sorted(map(repr, map(tuple, rows.collect()))) == sorted(map(repr, expected.fetchall()))


def odd_documents(spark, sf_dir):
    """The smallest table with null, empty, blank, very long, repeated and unnumbered rows, and columns whose names the stages use."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    some = docs.limit(1).first()
    rows = [(9001, None), (9002, ""), (9003, " \n\t"), (9004, "one"), (9005, some.text * 40), (9006, "x" * 200_000), (None, some.text), (None, None)]
    odd = spark.createDataFrame([(i, t, None if i == 9005 else "en", "odd", 0) for i, t in rows], docs.schema)
    names = ["row", "_row", "_text", "kept", "score", "perplexity", "spans", "key", "tree", "_hash", "sequence_id", "n_words"]
    whole = docs.unionByName(odd).unionByName(docs.limit(3)).unionByName(docs.filter("doc_id = 5"))
    return whole.selectExpr("*", *[f"cast(doc_id AS string) AS {name}" for name in names])


def test_stages_on_odd_rows(spark, sf_dir):
    docs = odd_documents(spark, sf_dir).persist()
    given = {(r.doc_id, r.text) for r in docs.collect()}
    last = len(corpus_pipeline.STAGES) - 1
    for i, (_, function) in enumerate(corpus_pipeline.STAGES):
        # Every stage on all rows, not only on those that the stages before it keep.
        found = function(spark, docs, sf_dir)
        if i < last:
            rows = found.collect()
            assert found.columns == docs.columns and rows
            assert {(r.doc_id, r.text) for r in rows} <= given
            assert all(r.row == r.n_words == (None if r.doc_id is None else str(r.doc_id)) for r in rows)
        else:
            sizes = {}
            for r in found.collect():
                sizes[r.sequence_id] = sizes.get(r.sequence_id, 0) + r.length
            assert max(sizes.values()) <= 2048 and sum(sizes.values()) > 0


def test_stages_on_an_empty_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for i, (_, function) in enumerate(corpus_pipeline.STAGES):
        found = function(spark, docs, sf_dir)
        assert found.count() == 0
        if i < len(corpus_pipeline.STAGES) - 1:
            assert found.columns == docs.columns
