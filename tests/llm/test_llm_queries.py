"""Registered queries against their SQL, and the pipeline."""

import sys
from pathlib import Path

import duckdb
import pytest

from fieldbook.llm import queries
from fieldbook.session import stage

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
import corpus_pipeline  # noqa: E402


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_matches_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    found = con.execute(queries.ORACLE[name])
    names = [d[0] for d in found.description]
    want = sorted(map(str, found.fetchall()))
    df = queries.QUERIES[name](spark, sf_dir)
    assert sorted(df.columns) == sorted(names)
    assert sorted(str(tuple(r)) for r in df.select(*names).collect()) == want


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, ids = docs.columns, {r[0] for r in docs.select("doc_id").collect()}
    for name, step in corpus_pipeline.STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
        assert docs.columns == columns
        left = {r[0] for r in docs.select("doc_id").collect()}
        assert left <= ids and docs.count() == len(left)
        if name == "language_id":
            assert len(left) >= 0.97 * len(ids)
        if name == "line_dedup":
            assert left == ids
        ids = left
    out = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert {r["doc_id"] for r in out.collect()} == ids


def test_stages_take_empty_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, step in corpus_pipeline.STAGES:
        assert step(spark, docs, sf_dir).collect() == []
