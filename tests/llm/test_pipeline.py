"""The pipeline's stages, one after the other, on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__
import corpus_pipeline
from confluo.llm import queries, simhash, tokens
from confluo.plans.storage import store

DATA = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")
def test_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, seen = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = store(stage(spark, docs, DATA), name)
        assert docs.columns == columns
        seen.append(docs.count())
        if name == "simhash_dedup":
            groups = simhash.simhash_groups(docs)
            assert groups.filter("doc_id <> component_id").count() == 0
    assert seen[1] < seen[0] and seen[2] < seen[1] and seen[3] <= seen[2]
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, DATA).orderBy("start").collect()
    assert len(rows) == seen[4] and rows[0]["start"] == 0
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(rows, rows[1:]))
    assert tokens.TOKENIZER == "byte_bpe_50k.json"


def test_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names and sum(n.startswith("op") and n[2].isdigit() for n in names) == 10


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")
@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    ours, theirs = queries.queries()[name](spark, DATA).toPandas(), con.execute(queries.oracle_sql()[name]).df()
    rows = lambda f: sorted(f[sorted(f.columns)].itertuples(index=False, name=None), key=repr)
    assert rows(ours) == rows(theirs)
