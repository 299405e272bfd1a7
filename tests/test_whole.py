"""Queries over whole tables against plain versions of them."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from confluo import registry

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


def read(spark, name):
    return spark.read.parquet(f"{DATA}/{name}.parquet")


def test_overlap_of_all_rows(spark):
    long = lambda text: {w for w in text.split(" ") if len(w) > 8}
    wanted = set().union(*(long(r["text"]) for r in read(spark, "benchmark").collect()))
    expected = {r["doc_id"] for r in read(spark, "documents").collect() if long(r["text"] or "") & wanted}
    assert expected and {r["doc_id"] for r in registry.queries()["overlap_semi"](spark, DATA).collect()} == expected


def test_fusion_of_all_priorities(spark):
    records = read(spark, "orders").select(F.col("o_custkey").alias("hash"), F.substring("o_orderpriority", 1, 1).cast("int").alias("priority")).distinct()
    got = registry.queries()["spread_in_components"](spark, DATA).select("hash", "priority")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, records.collect()))
    merged = registry.queries()["merge_colliding"](spark, DATA)
    assert {r["short_key"] for r in merged.collect()} == {r["hash"] % 50 for r in records.collect()}


def test_fingerprints_of_all_blocks(spark):
    rows = [(r["vec_id"], r["label"], [x > 0 for x in r["embedding"]]) for r in read(spark, "embeddings").collect()]
    expected = {(a, b) for a, la, x in rows for b, lb, y in rows if a < b and la == lb and sum(p != q for p, q in zip(x, y)) <= 22}
    got = [tuple(r) for r in registry.queries()["fingerprint_band_match"](spark, DATA).collect()]
    assert len(got) == len(expected) and set(got) == expected


def test_clusters_of_short_lines(spark, tmp_path):
    long = "a line that is long enough to make a link of its own"
    texts = ["roses are red\nviolets blue", "roses are red\nviolets blue", "roses are red\nviolets green", f"x\n{long}", f"{long}\ny", "", "", None, None]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    got = dict(map(tuple, registry.queries()["components"](spark, str(tmp_path)).collect()))
    assert got == {0: 0, 1: 0, 2: 2, 3: 3, 4: 3, 5: 5, 6: 5, 7: 7, 8: 8}
    clusters = registry.queries()["duplicate_clusters"](spark, str(tmp_path)).collect()
    assert {r["cluster"]: r["n_members"] for r in clusters} == {0: 2, 2: 1, 3: 2, 5: 2, 7: 1, 8: 1}
