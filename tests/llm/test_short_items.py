"""Whole benchmark items that are shorter than a window."""

from __future__ import annotations

import corpus_pipeline
from confluo.llm import decontaminate


def test_short_item_is_cut_out(spark):
    bench = spark.createDataFrame([(1, "what is the tallest hill of the island"), (2, " ".join(f"w{i}" for i in range(14)))], "item_id long, text string")
    filler = " ".join(f"f{i}" for i in range(120))
    docs = spark.createDataFrame([(1, f"{filler} What is the tallest hill of the island? {filler}"), (2, filler), (3, "what is the tallest hill of the island")], "doc_id long, text string")
    kept = {r["doc_id"]: r["text"] for r in corpus_pipeline.decontaminate(docs, bench, max_coverage=corpus_pipeline.MAX_COVERAGE).collect()}
    assert kept == {1: f"{filler} ? {filler}", 2: filler}
    assert decontaminate.find_leaks(spark.createDataFrame(list(kept.items()), docs.schema), bench).filter("size(hits) > 0").count() == 0
