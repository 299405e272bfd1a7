"""Near copies, which the pipeline is to remove."""

from __future__ import annotations

import random
from itertools import combinations

import pytest

import corpus_pipeline
from confluo.llm import nearcopies, simhash


def brute_jaccard(a: str, b: str) -> float:
    x, y = ({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in (a.lower().split(), b.lower().split()))
    return len(x & y) / len(x | y) if x and y else 0.0


@pytest.fixture(scope="module")
def edited() -> dict[int, str]:
    """60 texts, of most an edited copy, and a family of 30 copies of one text."""
    rng = random.Random(4)
    words = [f"w{i}" for i in range(800)]
    made = {}
    for i in range(60):
        own = [rng.choice(words) for _ in range(rng.randint(60, 300))]
        made[i] = " ".join(own)
        for _ in range(i % 4 + i % 3):
            own[rng.randrange(len(own))] = "Other"
        made[100 + i] = " ".join(own)
    base = [rng.choice(words) for _ in range(400)]
    for i in range(30):
        own = list(base)
        for _ in range(rng.randint(0, 9)):
            own[rng.randrange(400)] = rng.choice(words)
        made[200 + i] = " ".join(own)
    return made | {300: "", 301: " \n", 302: "", 303: "three short words", 304: "Three short  words", 305: "three short lines"}


@pytest.mark.parametrize("pairs_per_key", [nearcopies.PAIRS_PER_KEY, 0])
def test_links_against_brute_force(spark, edited, monkeypatch, pairs_per_key):
    monkeypatch.setattr(nearcopies, "PAIRS_PER_KEY", pairs_per_key)  # all pairs at once, or round by round
    table = spark.createDataFrame([*edited.items(), (None, edited[0]), (400, None)], "doc_id long, text string")
    expected = {(a, b) for a, b in combinations(sorted(edited), 2) if brute_jaccard(edited[a], edited[b]) >= 0.8}
    got = {tuple(r) for r in nearcopies.near_copies(table).collect()}
    assert len(expected) > 200 and got <= expected  # nothing but near copies
    gone = {b for _, b in got}
    assert not [p for p in expected if not set(p) & gone]  # and no two of them stay
    assert nearcopies.near_copies(table.limit(0)).count() == 0


def test_stage_drops_edited_copies(spark, edited):
    rows = [(i, t, "en", "s", len(t)) for i, t in edited.items()]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    far = [(a, b) for a, b in combinations(sorted(edited), 2) if brute_jaccard(edited[a], edited[b]) >= 0.8
           and (simhash.fingerprint(edited[a].encode()) ^ simhash.fingerprint(edited[b].encode())).bit_count() > 4]
    kept = corpus_pipeline.simhash_dedup(spark, table, "")
    assert kept.columns == table.columns
    ids = {r["doc_id"] for r in kept.collect()}
    assert len(far) > 20 and not [p for p in far if set(p) <= ids]
    alone = {i for i in range(60) if brute_jaccard(edited[i], edited[100 + i]) < 0.8}
    assert set(range(60)) <= ids and {100 + i for i in alone} <= ids
