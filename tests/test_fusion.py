"""The fold over sources against a plain loop over all passes, and edge cases of the fusion operators."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from confluo.operators import fusion, graph, ordered

SCHEMA = "hash long, priority int, authors array<string>, publishers array<string>, album string, year int, type string, platform string"
LISTED = [("a1", True, "Amiga", 1992), ("a1", False, "", 0), ("a2", True, "", 0)]
SCENE = ["p2"]


def facts(r):
    return bool(r["publishers"] or r["album"] or r["year"])


def score(r, least):
    kind, platform = r["type"].lower(), r["platform"].lower()
    points = 10 * bool(r["publishers"] or kind == "tool") + 1000 * bool(r["album"] or kind == "compo") + 10000 * (r["year"] > 0)
    return points + (platform == "amiga" or kind == "compo") + (kind == "game") + (0 < r["year"] <= least)


def one_pass(held, seen):
    known = [r for r in seen if facts(r)]
    least = min((r["year"] for r in known if r["year"]), default=0)
    near = [r for r in known if not least or r["year"] <= least + (2 if r["type"].lower() == "compo" else 1)]
    if not near:
        return held
    pick = max(near, key=lambda r: score(r, least))  # the first of equals
    if held is None:
        return pick
    gained, had = score(pick, least), score(held, least)
    game = held["type"].lower() == "game" and not set(held["publishers"]) & set(SCENE)
    if facts(held):
        if gained < had and (not pick["year"] or pick["year"] >= held["year"] - 1):
            return held
        if gained == had and (not pick["year"] or pick["year"] >= held["year"] - game):
            return held
        if gained > had and held["year"] and held["year"] + 1 < pick["year"]:
            return held
    if held["album"] and not pick["album"]:
        same = all(not held[f] or not pick[f] or str(held[f]).lower() == str(pick[f]).lower() for f in ("year", "type", "platform"))
        same = same and (not held["publishers"] or not pick["publishers"] or bool(set(held["publishers"]) & set(pick["publishers"])))
        is_listed = any(
            a == held["album"] and g == (held["type"].lower() == "game") and (not p or not held["platform"] or p.lower() == held["platform"].lower()) and y in (0, pick["year"])
            for a, g, p, y in LISTED
        )
        if same and (not (held["type"] and pick["year"] and not held["year"]) or is_listed):
            return {**pick, **{f: held[f] for f in ("publishers", "album", "type", "platform")}}
    return pick


def test_fold_equals_all_passes(spark):
    rng = random.Random(5)
    rows = []
    for h in range(400):
        for p in rng.sample(range(1, 7), rng.randint(1, 6)):
            rows.append((h, p, rng.choice([[], ["x"], ["y", "z"]]), rng.choice([[], [], ["p1"], ["p2"], ["p1", "p2"]]), rng.choice(["", "", "a1", "a2"]),
                         rng.choice([0, 0, 1990, 1991, 1992, 1995]), rng.choice(["", "Game", "Compo", "Tool"]), rng.choice(["", "Amiga", "Atari"])))
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    records = [dict(zip(names, r, strict=True)) for r in rows]
    wanted = {}
    for h in range(400):
        mine = sorted((r for r in records if r["hash"] == h), key=lambda r: r["priority"])
        held = None
        for k in range(1, 7):  # every pass, new sources or not
            held = one_pass(held, [r for r in mine if r["priority"] <= k])
        held = held or {"publishers": [], "album": "", "year": 0, "type": "", "platform": ""}
        authors = next((r["authors"] for r in mine if r["authors"]), [])
        wanted[h] = (authors, *(held[f] for f in fusion.FIELDS[1:]))
    listed = spark.createDataFrame(LISTED, "album string, game boolean, platform string, year int")
    got = fusion.fuse_sources(spark.createDataFrame(rows, SCHEMA), listed, SCENE).collect()
    assert {r["hash"]: tuple(r[f] for f in fusion.FIELDS) for r in got} == wanted


def test_nulls_repeats_and_empty_tables(spark):
    blank = (1, 1, None, None, None, None, None, None)
    rows = spark.createDataFrame([blank, blank, (None, 1, ["a"], [], "x", 1990, "", "")], SCHEMA)
    assert [tuple(r) for r in fusion.fuse_sources(rows).collect()] == [(1, [], [], "", 0, "", "")]
    empty = spark.createDataFrame([], SCHEMA)
    assert fusion.fuse_sources(empty).count() == 0
    assert fusion.spread(empty.withColumn("component", F.lit(1))).count() == 0
    assert fusion.merge_colliding(empty, "hash").count() == 0
    alone = fusion.spread(rows.withColumn("component", F.lit(None).cast("long")))
    assert alone.count() == 3 and alone.filter("album = 'x'").count() == 1
    sets = spark.createDataFrame([("k", ["b", "a"]), ("k", ["a", "b", "b"]), ("m", ["a"]), ("m", None), ("n", ["a"]), ("n", ["c"])], "k string, v array<string>")
    assert {r["k"]: r["v"] for r in fusion.set_dependency_map(sets, ["k"], "v").collect()} == {"k": ["a", "b", "b"], "m": ["a"]}


def test_compatible_sets(spark):
    rows = [("g", 1, ["a", "b"]), ("g", 2, ["b", "c"]), ("h", 3, ["a"]), ("h", 4, ["c"]), ("h", 5, None)]
    df = spark.createDataFrame(rows, "g string, i long, v array<string>")
    assert {r["g"]: (r["sets"], r["components"]) for r in graph.linked_groups(df, "g", "i", "v").collect()} == {"g": (2, 1), "h": (2, 2)}


def test_too_deep_a_tree_is_an_error(spark):
    df = spark.createDataFrame([(1, 1, "a"), (2, 2, "b")], "n int, d int, name string").withColumn("k", F.lit(0))
    assert [r["path"] for r in ordered.path_stack(df, ["k"], [F.col("n")], "d", "name", 2).orderBy("n").collect()] == ["a", "a/b"]
    try:
        ordered.path_stack(df, ["k"], [F.col("n")], "d", "name", 1).collect()
    except Exception as error:
        assert "depth over the limit" in str(error)
    else:
        raise AssertionError("no error")
