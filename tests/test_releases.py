"""The release that dates a thing, against a plain loop."""

from __future__ import annotations

import random

from confluo.operators.releases import choose_release

SCHEMA = "key int, id int, has_authors boolean, has_prod boolean, mod_date string, mod_precision int, prod_date string, prod_precision int, party_date string, party_precision int"
NEVER = "9999-99-99"


def plain(rows: list[dict]) -> tuple:
    rows = [r for r in rows if r["has_authors"]] or rows
    rows = [r for r in rows if r["prod_date"] or r["party_date"]] or rows
    made = lambda r: min(r["prod_date"] or NEVER, r["party_date"] or NEVER)
    order = [r["mod_date"] for r in rows]
    first = made if len(set(order)) == 1 else lambda r: min(made(r), r["mod_date"] or NEVER)
    tie = lambda r: (r["id"],)
    ordered = sorted(rows, key=lambda r: (first(r), tie(r)))
    early = min(min(made(r), r["mod_date"] or NEVER) for r in rows)
    best = None

    def weak(r, d):
        return r[d + "_date"] != "" and r[d + "_date"] <= early

    def strong(r, d):
        return weak(r, d) and r["mod_precision"] == r[d + "_precision"]

    def exact(r, d, held):
        day = any(x and x["party_date"] and x["party_precision"] == 3 for x in (r, held))
        n = {1: 4, 2: 7}.get(r["mod_precision"], 10 if day else 7)
        return r[d + "_date"] != "" and r[d + "_date"] == r["mod_date"] and r["mod_precision"] == r[d + "_precision"] and r[d + "_date"][:n] <= early[:n]

    if len(ordered) == 1:
        best = ordered[0]
    else:
        for r in ordered:
            sure = strong(r, "prod") or strong(r, "party") or exact(r, "prod", best)
            if best is None:
                if sure or exact(r, "party", best) or weak(r, "prod") or weak(r, "party"):
                    best = r
            elif sure and not (strong(best, "prod") or strong(best, "party") or exact(best, "prod", best) or exact(best, "party", best)):
                best = r
    if best is None:
        best = next((r for r in sorted(rows, key=lambda r: (made(r), tie(r))) if r["has_prod"] or r["party_date"]), None)
    if best is None:
        best = min(rows, key=lambda r: (r["mod_date"], tie(r)))
    return best["id"], *[best[d + "_date"].replace("-99", "-01") for d in ("mod", "prod", "party")], sum(r["has_prod"] for r in rows)


def test_choose_release(spark):
    rng = random.Random(3)

    def date():
        precision = rng.choice([0, 1, 2, 3])
        y, m, d = rng.choice([1992, 1993]), rng.choice([3, 7]), rng.choice([1, 20])
        return (["", f"{y}-99-99", f"{y}-{m:02}-99", f"{y}-{m:02}-{d:02}"][precision], precision)

    rows = [(k, i, rng.random() < 0.7, rng.random() < 0.5, *date(), *date(), *date()) for k in range(400) for i in range(rng.randint(1, 4))]
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    expected = []
    for k in range(400):
        expected.append((k, *plain([dict(zip(names, r, strict=True)) for r in rows if r[0] == k])))
    df = spark.createDataFrame([*rows, (None, 1, True, True, "", 0, "", 0, "", 0), rows[0]], SCHEMA)
    assert sorted(map(tuple, choose_release(df, "key").collect())) == expected
    assert choose_release(df.limit(0), "key").count() == 0
