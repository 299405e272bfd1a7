"""Conditional fills and imputation against plain loops over records."""

from __future__ import annotations

import random

from confluo.operators import knowledge

SCHEMA = "hash long, priority int, authors array<string>, publishers array<string>, album string, year int, type string, platform string"
FIELDS = ("authors", "publishers", "album", "year", "type", "platform")


def random_records(seed: int, n: int) -> list[tuple]:
    rng = random.Random(seed)
    pick = lambda values, p=0.35: "" if rng.random() < p else rng.choice(values)
    rows = {}
    for _ in range(n):
        key = (rng.randrange(40), rng.randrange(1, 5))
        author, firm = pick(["ann", "bob", "cid"]), pick(["acme", "omega", "delta Party"])
        year = 0 if rng.random() < 0.4 else rng.randrange(1992, 1995)
        rows[key] = (*key, [author] if author else [], [firm] if firm else [], pick(["alpha", "gamma"]), year, pick(["Game", "Demo", "Compo"]), pick(["Amiga", "PC"]))
    return sorted(rows.values())


def norm(r: dict) -> dict:
    low = lambda xs: sorted({x.lower().replace(" ", "") for x in xs})
    kind = {"": "", "Game": "Game", "Compo": "Compo"}.get(r["type"], "Other")
    return r | {"akey": r["album"], "firms": low(r["publishers"]), "names": low(r["authors"]), "kind": kind}


def plain_fill(held: dict, sources: list[dict], base: list[dict]) -> dict:
    s = dict(held)
    any_ = lambda test: any(test(b) for b in base)
    hit = lambda a, b: bool(set(a) & set(b))
    steady = set()
    for key in {(b["akey"], b["kind"], b["platform"]) for b in base if b["album"] and b["year"] and b["type"] and b["platform"]}:
        mine = [b for b in base if (b["akey"], b["kind"], b["platform"]) == key and b["year"] and b["type"]]
        if len({b["year"] for b in mine}) == 1 and len({tuple(b["firms"]) for b in mine if b["firms"]}) <= 1:
            steady.add((mine[0]["year"], *key))
    trusted = lambda: s["publishers"] and s["type"] != "Compo" and not s["publishers"][0].endswith(" Party")
    yap = lambda y, al, f: any_(lambda b: b["publishers"] and b["album"] and b["year"] and b["year"] == y and b["akey"] == al and hit(b["firms"], f))
    ap = lambda al, f: any_(lambda b: b["publishers"] and b["album"] and b["akey"] == al and hit(b["firms"], f))
    aap = lambda al, f: any_(lambda b: b["authors"] and b["publishers"] and b["album"] and b["akey"] == al and hit(b["firms"], f) and hit(b["names"], s["names"]))
    aay = lambda al, y: any_(lambda b: b["authors"] and b["album"] and b["year"] and b["akey"] == al and b["year"] == y and hit(b["names"], s["names"]))
    ayp = lambda y, f: any_(lambda b: b["authors"] and b["publishers"] and b["year"] and b["year"] == y and hit(b["firms"], f) and hit(b["names"], s["names"]))

    def like(m, f):
        a, b = (s["kind"], m["kind"]) if f == "type" else (s[f], m[f])
        return (a and (not b or a == b)) or (b and (not a or a == b))

    def take(m, *fields):
        for f in fields:
            s[f] = m[f]
        s.update(norm(s))

    def either(m):
        return s["type"] or m["type"], s["platform"] or m["platform"]

    def is_steady(m, year, album):
        t, p = either(m)
        return (year, album, norm({**s, "type": t})["kind"], p) in steady

    def rule(number, m):
        al, y, p = not s["album"], s["year"] == 0, not s["publishers"]
        if number == 1 and y and al and m["year"] and m["album"] and trusted() and yap(m["year"], m["akey"], s["firms"]):
            take(m, "year", "album", "type", "platform")
        elif number == 2 and y and al and m["year"] and m["album"] and p and any_(lambda b: b["year"] == m["year"] and b["akey"] == m["akey"]):
            take(m, "year", "album", "type", "platform")
        elif number == 3 and al and p and m["album"] and m["publishers"] and not y and yap(s["year"], m["akey"], m["firms"]):
            take(m, "album", "publishers", "type", "platform")
        elif number == 4 and al and p and m["album"] and m["publishers"] and y and ap(m["akey"], m["firms"]):
            take(m, "album", "publishers", "type", "platform")
        elif number == 5 and al and m["album"] and not y and trusted() and yap(s["year"], m["akey"], s["firms"]):
            take(m, "album", "type", "platform")
        elif number == 6 and al and m["album"] and y and trusted() and ap(m["akey"], s["firms"]):
            take(m, "album", "type", "platform")
        elif number == 7 and al and m["album"] and p and not y and like(m, "type") and like(m, "platform") and is_steady(m, s["year"], m["akey"]):
            s["type"], s["platform"] = either(m)
            take(m, "album")
        elif number == 8 and p and m["publishers"] and not y and s["album"] and yap(s["year"], s["akey"], m["firms"]):
            take(m, "publishers")
        elif number == 9 and p and m["publishers"] and y and s["album"] and ap(s["akey"], m["firms"]):
            take(m, "publishers")
        elif number == 10 and y and m["year"] and s["album"] and trusted() and yap(m["year"], s["akey"], s["firms"]):
            take(m, "year")
        elif number == 11 and y and m["year"] and s["album"] and p and like(m, "type") and like(m, "platform") and is_steady(m, m["year"], s["akey"]):
            s["type"], s["platform"] = either(m)
            take(m, "year")
        elif number == 12 and al and m["album"] and s["authors"] and not y and trusted() and ayp(s["year"], s["firms"]) and aap(m["akey"], s["firms"]) and aay(m["akey"], s["year"]):
            take(m, "album", "type", "platform")
        elif number == 13 and al and p and m["album"] and not m["publishers"] and s["authors"] and s["year"] == m["year"] and aay(m["akey"], s["year"]):
            take(m, "album", "type", "platform")
        elif number == 14 and al and m["album"] and m["year"] == s["year"] and s["authors"] and trusted() and aap(m["akey"], s["firms"]):
            take(m, "album", "type", "platform")
        elif number == 15 and y and p and al and m["year"] and m["publishers"] and s["authors"] and not m["album"] and ayp(m["year"], m["firms"]):
            take(m, "year", "publishers")
        elif number == 16 and y and al and m["year"] and s["authors"] and not m["album"] and any_(lambda b: not b["album"] and b["year"] == m["year"] and hit(b["names"], s["names"])):
            take(m, "year")
        elif number == 17 and p and al and m["publishers"] and m["year"] == s["year"] and s["authors"] and not m["album"] and any_(lambda b: not b["album"] and hit(b["firms"], m["firms"]) and hit(b["names"], s["names"])):
            take(m, "publishers")

    for number in range(1, 18):
        for m in sources:
            rule(number, m)
    return s


def as_rows(df):
    return sorted((r["hash"], *[list(r[f]) if isinstance(r[f], list) else r[f] for f in FIELDS]) for r in df.collect())


def tables(spark):
    records = random_records(1, 120)
    facts = random_records(2, 60)
    rng = random.Random(3)
    held = {}
    for r in random_records(4, 90):
        held.setdefault(r[0], r)
    held = [(h, 0, *[type(v)() if rng.random() < 0.4 and i != 0 else v for i, v in enumerate(r[2:])]) for h, r in sorted(held.items())]
    return spark.createDataFrame(records, SCHEMA), spark.createDataFrame(facts, SCHEMA), spark.createDataFrame(held, SCHEMA), records, held


def test_conditional_fills(spark):
    sources, facts, held, records, started = tables(spark)
    base = knowledge.knowledge_base(facts)
    plain_base = [norm({f: (list(r[f]) if isinstance(r[f], list) else r[f]) for f in FIELDS}) for r in base.collect()]
    to_dict = lambda r: norm(dict(zip(("hash", "priority", *FIELDS), r, strict=True)))
    expected = []
    for r in started:
        mine = [to_dict(x) for x in records if x[0] == r[0]]
        done = plain_fill(to_dict(r), mine, plain_base)
        expected.append((r[0], *[done[f] for f in FIELDS]))
    got = as_rows(knowledge.fill_conditionally(held, sources, base))
    assert got == sorted(expected)
    assert sum(a != (r[0], *r[2:]) for a, r in zip(got, started, strict=True)) > 5
    assert knowledge.fill_conditionally(held, sources.limit(0), base.limit(0)).count() == len(started)


def plain_maps(base: list[dict]) -> dict:
    out = {}
    for relation in knowledge.RELATIONS:
        groups: dict = {}
        for b in base:
            if b["album"] and all(b[n] for n in relation.needs) and (not relation.games or b["kind"] == "Game"):
                groups.setdefault((b["akey"], *[tuple(b[k]) if isinstance(b[k], list) else b[k] for k in relation.key]), []).append(b)
        told = {}
        for key, rows in groups.items():
            value = lambda b: tuple(b["firms"]) if relation.value == "publishers" else tuple(sorted(set(b["authors"]))) if relation.value == "authors" else b[relation.value]
            if len({value(b) for b in rows}) == 1 and (not relation.steady or len({b["year"] for b in rows}) == 1):
                best = min(rows, key=lambda b: (-sum(map(len, b[relation.value])), b[relation.value]) if isinstance(b[relation.value], list) else 0)
                told[key] = best["kind"] if relation.name == "type_of_platform" else best[relation.value]
        out[relation.name] = told
    return out


def plain_impute(r: dict, maps: dict) -> dict:
    s = dict(r)
    game = s["kind"] == "Game" and (not s["publishers"] or any(p != "acme" for p in s["publishers"]))
    if not s["platform"]:
        s["platform"] = "Amiga" if "OctaMED" in r["formats"] else ""
    al = s["album"]
    firms = tuple(s["firms"])
    if not s["platform"] and al and s["type"]:
        s["platform"] = maps["platform_of_type"].get((al, s["kind"]), "")
    if not s["platform"] and al:
        s["platform"] = maps["platform"].get((al,), "")
    if not s["type"] and al and s["platform"]:
        s["type"] = maps["type_of_platform"].get((al, s["platform"]), "")
    if not s["type"] and al:
        s["type"] = maps["type"].get((al,), "")
    kind = norm(s)["kind"]
    both = s["type"] and s["platform"]
    if not s["year"] and al and (s["type"] or s["platform"]):
        y = maps["year"].get((al, kind, s["platform"]), 0) if both else 0
        if not y and s["type"] and game:
            y = maps["year_of_game"].get((al,), 0)
        if y and both:
            theirs = {p.lower().replace(" ", "") for p in maps["publishers"].get((al, kind, s["platform"], y), [])}
            if firms and theirs and not theirs & set(firms):
                y = 0
        s["year"] = y
    if not s["year"] and al and both and s["publishers"]:
        s["year"] = maps["year_of_firms"].get((al, kind, s["platform"], firms), 0)
    if not s["publishers"] and s["year"] and al and both:
        s["publishers"] = maps["publishers"].get((al, kind, s["platform"], s["year"]), [])
    firms = tuple(norm(s)["firms"])
    if not s["authors"] and al and s["publishers"] and both:
        s["authors"] = maps["authors_of_firms"].get((al, firms, s["platform"], kind), [])
    if not s["authors"] and al and s["year"] and both:
        s["authors"] = maps["authors_of_year"].get((al, s["year"], s["platform"], kind), [])
    return s


def test_imputation(spark):
    from pyspark.sql import functions as F

    _, facts, held, _, started = tables(spark)
    base = knowledge.knowledge_base(facts)
    plain_base = [norm({f: (list(r[f]) if isinstance(r[f], list) else r[f]) for f in FIELDS}) for r in base.collect()]
    maps = plain_maps(plain_base)
    formats = F.when(F.col("hash") % 5 == 0, F.array(F.lit("OctaMED"))).otherwise(F.array(F.lit("ProTracker")))
    rows = held.withColumn("formats", formats).withColumn("players", F.array(F.lit("uade")))
    expected = []
    for r in started:
        one = norm(dict(zip(("hash", "priority", *FIELDS), r, strict=True))) | {"formats": ["OctaMED" if r[0] % 5 == 0 else "ProTracker"]}
        done = plain_impute(one, maps)
        expected.append((r[0], *[done[f] for f in FIELDS]))
    got = as_rows(knowledge.impute(rows, base, scene=["acme"]))
    assert got == sorted(expected)
    assert sum(a != (r[0], *r[2:]) for a, r in zip(got, started, strict=True)) > 5


def test_platform_of_formats(spark):
    from pyspark.sql import functions as F

    cases = [(["ProTracker"], ["uade"], ""), (["OctaMED Pro"], [""], "Amiga"), (["YM2149"], ["uade"], "Atari"), (["XM"], ["libxmp"], "PC"), (["XM"], [""], ""), (["Foo"], ["uade"], "Amiga"), (["TFMX"], ["uade"], ""), ([], [], "")]
    df = spark.createDataFrame(cases, "f array<string>, p array<string>, x string")
    assert all(r["x"] == r["y"] for r in df.select("x", knowledge.platform_of_formats(F.col("f"), F.col("p")).alias("y")).collect())


def test_simple_key_is_asked_second(spark):
    facts = spark.createDataFrame([(1, 1, ["ann"], ["acme"], "My (x) Al.pha", 1993, "Demo", "PC")], SCHEMA)
    held = spark.createDataFrame([(7, 0, [], [], "my alpha", 0, "", "")], SCHEMA)
    from pyspark.sql import functions as F

    none = F.array().cast("array<string>")
    got = knowledge.impute(held.withColumn("formats", none).withColumn("players", none), knowledge.knowledge_base(facts)).collect()
    assert [(r["publishers"], r["year"], r["type"], r["platform"], r["authors"]) for r in got] == [(["acme"], 1993, "Other", "PC", ["ann"])]


def plain_pass(rows: list[dict], facts: list[dict]) -> list[dict]:
    every = [norm(r) for r in rows] + [norm(f) for f in facts]
    out = []
    for r in map(norm, rows):
        s = dict(r)
        if r["album"] and (not r["publishers"] or not r["year"]):
            peers = [p for p in every if p["album"] and p["publishers"] and p["akey"] == r["akey"] and (not r["year"] or abs(p["year"] - r["year"]) <= 1) and (p["kind"] == "Game") == (r["kind"] == "Game")]
            tests = [
                lambda p: p["year"] != 0 if not r["year"] else p["year"] != 0 and (p["year"] == r["year"] or bool(r["firms"])),
                lambda p: p["platform"] == r["platform"], lambda p: p["kind"] == r["kind"], lambda p: bool(set(p["firms"]) & set(r["firms"])), lambda p: True,
                lambda p: not p["names"] or not r["names"] or bool(set(p["names"]) & set(r["names"])),
            ]
            for test in tests:
                peers = [p for p in peers if test(p)] or peers
            if not r["publishers"] and len({tuple(p["firms"]) for p in peers}) == 1:
                s["publishers"] = min(p["publishers"] for p in peers)
            if not r["year"] and len({p["year"] for p in peers if p["year"]}) == 1:
                s["year"] = next(p["year"] for p in peers if p["year"])
        out.append(s)
    rows = [norm(s) for s in out]
    every = rows + [norm(f) for f in facts]
    whole = lambda p: p["album"] and p["publishers"] and p["year"] and p["type"] and p["platform"]
    key = lambda p: (p["akey"], tuple(p["firms"]), p["year"], p["kind"], p["platform"])
    done = []
    for r in rows:
        told = {tuple(sorted(p["authors"])) for p in every if whole(p) and p["authors"] and key(p) == key(r)}
        done.append(norm(r | {"authors": list(told.pop())}) if not r["authors"] and whole(r) and len(told) == 1 else r)
    maps = plain_maps(done + [norm(f) for f in facts])
    for r in done:
        if not r["type"] and r["album"]:
            r["type"] = maps["type_of_platform"].get((r["akey"], r["platform"]), "")
        r.update(norm(r))
        if not r["platform"] and r["album"]:
            r["platform"] = maps["platform_of_type"].get((r["akey"], r["kind"]), "")
    return done


def test_final_passes(spark):
    _, facts, held, _, started = tables(spark)
    base = knowledge.knowledge_base(facts)
    plain = [{f: (list(r[f]) if isinstance(r[f], list) else r[f]) for f in FIELDS} for r in base.collect()]
    rows = [dict(zip(("hash", "priority", *FIELDS), r, strict=True)) for r in started]
    for _ in range(2):
        rows = [{k: s[k] for k in ("hash", "priority", *FIELDS)} for s in plain_pass(rows, plain)]
    got = as_rows(knowledge.final_passes(held, base))
    assert got == sorted((r["hash"], *[r[f] for f in FIELDS]) for r in rows)
    assert sum(a != (r[0], *r[2:]) for a, r in zip(got, started, strict=True)) > 5


def test_hashes_keep_what_they_ask_for(spark):
    """What goes along with a hash doesn't grow with what the base has of its albums and names."""
    facts = spark.createDataFrame([(i, 0, ["Ann"], [f"Firm{i % 50}"], "Album", 1990 + i % 40, "Game", "PC") for i in range(2000)], SCHEMA)
    held = spark.createDataFrame([(1, 0, ["Ann"], ["Firm7"], "Album", 1997, "", "")], SCHEMA)
    known = knowledge._told(knowledge.knowledge_base(facts))
    assert max(len(r["tokens"]) for r in known.collect()) > 200
    rows = knowledge.keyed(held).selectExpr("*", f"cast(array() as array<{knowledge._RECORD_TYPE}>) as __all")
    kept = knowledge._kept_of_hashes(rows, known).first()["__known"]
    assert sorted(len(k["tokens"]) for k in kept) == [1, 5] and all(len(k["steady"]) <= 1 for k in kept)
