"""Fusing the records that several ranked sources give for one hash, filling gaps from peers, spreading along components.

A record has hash, priority (int, 1 first), authors and publishers (arrays of strings), album, type, platform (strings,
"" unknown) and year (int, 0 unknown).  Nulls count as unknown.  A hash's records meet once, as an array with at most one
entry per source, and the passes over more and more sources are a fold over that array: one shuffle however many passes.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FIELDS = ("authors", "publishers", "album", "year", "type", "platform")


def _filled(df: DataFrame) -> DataFrame:
    """``df`` with unknown fields as empty values."""
    none = {"authors": F.array().cast("array<string>"), "publishers": F.array().cast("array<string>"), "year": F.lit(0)}
    return df.select(*[F.coalesce(c, none.get(c, F.lit(""))).alias(c) if c in FIELDS else F.col(f"`{c}`") for c in df.columns])


def _is(record: Column, field: str, value: str) -> Column:
    return F.lower(record[field]) == value


def has_facts(record: Column) -> Column:
    """Whether anything but authors is known."""
    return (F.size(record["publishers"]) > 0) | (record["album"] != "") | (record["year"] != 0)


def field_score(record: Column, least_year: Column) -> Column:
    """How much a record tells: year over album over publishers, then platform, kind and an early year."""
    compo = _is(record, "type", "compo")

    def worth(test: Column, points: int) -> Column:
        return F.when(test, points).otherwise(0)

    return (
        worth((F.size(record["publishers"]) > 0) | _is(record, "type", "tool"), 10)
        + worth((record["album"] != "") | compo, 1000)
        + worth(record["year"] > 0, 10000)
        + worth(_is(record, "platform", "amiga") | compo, 1)
        + worth(_is(record, "type", "game"), 1)
        + worth((record["year"] > 0) & (record["year"] <= least_year), 1)
    )


def least_year(records: Column) -> Column:
    """The least known year of an array of records that tell anything, or 0."""
    years = F.transform(F.filter(records, lambda r: has_facts(r) & (r["year"] > 0)), lambda r: r["year"])
    return F.coalesce(F.array_min(years), F.lit(0))


def best_of(records: Column, least: Column) -> Column:
    """Of an array of records in order of their sources, (score, record) of the best near the least year; null if none."""

    def near(r: Column) -> Column:
        late = F.when(_is(r, "type", "compo"), 2).otherwise(1)
        return has_facts(r) & ((least == 0) | (r["year"] <= least + late))

    ranked = F.transform(F.filter(records, near), lambda r, i: F.struct((-field_score(r, least)).alias("cost"), i.alias("i"), r.alias("record")))
    return F.array_min(ranked)


def _agree(a: Column, b: Column, field: str, none: str | int = "") -> Column:
    return (a[field] == F.lit(none)) | (b[field] == F.lit(none)) | (F.lower(a[field].cast("string")) == F.lower(b[field].cast("string")))


def _with(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _next(held: Column, seen: Column, scene: Column) -> Column:
    """The record after a pass: the held one, the best of the sources seen so far, or that with the held one's album."""
    return _with(least_year(seen), lambda least: _with(best_of(seen, least), lambda best: _choice(held, best, least, scene)))


def _choice(held: Column, best: Column, least: Column, scene: Column) -> Column:
    pick, gained, had = best["record"], -best["cost"], field_score(held, least)
    vague = pick["year"] == 0
    plain_game = _is(held, "type", "game") & ~F.arrays_overlap(held["publishers"], scene)
    slack = F.when(plain_game, 1).otherwise(0)
    stays = has_facts(held) & (
        best.isNull()
        | ((gained < had) & (vague | (pick["year"] >= held["year"] - 1)))
        | ((gained == had) & (vague | (pick["year"] >= held["year"] - slack)))
        | ((gained > had) & (held["year"] != 0) & (held["year"] + 1 < pick["year"]))
    )
    publishers_meet = (F.size(held["publishers"]) == 0) | (F.size(pick["publishers"]) == 0) | F.arrays_overlap(held["publishers"], pick["publishers"])
    dated_only_now = (held["type"] != "") & (pick["year"] > 0) & (held["year"] == 0)
    listed = F.exists(
        F.coalesce(held["listed"], F.array().cast("array<struct<platform:string,year:int>>")),
        lambda g: ((g["platform"] == "") | (held["platform"] == "") | (F.lower(g["platform"]) == F.lower(held["platform"]))) & ((g["year"] == 0) | (g["year"] == pick["year"])),
    )
    keeps_album = (
        (held["album"] != "") & (pick["album"] == "")
        & _agree(held, pick, "year", 0) & _agree(held, pick, "type") & _agree(held, pick, "platform") & publishers_meet
        & (~dated_only_now | listed)
    )
    merged = pick
    for field in ("publishers", "album", "type", "platform", "listed"):
        merged = merged.withField(field, held[field])
    return F.when(F.coalesce(stays, F.lit(False)) | best.isNull(), held).when(keeps_album, merged).otherwise(pick)


def fuse_sources(records: DataFrame, listed: DataFrame | None = None, scene_groups: Sequence[str] = ()) -> DataFrame:
    """(hash, authors, publishers, album, year, type, platform): one fused record for every hash.

    Pass k sees the sources of priority 1 to k; a pass in which a hash has no new source leaves it as it is, so only the
    hash's own sources are folded.  Of equal (hash, priority) the least record counts.  Authors come from the first source
    that has any.  ``listed`` (album, game boolean, platform, year) tells which years are known of an album; its entries per
    album are distinct platforms and years.  Null hashes are dropped; an empty table gives an empty table.
    """
    rows = _filled(records.select("hash", "priority", *FIELDS)).filter("hash is not null and priority is not null")
    rows = rows.groupBy("hash", "priority").agg(F.min(F.struct(*FIELDS)).alias("r")).select("hash", "priority", "r.*")
    kinds = "array<struct<platform:string,year:int>>"
    if listed is None:
        rows = rows.withColumn("listed", F.lit(None).cast(kinds))
    else:
        known = listed.groupBy(F.col("album").alias("__album"), F.col("game").alias("__game")).agg(
            F.array_sort(F.collect_set(F.struct(F.coalesce("platform", F.lit("")).alias("platform"), F.coalesce("year", F.lit(0)).cast("int").alias("year")))).cast(kinds).alias("listed"))
        rows = rows.join(known, (F.col("album") == F.col("__album")) & ((F.lower("type") == "game") == F.col("__game")), "left").drop("__album", "__game")
    entry = F.struct(F.col("priority").cast("int").alias("priority"), *FIELDS[:3], F.col("year").cast("int").alias("year"), *FIELDS[4:], "listed")
    gathered = rows.groupBy("hash").agg(F.array_sort(F.collect_list(entry)).alias("all"))
    scene = F.array(*[F.lit(g) for g in scene_groups]).cast("array<string>")
    blank = F.struct(
        F.lit(0).alias("priority"), F.array().cast("array<string>").alias("authors"), F.array().cast("array<string>").alias("publishers"),
        F.lit("").alias("album"), F.lit(0).alias("year"), F.lit("").alias("type"), F.lit("").alias("platform"), F.lit(None).cast(kinds).alias("listed"),
    )
    passes = F.sequence(F.lit(1), F.size("all"))
    held = F.aggregate(passes, blank, lambda held, k: _next(held, F.slice("all", F.lit(1), k), scene))
    named = F.filter("all", lambda r: F.size(r["authors"]) > 0)
    fused = gathered.select("hash", held.alias("h"), F.get(F.transform(named, lambda r: r["authors"]), F.lit(0)).alias("a"))
    return fused.select("hash", F.coalesce("a", F.array().cast("array<string>")).alias("authors"), *[F.col(f"h.{f}").alias(f) for f in FIELDS[1:]])


def fill_from_peers(targets: DataFrame, peers: DataFrame, key: Sequence[str], narrow: Sequence[str], soft: Sequence[str] = ()) -> DataFrame:
    """``targets`` with unknown ``publisher`` ("") and ``year`` (0) taken from peers that share ``key``.

    For each of ``narrow`` ("" unknown) a target's peers are those that equal it, else those without it; for each of
    ``soft`` those that equal it if there are any.  The publisher is the peers' most frequent, ties to the smallest; the
    year their most frequent, ties to the least, and only if no peer's known year differs.  Votes are counted per distinct
    peer and met by distinct targets only, so a key that very many rows share costs its distinct kinds, not their product.
    """
    kind = [*key, *narrow, *soft]
    needy = targets.filter("publisher = '' or year = 0").select(*kind).distinct().select(*[F.col(c).alias(f"__{c}") for c in kind])
    votes = peers.filter("publisher <> '' or year <> 0").groupBy(*kind, "publisher", "year").agg(F.count("*").alias("n"))
    met = needy.join(votes, reduce(lambda a, b: a & b, [F.col(f"__{c}") == F.col(c) for c in key]))
    w = Window.partitionBy(*[f"__{c}" for c in kind])
    for c in (*narrow, *soft):
        same, mine = F.col(c) == F.col(f"__{c}"), F.col(f"__{c}")
        met = met.withColumn("__any", F.max(same).over(w))
        rest = F.lit(True) if c in soft else (F.col(c) == "") | (mine == "")
        met = met.filter(F.when(F.col("__any") & ((mine != "") | F.lit(c in soft)), same).otherwise(rest)).drop("__any")
    mine = [f"__{c}" for c in kind]

    def most(value: str, unknown: Column) -> DataFrame:
        n = met.filter(F.col(value) != unknown).groupBy(*mine, value).agg(F.sum("n").alias("n"))
        top = n.groupBy(*mine).agg(F.min(F.struct((-F.col("n")).alias("n"), F.col(value).alias("v"))).alias("t"), F.count("*").alias("kinds"))
        return top.select(*mine, F.col("t.v").alias(f"__most_{value}"), F.col("kinds").alias(f"__kinds_{value}"))

    found = most("publisher", F.lit("")).join(most("year", F.lit(0)), mine, "full")
    on = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"__{c}") for c in kind])
    publisher = F.when(F.col("publisher") == "", F.coalesce("__most_publisher", F.lit(""))).otherwise(F.col("publisher"))
    year = F.when((F.col("year") == 0) & (F.col("__kinds_year") == 1), F.col("__most_year")).otherwise(F.col("year"))
    return targets.join(found, on, "left").select(*[publisher.alias(c) if c == "publisher" else year.alias(c) if c == "year" else F.col(c) for c in targets.columns])


def spread(records: DataFrame, group: str = "component") -> DataFrame:
    """``records`` (one per hash, with ``group``) where a group's best record replaces those that tell less or later.

    If a year is known in a group only records at most a year over the least (two for a competition) are candidates.
    Best: score, least year, most authors, most publishers, the most frequent (publishers, album), lowest priority, hash.
    Every step is an aggregate of the group, combined map-side, so no group is gathered.  Null groups are left as they are.
    """
    rows = _filled(records)
    r = F.struct(*FIELDS)
    least = rows.filter(F.col(group).isNotNull()).groupBy(group).agg(F.coalesce(F.min(F.when(F.col("year") > 0, F.col("year"))), F.lit(0)).alias("__least"))
    scored = rows.join(least, group).withColumn("__r", r)
    late = F.when(F.lower("type") == "compo", 2).otherwise(1)
    scored = scored.withColumn("__score", field_score(F.col("__r"), F.col("__least")) + F.when(F.size("authors") > 0, 1).otherwise(0))
    able = scored.filter(has_facts(F.col("__r")) & ((F.col("__least") == 0) | ((F.col("year") > 0) & (F.col("year") <= F.col("__least") + late))))
    rank = F.struct((-F.col("__score")).alias("s"), F.when(F.col("year") == 0, 9999).otherwise(F.col("year")).alias("y"), (-F.size("authors")).alias("a"), (-F.size("publishers")).alias("p"))
    ranked = able.withColumn("__rank", rank)
    top = ranked.groupBy(group).agg(F.min("__rank").alias("__top"))
    votes = (
        ranked.join(top, group).filter("__rank = __top").groupBy(group, "__top", "publishers", "album")
        .agg(F.count("*").alias("n"), F.min(F.struct("priority", "hash", "__r")).alias("first"))
    )
    best = votes.groupBy(group).agg(F.min(F.struct((-F.col("n")).alias("n"), F.col("first.priority").alias("p"), F.col("first.hash").alias("h"), "first", "__top")).alias("b"))
    given = best.select(F.col(group).alias("__g"), F.col("b.first.__r").alias("__best"), (-F.col("b.__top.s")).alias("__gain"))
    mine = rows.withColumn("__r", r).join(least.withColumnRenamed(group, "__lg"), F.col(group) == F.col("__lg"), "left").join(given, F.col(group) == F.col("__g"), "left")
    own = field_score(F.col("__r"), F.coalesce("__least", F.lit(0))) + F.when(F.size("authors") > 0, 1).otherwise(0)
    earlier = (F.col("__best.year") > 0) & (F.col("__best.year") < F.col("year"))
    taken = F.coalesce(F.col("__best").isNotNull() & (~has_facts(F.col("__r")) | (F.col("__gain") > own) | ((F.col("__gain") == own) & earlier)), F.lit(False))

    def value(field: str) -> Column:
        theirs, ours = F.col(f"__best.{field}"), F.col(field)
        if field == "authors":  # authors of one's own stay
            return F.when(taken & (F.size(ours) == 0), theirs).otherwise(ours)
        return F.when(taken, theirs).otherwise(ours)

    return mine.select(*[value(c).alias(c) if c in FIELDS else F.col(c) for c in records.columns])


def merge_colliding(records: DataFrame, key: str) -> DataFrame:
    """One record for each ``key`` that hashes collide on: least known year, then most authors, then the smallest hash.

    A record without authors borrows those of the collision's longest list.
    """
    rows = _filled(records)
    year = F.when(F.col("year") > 0, F.col("year")).otherwise(9999)
    best = F.min(F.struct(year.alias("y"), (-F.size("authors")).alias("n"), F.col("hash").alias("h"), *FIELDS)).alias("b")
    longest = F.min(F.struct((-F.size("authors")).alias("n"), F.col("hash").alias("h"), "authors")).alias("l")
    merged = rows.groupBy(key).agg(best, longest)
    authors = F.when(F.size("b.authors") > 0, F.col("b.authors")).otherwise(F.col("l.authors"))
    return merged.select(key, F.col("b.h").alias("hash"), authors.alias("authors"), *[F.col(f"b.{f}").alias(f) for f in FIELDS[1:]])


def originals_and_variants(records: DataFrame, key: Sequence[str], variant: Column, year: str, order: str) -> DataFrame:
    """One record per key of originals, and one per key of variants unless an original makes it redundant.

    A variant goes if its key has an original with a known year, or has one at all while no variant's year is known.
    The earliest known year stands for a key, ties by ``order``.
    """
    rows = records.withColumn("__variant", F.coalesce(variant, F.lit(False)))
    rank = F.struct(F.when(F.col(year) > 0, F.col(year)).otherwise(9999).alias("y"), F.col(order).alias("o"), F.struct(*records.columns).alias("r"))
    first = rows.groupBy(*key, "__variant").agg(F.min(rank).alias("m"))
    both = first.groupBy(*key).agg(F.min(F.when(~F.col("__variant"), F.col("m"))).alias("own"), F.min(F.when(F.col("__variant"), F.col("m"))).alias("other"))
    redundant = F.col("own").isNotNull() & ((F.col("own.y") < 9999) | (F.col("other.y") == 9999))
    kept = F.filter(F.array("own", F.when(~redundant, F.col("other"))), lambda m: m.isNotNull())
    return both.select(F.explode(kept).alias("m")).select("m.r.*")


def set_dependency_map(df: DataFrame, key: Sequence[str], values: str) -> DataFrame:
    """(key, values) for keys with exactly one set of ``values`` (an array; order and repeats don't count): its longest form."""
    canon = F.array_sort(F.array_distinct(F.col(values)))
    longest = F.aggregate(values, F.lit(0), lambda n, v: n + F.coalesce(F.length(v), F.lit(0)))
    held = df.filter(F.col(values).isNotNull()).groupBy(*key).agg(
        F.min(canon).alias("__lo"), F.max(canon).alias("__hi"), F.min(F.struct((-longest).alias("n"), F.col(values).alias("v"))).alias("m"))
    return held.filter("__lo = __hi").select(*key, F.col("m.v").alias(values))


def majority_by_priority(df: DataFrame, key: Sequence[str], value: str, priority: str) -> DataFrame:
    """(key, value, votes): the most frequent value, ties to the one of the first source, then the smallest."""
    votes = df.filter(F.col(value).isNotNull()).groupBy(*key, value).agg(F.count("*").alias("votes"), F.min(priority).alias("p"))
    top = votes.groupBy(*key).agg(F.min(F.struct((-F.col("votes")).alias("n"), F.col("p"), F.col(value).alias("v"))).alias("t"))
    return top.select(*key, F.col("t.v").alias(value), (-F.col("t.n")).alias("votes"))


def year_caps(paths: DataFrame, rules: DataFrame, extras: DataFrame) -> DataFrame:
    """(hash, cap, type): the least year known of a hash from rules, paths and extras, and its type if it has but one.

    ``paths`` (hash, path_year, rule) hold a rule's number or null; ``rules`` (rule, year, type); ``extras`` (hash, year).
    Year 0 and type "" are unknown; a type counts only if two or more rows give it and none gives another.
    """
    ruled = paths.join(rules.withColumnsRenamed({"year": "rule_year", "rule": "__rule"}), F.col("rule") == F.col("__rule"), "left")
    years = ruled.select("hash", F.explode(F.array("rule_year", "path_year")).alias("year"), F.lit(None).cast("string").alias("type"))
    every = years.union(extras.select("hash", "year", F.lit(None).cast("string"))).union(ruled.select("hash", F.lit(None).cast("int"), F.nullif("type", F.lit(""))))
    facts = every.groupBy("hash").agg(
        F.min(F.when(F.col("year") > 0, F.col("year"))).alias("cap"), F.min("type").alias("__lo"), F.max("type").alias("__hi"), F.count("type").alias("__n"))
    return facts.select("hash", "cap", F.when((F.col("__lo") == F.col("__hi")) & (F.col("__n") > 1), F.col("__lo")).alias("type"))


def blank_years_after(df: DataFrame, year: str, key: Sequence[str], earlier: DataFrame, other_year: str) -> DataFrame:
    """Years are blanked (0) where rows of ``earlier`` with the same key tell that the thing is a year or more older.

    That holds if some are over a year earlier, none is of the same or the next year, and the latest is at most a year off.
    Rows of ``earlier`` are counted per key and year before they meet.
    """
    known = earlier.filter(F.col(other_year) > 0).groupBy(*key).agg(F.array_sort(F.collect_set(other_year)).alias("__years"))
    y = F.col(year)
    before = F.exists("__years", lambda o: o + 1 < y)
    after = F.exists("__years", lambda o: (o >= y) & (o <= y + 1))
    wrong = (y > 0) & before & ~after & (y - F.array_max("__years") <= 1)
    return df.join(known, list(key), "left").select(*[F.when(F.coalesce(wrong, F.lit(False)), 0).otherwise(y).alias(c) if c == year else F.col(c) for c in df.columns])


def with_aliases(df: DataFrame, name: str, aliases: DataFrame) -> DataFrame:
    """Distinct rows of ``df`` with their own ``name`` and each alias of it; ``aliases`` holds (name, alias)."""
    known = aliases.toDF("__name", "__alias").distinct()
    other = df.join(known, F.col(name) == F.col("__name")).select(*[F.col("__alias").alias(c) if c == name else F.col(c) for c in df.columns])
    return df.union(other).distinct()


def fill_year(targets: DataFrame, peers: DataFrame, key: Sequence[str], tolerance: int = 1) -> DataFrame:
    """``targets`` with unknown ``year`` (0) taken from peers that share ``key`` (all known), if their years lie within ``tolerance``.

    The most frequent year is taken, ties to the least.
    """
    known = reduce(lambda a, b: a & b, [F.col(k) != "" for k in key])
    votes = peers.filter(known & (F.col("year") > 0)).groupBy(*key, "year").agg(F.count("*").alias("n"))
    told = votes.groupBy(*key).agg(F.min("year").alias("__lo"), F.max("year").alias("__hi"), F.min(F.struct((-F.col("n")).alias("n"), F.col("year").alias("y"))).alias("__m"))
    near = told.filter(F.col("__hi") - F.col("__lo") <= tolerance).select(*[F.col(k).alias(f"__{k}") for k in key], F.col("__m.y").alias("__year"))
    on = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"__{k}") for k in key])
    year = F.when(F.col("year") == 0, F.coalesce("__year", F.lit(0))).otherwise(F.col("year"))
    return targets.join(near, on, "left").select(*[year.alias(c) if c == "year" else F.col(c) for c in targets.columns])


def fill_from_agreeing(targets: DataFrame, peers: DataFrame, album: str, authors: int = 1, publishers: int = 1, years: int = 1) -> DataFrame:
    """``targets`` with unknown ``author`` and ``publisher`` ("") taken from an album's records where all of them agree.

    They agree with at most so many authors and publishers and years at most ``years`` apart; a value is taken only if it is
    the only one.
    """
    rows = peers.filter(F.col(album) != "")
    known = lambda c: F.nullif(F.col(c), F.lit("") if c != "year" else F.lit(0))
    told = rows.groupBy(F.col(album).alias("__album")).agg(
        F.count_distinct(known("author")).alias("__as"), F.min(known("author")).alias("__author"), F.count_distinct(known("publisher")).alias("__ps"), F.min(known("publisher")).alias("__publisher"),
        (F.max(known("year")) - F.min(known("year"))).alias("__span"),
    )
    agree = told.filter((F.col("__as") <= authors) & (F.col("__ps") <= publishers) & (F.coalesce("__span", F.lit(0)) <= years))
    new = {c: F.when((F.col(c) == "") & (F.col(n) == 1), F.col(f"__{c}")).otherwise(F.col(c)) for c, n in (("author", "__as"), ("publisher", "__ps"))}
    return targets.join(agree, F.col(album) == F.col("__album"), "left").select(*[new[c].alias(c) if c in new else F.col(c) for c in targets.columns])
