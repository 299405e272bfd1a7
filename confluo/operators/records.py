"""Choosing among records that describe one thing: best record, majority, dependencies, constraints, narrowing."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.storage import store


def ranked(df: DataFrame, key: Sequence[str], score: Column, order: Sequence[Column]) -> DataFrame:
    """``df`` with ``rank``: 1 for each key's record of the highest score, ties by ``order`` (give a total order)."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*key).orderBy(score.desc_nulls_last(), *order)))


def points(*tests: Column) -> Column:
    """One point for each test that holds; null counts as not."""
    return reduce(lambda a, b: a + b, [F.coalesce(t.cast("int"), F.lit(0)) for t in tests])


def best_record(df: DataFrame, key: Sequence[str], tests: Sequence[Column], order: Sequence[Column]) -> DataFrame:
    """Each key's record with the most points."""
    return ranked(df, key, points(*tests), order).filter("rank = 1").drop("rank")


def leftovers(df: DataFrame, key: Sequence[str], tests: Sequence[Column], order: Sequence[Column]) -> DataFrame:
    """All records but each key's best."""
    return ranked(df, key, points(*tests), order).filter("rank > 1").drop("rank")


def _beside(df: DataFrame, key: Sequence[str], **values: Column) -> DataFrame:
    """``df`` with aggregates of its key: combined map-side and joined back, so no key is gathered in one task's window."""
    told = df.groupBy(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(key)]).agg(*[v.alias(n) for n, v in values.items()])
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(key)])
    return df.join(told, on).drop(*[f"__k{i}" for i in range(len(key))])


def near_minimum(df: DataFrame, key: Sequence[str], value: str, tolerance: int = 1) -> DataFrame:
    """Records whose ``value`` (0 or null: unknown, dropped if any is known) is at most ``tolerance`` over the key's least."""
    return _beside(df, key, __least=F.min(F.when(F.col(value) > 0, F.col(value)))).filter(
        F.col("__least").isNull() | ((F.col(value) > 0) & (F.col(value) <= F.col("__least") + tolerance))
    ).drop("__least")


def majority(df: DataFrame, key: Sequence[str], value: str) -> DataFrame:
    """(key, value, votes): the most frequent non-null value of each key, ties to the smallest.

    Counts are combined map-side, and a key's values meet in two aggregates, never in a window.
    """
    votes = df.filter(F.col(value).isNotNull()).groupBy(*key, value).agg(F.count("*").alias("votes"))
    top = votes.groupBy(*key).agg(F.min(F.struct((-F.col("votes")).alias("n"), F.col(value).alias("v"))).alias("t"))
    return top.select(*key, F.col("t.v").alias(value), (-F.col("t.n")).alias("votes"))


def dependency_map(df: DataFrame, key: Sequence[str], value: str) -> DataFrame:
    """(key, value) for keys that have exactly one non-null value."""
    held = df.filter(F.col(value).isNotNull()).groupBy(*key).agg(F.min(value).alias("__lo"), F.max(value).alias("__hi"))
    return held.filter(F.col("__lo") == F.col("__hi")).select(*key, F.col("__lo").alias(value))


def impute(df: DataFrame, value: str, maps: Sequence[tuple[Sequence[str], DataFrame]]) -> DataFrame:
    """``df`` with unknown ``value`` filled from the first of ``maps`` (key columns, dependency map) that knows it."""
    out, filled = df, F.col(value)
    for i, (key, known) in enumerate(maps):
        other = known.select(*[F.col(k).alias(f"__k{i}_{j}") for j, k in enumerate(key)], F.col(value).alias(f"__v{i}"))
        on = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"__k{i}_{j}") for j, k in enumerate(key)])
        out = out.join(other, on, "left")
        filled = F.coalesce(filled, F.col(f"__v{i}"))
    return out.withColumn(value, filled).select(*df.columns)


def keep_first(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Each key's first record by ``order``, as a partial aggregate instead of a window."""
    rest = [c for c in df.columns if c not in key]
    first = F.min(F.struct(*order, *[c for c in rest if c not in order])).alias("__first")
    return df.groupBy(*key).agg(first).select(*[F.col(c) if c in key else F.col(f"__first.{c}").alias(c) for c in df.columns])


def duplicates(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """(key, n) of keys that are not unique: empty if the validation holds."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")


def strict_differences(df: DataFrame, key: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Keys whose records differ in ``values``: empty if duplicates are equal."""
    kinds = F.count_distinct(F.struct(*values)).alias("kinds")
    return df.groupBy(*key).agg(kinds).filter("kinds > 1")


def source_counts(df: DataFrame, key: Sequence[str], source: str) -> DataFrame:
    return df.groupBy(*key).agg(F.count_distinct(source).alias("n_sources"))


def inverted_index(df: DataFrame, values: str, record: str) -> DataFrame:
    """(value, records) from an array column; records sorted and distinct."""
    return df.select(F.explode(values).alias("value"), record).groupBy("value").agg(F.array_sort(F.collect_set(record)).alias("records"))


def progressive_filter(df: DataFrame, group: Sequence[str], tests: Sequence[Column]) -> DataFrame:
    """Each test in turn narrows a group's records, unless no record of the group would be left.

    What is left are the records whose results, read as one tuple, are the greatest of the group: one maximum for any number of tests.
    """
    if not tests:
        return df
    marked = df.withColumn("__held", F.struct(*[F.coalesce(t, F.lit(False)).cast("int").alias(f"t{i}") for i, t in enumerate(tests)]))
    return _beside(marked, group, __most=F.max("__held")).filter(F.col("__held") == F.col("__most")).drop("__held", "__most")


def compilations(df: DataFrame, group: Sequence[str], author: str, least: int = 5) -> DataFrame:
    """Groups with ``least`` or more distinct authors, or as many records and no author at all."""
    n = df.groupBy(*group).agg(F.count_distinct(author).alias("authors"), F.count("*").alias("records"))
    return n.filter((F.col("authors") >= least) | ((F.col("authors") == 0) & (F.col("records") >= least)))


def first_prefix_rule(df: DataFrame, path: str, rules: DataFrame, prefix: str, order: str) -> DataFrame:
    """``df`` and the first rule (by ``order``) whose prefix starts the path, in any case; an empty prefix is the default.

    Rules are keyed by their length and text and met by equi-join on the path's beginnings of those lengths, so many
    rules need no nested loop; the rule lengths, at most a path's length of them, are gathered.
    """
    rules = rules.withColumn("__key", F.lower(prefix)).withColumn("__len", F.length(prefix))
    lengths = [r["__len"] for r in rules.select("__len").distinct().collect()]
    marked = store(df.withColumn("__row", F.monotonically_increasing_id()), "marked")  # written, so numbers stay
    starts = F.array(*[F.struct(F.lit(n).alias("n"), F.substring(F.lower(path), 1, n).alias("s")) for n in sorted(lengths)])
    met = (
        marked.select("__row", F.lower(path).alias("__p"), F.explode(starts).alias("__at")).filter(F.length("__p") >= F.col("__at.n"))
        .join(rules, (F.col("__at.n") == F.col("__len")) & (F.col("__at.s") == F.col("__key")))
    )
    fields = [c for c in rules.columns if not c.startswith("__")]
    best = met.groupBy("__row").agg(F.min_by(F.struct(*fields), F.when(F.col("__len") == 0, F.lit(2**31)).otherwise(F.col(order))).alias("rule"))
    return marked.join(best, "__row", "left").drop("__row")


def cap_years(df: DataFrame, caps: DataFrame, key: str, year: str, blank: Sequence[str], lenient: Column | None = None) -> DataFrame:
    """Records whose year is over their key's cap by more than 1 (2 where ``lenient``) lose ``year`` and ``blank``."""
    over = F.col("__cap").isNotNull() & (F.col("__cap") > 0) & (F.col(year) > F.col("__cap") + F.when(lenient, 2).otherwise(1) if lenient is not None else F.col(year) > F.col("__cap") + 1)
    joined = df.join(caps.select(key, F.col(caps.columns[1]).alias("__cap")), key, "left").withColumn("__over", F.coalesce(over, F.lit(False)))
    return joined.select(*[F.when(~F.col("__over"), F.col(c)).alias(c) if c in {year, *blank} else F.col(c) for c in df.columns])


def blank_outlier_years(df: DataFrame, group: Sequence[str], year: str) -> DataFrame:
    """Years before their group's latest are blanked."""
    return _beside(df, group, __latest=F.max(year)).withColumn(year, F.when(F.col(year) == F.col("__latest"), F.col(year))).drop("__latest")


def longest_entry(df: DataFrame, key: Sequence[str], prefer: Column, group: str, number: str, length: str) -> DataFrame:
    """Of each key the ``group`` with preferred rows if any, then most numbers, then longest average, then least name:
    (key, group, numbers, average, lengths) with lengths in order of number."""
    per = df.groupBy(*key, group).agg(
        F.max(prefer.cast("int")).alias("preferred"), F.count_distinct(number).alias("numbers"),
        (F.sum(length) / F.count("*")).cast("long").alias("average"),
        F.array_sort(F.collect_list(F.struct(number, length))).alias("entries"),
    )
    best = per.groupBy(*key).agg(F.min(F.struct((-F.col("preferred")).alias("p"), (-F.col("numbers")).alias("m"), (-F.col("average")).alias("a"), F.col(group).alias("g"), "entries")).alias("b"))
    return best.select(*key, F.col("b.g").alias(group), (-F.col("b.m")).alias("numbers"), (-F.col("b.a")).alias("average"), F.col(f"b.entries.{length}").alias("lengths"))


def without_prefixes(df: DataFrame, path: str, black: DataFrame, prefix: str) -> DataFrame:
    """Rows whose path begins with none of the prefixes, whatever the case; a null path stays.

    Prefixes are met by equality: a path is cut to each length that occurs among them (asked for first).
    """
    rows = black.select(F.lower(prefix).alias("__p")).filter("__p <> ''").distinct()
    lengths = [r["n"] for r in rows.select(F.length("__p").alias("n")).distinct().orderBy("n").collect()]
    if not lengths:
        return df
    cuts = F.array(*[F.substring(F.lower(path), 1, n) for n in lengths])
    hit = df.select(F.col(path).alias("__path"), F.explode(cuts).alias("__cut")).join(rows, F.col("__cut") == F.col("__p"), "left_semi").select("__path").distinct()
    return df.join(hit, F.col(path) == F.col("__path"), "left_anti")


def flag_members(df: DataFrame, column: str, members: DataFrame, key: str, flag: str) -> DataFrame:
    """``df`` with a boolean of whether ``column`` is among ``members``."""
    known = members.select(F.col(key).alias("__m")).distinct().withColumn("__is", F.lit(True))
    return df.join(known, F.col(column) == F.col("__m"), "left").withColumn(flag, F.coalesce("__is", F.lit(False))).drop("__m", "__is")


def sorted_unique(parts: Sequence[DataFrame], key: str, place: str) -> DataFrame:
    """Distinct rows of several tables of one column with their place from 0 in its order."""
    from .ordered import rank_index

    return rank_index(reduce(DataFrame.union, parts).distinct(), [key], place)


def unique_translation(df: DataFrame, long: str, short: str) -> DataFrame:
    """Distinct (long, short) keys; short keys that stand for several long ones are left out."""
    pairs = df.select(long, short).distinct()
    single = pairs.groupBy(short).agg(F.count("*").alias("__n")).filter("__n = 1").select(F.col(short).alias("__s"))
    return pairs.join(single, F.col(short) == F.col("__s"), "left_semi")


def joined_key(parts: Sequence[Column], separator: str = "\u0001") -> Column:
    """One string to order by: parts as strings with a separator that is below all letters; null parts are empty."""
    return F.concat_ws(separator, *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def first_source(df: DataFrame, key: Sequence[str], source: str, value: str, order: Sequence[str]) -> DataFrame:
    """(key, value) of the first source in ``order`` that has a value; other sources don't count."""
    places = F.create_map(*[F.lit(x) for i, s in enumerate(order) for x in (s, i)])
    rows = df.withColumn("__p", places[F.col(source)]).filter(F.col("__p").isNotNull() & F.col(value).isNotNull())
    return rows.groupBy(*key).agg(F.min_by(value, "__p").alias(value))


def collisions(df: DataFrame, long: str, short: str) -> DataFrame:
    """(short, n): short keys that stand for several long ones; empty if the shorter form is safe."""
    return df.select(long, short).distinct().groupBy(short).agg(F.count("*").alias("n")).filter("n > 1")


def disagreeing(df: DataFrame, key: str, fields: Sequence[str], allowed: DataFrame | None = None) -> DataFrame:
    """(key, fields that differ, in order): keys whose records don't agree on all ``fields``, but for those ``allowed``.

    Unknown values ("" and 0, null) agree with any.
    """
    known = [F.when(F.col(f).cast("string").isin("", "0"), F.lit(None)).otherwise(F.col(f)) for f in fields]
    told = df.groupBy(key).agg(*[F.min(k).alias(f"__lo{i}") for i, k in enumerate(known)], *[F.max(k).alias(f"__hi{i}") for i, k in enumerate(known)])
    differ = F.filter(F.array(*[F.when(F.col(f"__lo{i}") != F.col(f"__hi{i}"), F.lit(f)) for i, f in enumerate(fields)]), lambda f: f.isNotNull())
    found = told.select(key, differ.alias("differ")).filter(F.size("differ") > 0)
    return found if allowed is None else found.join(allowed.select(key).distinct(), key, "left_anti")
