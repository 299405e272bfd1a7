"""Joins that Spark has no operator for, rewritten as equi-joins so that none becomes a nested loop."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.storage import store


def ancestors(path: Column) -> Column:
    """All beginnings of a path that end before a separator, without the path itself."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda n: F.array_join(F.slice(parts, 1, n), "/"))


def prefix_join(members: DataFrame, path: str, archives: DataFrame, archive: str) -> DataFrame:
    """Members below an archive's path: every ancestor of a member meets the archives by equality."""
    exploded = members.withColumn("__at", F.explode(F.filter(ancestors(F.col(path)), lambda a: (a != "") & (a != F.col(path)))))
    return exploded.join(archives, F.col("__at") == F.col(archive)).drop("__at")


def path_key(path: Column, first: int = 0, last: int = 0) -> Column:
    """The first (or last) so many segments of a path, joined again."""
    parts = F.split(path, "/")
    return F.array_join(F.slice(parts, 1, first) if first else F.slice(parts, -F.least(F.lit(last), F.size(parts)), F.lit(last)), "/")


def band_join(a: DataFrame, x: str, b: DataFrame, y: str, width: int, how: str = "inner") -> DataFrame:
    """Pairs with |x - y| <= width: each ``b`` row is put in its bucket and both neighbours, then rechecked."""
    left = a.withColumn("__cell", F.floor(F.col(x) / width))
    right = b.withColumn("__other", F.explode(F.sequence(F.floor(F.col(y) / width) - 1, F.floor(F.col(y) / width) + 1)))
    return left.join(right, (F.col("__cell") == F.col("__other")) & (F.abs(F.col(x) - F.col(y)) <= width), how).drop("__cell", "__other")


def ratio_join(a: DataFrame, x: str, b: DataFrame, y: str, share: float) -> DataFrame:
    """Pairs of positive values with |x - y| <= share * x: buckets of equal ratio, and the neighbours."""
    step = F.lit(2.0) * F.log(F.lit(1.0 + share))

    def cell(c: str) -> Column:
        return F.floor(F.log(F.col(c)) / step)

    left = a.filter(F.col(x) > 0).withColumn("__cell", cell(x))
    right = b.filter(F.col(y) > 0).withColumn("__other", F.explode(F.sequence(cell(y) - 1, cell(y) + 1)))
    return left.join(right, (F.col("__cell") == F.col("__other")) & (F.abs(F.col(x) - F.col(y)) <= F.col(x) * share)).drop("__cell", "__other")


def year_join(a: DataFrame, b: DataFrame, on: Sequence[str], year: str, other_year: str, tolerance: int = 1) -> DataFrame:
    """Equi-join on ``on`` with years at most ``tolerance`` apart: each ``b`` row is given once for every year it may meet."""
    spread = b.withColumn("__year", F.explode(F.array(*[F.col(other_year) + d for d in range(-tolerance, tolerance + 1)])))
    same = reduce(lambda p, q: p & q, [a[k] == spread[k] for k in on], a[year] == spread["__year"])
    return a.join(spread, same).drop(spread["__year"])


def cascade_join(probe: DataFrame, probe_id: str, strategies: Sequence[DataFrame]) -> DataFrame:
    """(probe id, match, rank): of ranked (probe id, match) candidate tables the first that has exactly one match."""
    tagged = [s.toDF(probe_id, "match").withColumn("rank", F.lit(i)) for i, s in enumerate(strategies, 1)]
    every = reduce(DataFrame.union, tagged)
    single = every.groupBy(probe_id, "rank").agg(F.min("match").alias("lo"), F.max("match").alias("hi")).filter("lo = hi")
    best = single.groupBy(probe_id).agg(F.min(F.struct("rank", "lo")).alias("m"))
    return probe.select(probe_id).join(best, probe_id, "left").select(probe_id, F.col("m.lo").alias("match"), F.col("m.rank").alias("rank"))


def first_key_join(df: DataFrame, keys: str, known: DataFrame, key: str, value: str) -> DataFrame:
    """``df`` and ``value`` of the first of its key array that ``known`` has; null if none. Rows need not be unique.

    Row numbers are written with the rows, so a task that is run again finds the same ones.
    """
    marked = store(df.withColumn("__row", F.monotonically_increasing_id()), "marked")
    met = marked.select("__row", F.posexplode(keys).alias("__pos", "__key")).join(known.select(F.col(key).alias("__key"), value), "__key")
    first = met.groupBy("__row").agg(F.min_by(value, "__pos").alias(value))
    return marked.join(first, "__row", "left").drop("__row")


def overlap_semi(a: DataFrame, a_list: str, b: DataFrame, b_list: str) -> DataFrame:
    """Rows of ``a`` whose array shares an element with an array of ``b``."""
    wanted = b.select(F.explode(b_list).alias("__e")).distinct()
    marked = store(a.withColumn("__row", F.monotonically_increasing_id()), "marked")
    hit = marked.select("__row", F.explode(a_list).alias("__e")).join(wanted, "__e", "left_semi").select("__row").distinct()
    return marked.join(hit, "__row", "left_semi").drop("__row")


def containment_join(a: DataFrame, b: DataFrame, on: Sequence[str], text: str, other: str) -> DataFrame:
    """Equi-join where either text contains the other."""
    cond = reduce(lambda p, q: p & q, [a[k] == b[k] for k in on])
    return a.join(b, cond & (F.contains(a[text], b[other]) | F.contains(b[other], a[text])))


def alias_join(a: DataFrame, b: DataFrame, name: str, aliases: DataFrame) -> DataFrame:
    """(a name, b name) pairs that share a name or an alias; ``aliases`` holds (name, alias)."""
    def spread(df: DataFrame, out: str) -> DataFrame:
        own = df.select(F.col(name).alias(out), F.col(name).alias("__v"))
        return own.union(own.join(aliases.toDF("__n", "__a"), F.col("__v") == F.col("__n")).select(out, "__a")).distinct()

    return spread(a, "a_name").join(spread(b, "b_name"), "__v").select("a_name", "b_name").distinct()


def reference_join(df: DataFrame, item: str, references: str) -> DataFrame:
    """(item, other): rows linked with the rows of the same table that their array of references names; each link once."""
    wanted = df.select(F.col(item).alias("item"), F.explode(references).alias("other")).filter("item <> other").distinct()
    return wanted.join(df.select(F.col(item).alias("other")).distinct(), "other", "left_semi").select("item", "other")


def path_index_join(df: DataFrame, path: str, index: DataFrame, key: str) -> DataFrame:
    """Equi-join of a path with an index of paths, whatever their case."""
    other = index.withColumn("__low", F.lower(key)).drop(key) if key == path else index.withColumn("__low", F.lower(key))
    return df.join(other, F.lower(df[path]) == F.col("__low")).drop("__low")


def size_length_join(a: DataFrame, left: tuple[str, str], b: DataFrame, right: tuple[str, str], share: float, apart: float) -> DataFrame:
    """Pairs whose sizes differ by ``share`` of the first at most and whose lengths by ``apart`` at most.

    The cell is one of size (by ratio) and length at once, so a crowd of equal sizes is still dealt by length.
    """
    step = F.lit(2.0) * F.log(F.lit(1.0 + share))
    size = lambda c: F.floor(F.log(F.col(c)) / step)
    length = lambda c: F.floor(F.col(c) / apart)
    near = lambda c: F.sequence(c - 1, c + 1)
    x, p = left
    y, q = right
    one = a.filter(F.col(x) > 0).withColumn("__s", size(x)).withColumn("__l", length(p))
    other = b.filter(F.col(y) > 0).withColumn("__os", F.explode(near(size(y)))).withColumn("__ol", F.explode(near(length(q))))
    close = (F.abs(F.col(x) - F.col(y)) <= F.col(x) * share) & (F.abs(F.col(p) - F.col(q)) <= apart)
    return one.join(other, (F.col("__s") == F.col("__os")) & (F.col("__l") == F.col("__ol")) & close).drop("__s", "__l", "__os", "__ol")


def match_members(titles: DataFrame, members: DataFrame, on: Sequence[str], probe: str, title: str, author: str, file: str) -> DataFrame:
    """All members of each title's archive; the author stays with the one that is told from the others, else is "".

    Told is the archive's single member; or the single file name that contains the title, with several that of them which
    contains the author too, with none that which contains the author.
    """
    met = titles.join(members, list(on))
    by_title, by_author = F.contains(F.col(file), F.col(title)), F.contains(F.col(file), F.col(author))
    rows = met.withColumn("__t", by_title).withColumn("__a", by_author)
    n = lambda c: F.sum(c.cast("int"))
    counts = rows.groupBy(probe).agg(F.count("*").alias("__n"), n(F.col("__t")).alias("__ts"), n(F.col("__a")).alias("__as"), n(F.col("__t") & F.col("__a")).alias("__bs"))
    chosen = F.when(F.col("__ts") == 0, F.col("__a") & (F.col("__as") == 1)).when(F.col("__ts") == 1, F.col("__t")).otherwise(F.col("__t") & F.col("__a") & (F.col("__bs") == 1))
    kept = F.when((F.col("__n") == 1) | chosen, F.col(author)).otherwise("")
    return rows.join(counts, probe).withColumn(author, kept).drop("__t", "__a", "__n", "__ts", "__as", "__bs")


def pairs_in_blocks(df: DataFrame, group: str, item: str, near: Column, block: int = 512) -> DataFrame:
    """Pairs (a, b) of rows of one group with a.item < b.item for which ``near`` (on aliases a and b) holds.

    A group's rows are dealt into blocks by a hash of the item, and each pair of blocks is a key of its own, so a crowded
    group goes to many tasks; only pairs that hold are given.  Null groups meet nothing.
    """
    rows = store(df.filter(F.col(group).isNotNull()), "blocked")
    many = rows.groupBy(F.col(group).alias("__g")).agg(F.ceil(F.count("*") / block).alias("__many"))
    dealt = rows.join(many, F.col(group) == F.col("__g")).withColumn("__mine", F.pmod(F.xxhash64(item), F.col("__many")))
    spread = dealt.withColumn("__other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__many") - 1)))
    cells = spread.withColumn("__lo", F.least("__mine", "__other")).withColumn("__hi", F.greatest("__mine", "__other"))
    a, b = cells.alias("a"), cells.alias("b")
    same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in (group, "__lo", "__hi")]
    # a cell of two blocks pairs one with the other, a cell of one pairs it with itself
    across = (F.col("a.__mine") != F.col("b.__mine")) | (F.col("a.__lo") == F.col("a.__hi"))
    return a.join(b, reduce(lambda p, q: p & q, same) & across & (F.col(f"a.{item}") < F.col(f"b.{item}")) & near)
