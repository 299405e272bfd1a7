"""Which of several releases of one thing tells its date.

Dates are ISO strings with `99` for what isn't known (`1992-99-99`), "" for none, and compare as strings; precisions are
0 unknown, 1 year, 2 month, 3 day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NEVER = "9999-99-99"
_DATES = ("mod", "prod", "party")
_FIELDS = ("id", "has_authors", "has_prod", *[f"{d}_{x}" for d in _DATES for x in ("date", "precision")])


def _or_never(date: Column) -> Column:
    return F.when(date == "", NEVER).otherwise(date)


def choose_release(releases: DataFrame, key: str) -> DataFrame:
    """(key, id, mod_date, prod_date, party_date, n_prods) of the release that each key is dated by.

    Releases with authors count before those without, and those with a production or party date before those without.  In
    order of their earliest date, the first whose production or party date isn't after all others is taken; it gives way to
    the first later one whose date has the precision of its own music's date, unless it has that itself.  Without any, the
    first with a production or a party date, else the earliest by the music's own date.  Unknown parts of the dates are
    shown as `01`; n_prods counts the releases with a production.  Ties go to the smaller id.  One fold per key over its
    releases, which are few.
    """
    rows = releases.select(
        key, "id", F.coalesce("has_authors", F.lit(False)).alias("has_authors"), F.coalesce("has_prod", F.lit(False)).alias("has_prod"),
        *[F.coalesce(f"{d}_date", F.lit("")).alias(f"{d}_date") for d in _DATES], *[F.coalesce(f"{d}_precision", F.lit(0)).cast("int").alias(f"{d}_precision") for d in _DATES],
    ).filter(F.col(key).isNotNull())
    every = rows.groupBy(key).agg(F.array_sort(F.collect_set(F.struct(*_FIELDS))).alias("all"))

    def narrowed(all_: Column, test) -> Column:
        return F.when(F.exists(all_, test), F.filter(all_, test)).otherwise(all_)

    def dated(r: Column) -> Column:
        return (r["prod_date"] != "") | (r["party_date"] != "")

    kept = every.withColumn("all", narrowed(F.col("all"), lambda r: r["has_authors"])).withColumn("all", narrowed(F.col("all"), dated))
    alike = F.size(F.array_distinct(F.transform("all", lambda r: r["mod_date"]))) == 1
    made = lambda r: F.least(_or_never(r["prod_date"]), _or_never(r["party_date"]))
    first = lambda r: F.when(F.col("__alike"), made(r)).otherwise(F.least(made(r), _or_never(r["mod_date"])))

    def by(all_: Column, date) -> Column:
        return F.transform(F.array_sort(F.transform(all_, lambda r: F.struct(date(r).alias("d"), r.alias("r")))), lambda x: x["r"])

    kept = kept.withColumn("__alike", alike)
    kept = kept.withColumn("ordered", by(F.col("all"), first)).withColumn("by_release", by(F.col("all"), made))
    earliest = F.array_min(F.transform("all", lambda r: F.least(made(r), _or_never(r["mod_date"]))))
    kept = kept.withColumn("earliest", earliest)
    early = F.col("earliest")

    def weak(r: Column, d: str) -> Column:
        return (r[f"{d}_date"] != "") & (r[f"{d}_date"] <= early)

    def strong(r: Column, d: str) -> Column:
        return weak(r, d) & (r["mod_precision"] == r[f"{d}_precision"])

    def exact(r: Column, d: str, held: Column) -> Column:
        to_day = ((r["party_date"] != "") & (r["party_precision"] == 3)) | F.coalesce((held["party_date"] != "") & (held["party_precision"] == 3), F.lit(False))
        digits = F.when(r["mod_precision"] == 1, 4).when(r["mod_precision"] == 2, 7).when(to_day, 10).otherwise(7)
        cut = lambda c: F.substring(c, F.lit(1), digits)
        return (r[f"{d}_date"] != "") & (r[f"{d}_date"] == r["mod_date"]) & (r["mod_precision"] == r[f"{d}_precision"]) & (cut(r[f"{d}_date"]) <= cut(early))

    none = F.get("ordered", F.lit(-1))

    def step(held: Column, r: Column) -> Column:
        sure = strong(r, "prod") | strong(r, "party") | exact(r, "prod", held)
        any_ = sure | exact(r, "party", held) | weak(r, "prod") | weak(r, "party")
        held_sure = strong(held, "prod") | strong(held, "party") | exact(held, "prod", held) | exact(held, "party", held)
        return F.when(held.isNull(), F.when(any_, r)).when(sure & ~F.coalesce(held_sure, F.lit(False)), r).otherwise(held)

    single = F.when(F.size("ordered") == 1, F.get("ordered", F.lit(0)))
    best = F.coalesce(single, F.aggregate("ordered", none, step))
    released = F.get(F.filter("by_release", lambda r: r["has_prod"] | (r["party_date"] != "")), F.lit(0))
    by_music = F.get(by(F.col("all"), lambda r: r["mod_date"]), F.lit(0))
    chosen = kept.select(key, "all", F.coalesce(best, released, by_music).alias("b"))
    shown = [F.regexp_replace(f"b.{d}_date", "-99", "-01").alias(f"{d}_date") for d in _DATES]
    prods = F.size(F.filter("all", lambda r: r["has_prod"])).cast("long")
    return chosen.select(key, "b.id", *shown, prods.alias("n_prods"))
