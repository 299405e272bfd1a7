"""Mixing sources to target weights, with DataFrame functions only.

Words per source are aggregated, targets found by filling each source up to its cap, and each
document is emitted floor(rate) times plus once more if its hash falls below the rate's fraction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.storage import store

#: Weights of the sources in order of their names, repeating.
WEIGHTS = (5, 2, 1)
#: Words of the mix as a multiple of the words at hand, and the most a source may be repeated.
SHARE, MOST = 1.5, 2.0
SEED = "mix-1"
#: Up to so many sources their table is broadcast (a row is some 100 bytes); beyond, the join is salted.
BROADCAST_SOURCES = 20_000
SALTS = 64


def words(text: Column) -> Column:
    """Number of runs of characters other than space and U+0009 to U+000D; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def hash_share(doc_id: Column, body: Column, seed: str = SEED) -> Column:
    """A number from 0 to 1 (exclusive) that depends on id and text: 52 bits of an MD5."""
    of_text = F.md5(F.coalesce(body.cast("string"), F.lit("")).cast("binary"))
    text = F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), of_text)
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, target) from (source, source_size): weighted shares, none above ``most`` times its size.

    The excess of capped sources is shared out by weight again until none is above its cap.  With sources in order of
    cap per weight, the first k are capped for the smallest k whose level (what is left per weight that is left) lies
    below the next source's cap per weight.  One row per source; sources in code point order, null last.
    """
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_level = Window.orderBy("full_at", "place")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_level.rowsBetween(0, Window.unboundedFollowing)
    levels = F.array(*[F.lit(float(w)) for w in weights])
    return (
        sizes.withColumn("place", F.row_number().over(by_name) - 1)
        .withColumn("weight", F.get(levels, F.col("place") % len(weights)))
        .withColumn("cap", F.col("source_size") * F.lit(float(most)))
        .withColumn("full_at", F.col("cap") / F.col("weight"))
        .withColumn("wanted", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("level", (F.col("wanted") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(rest))
        .withColumn("level", F.min(F.when(F.col("level") <= F.col("full_at"), F.struct("full_at", "place", "level"))).over(everything)["level"])
        .select(
            "source",
            "source_size",
            F.least(F.col("cap"), F.coalesce(F.col("level") * F.col("weight"), F.col("cap"))).alias("target"),
        )
    )


def with_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights=WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seed: str = SEED,
) -> DataFrame:
    """``docs`` with size, source_size, target and copies (how often the mix emits the row).

    Null and empty texts have size 0; null is a source of its own, after all others.  A source of size 0 has target 0 and
    is not emitted.  Rows with a null or a repeated id draw by their texts; only rows that repeat both id and text draw
    alike.  Input columns of these four names are replaced; an empty table gives an empty table.  Reruns agree: the draw
    depends on id, text and seed alone.
    """
    own = ("size", "source_size", "target", "copies")
    kept = [c for c in docs.columns if c.lower() not in own]
    source, size = F.col(f"`{source_col}`"), words(F.col(f"`{text_col}`"))
    sizes = docs.select(source.alias("source"), size.alias("size")).groupBy("source").agg(F.sum("size").alias("source_size"))
    sizes = store(sizes, "sources")
    targets = source_targets(sizes, weights, share, most).withColumnRenamed("source", "__cf_source")
    measured = docs.select(*[F.col(f"`{c}`") for c in kept], size.alias("size"))
    if sizes.count() <= BROADCAST_SOURCES:
        joined = measured.join(F.broadcast(targets), source.eqNullSafe(F.col("__cf_source")))
    else:
        salted = targets.withColumn("__cf_salted", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salt = F.pmod(F.xxhash64(F.col(f"`{id_col}`"), F.col("size")), F.lit(SALTS)).cast("int")
        joined = measured.withColumn("__cf_salt", salt).join(
            salted, source.eqNullSafe(F.col("__cf_source")) & (F.col("__cf_salt") == F.col("__cf_salted"))
        )
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    copies = F.floor(rate) + (hash_share(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"), seed) < rate - F.floor(rate)).cast("long")
    return joined.select(*[F.col(f"`{c}`") for c in kept], "size", "source_size", "target", copies.alias("copies"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as :func:`with_copies` says, with the columns of ``docs`` only.

    Nulls, repeated rows and empty tables are as there; rows of size 0 follow their source's rate like any other.
    """
    drawn = with_copies(docs, **options).filter("copies > 0")
    return drawn.withColumn("__cf_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*[F.col(f"`{c}`") for c in docs.columns])


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return with_copies(docs).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
