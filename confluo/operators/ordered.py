"""Ordered scans as windows: carry-forward, repeat markers, deltas, rank numbers, top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.storage import store

REPEAT = "\u007f"


def carry_forward(df: DataFrame, key: Sequence[str], order: Sequence[Column], value: str) -> DataFrame:
    """Unknown values take the last known one before them."""
    w = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(value, F.last(value, ignorenulls=True).over(w))


def mark_repeats(df: DataFrame, key: Sequence[str], order: Sequence[Column], values: Sequence[str]) -> DataFrame:
    """String columns that equal the row before are replaced by the repeat sign."""
    w = Window.partitionBy(*key).orderBy(*order)
    return df.select(*[F.when(F.lag(c).over(w).eqNullSafe(F.col(c)) & F.lag(F.lit(1)).over(w).isNotNull(), F.lit(REPEAT)).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in df.columns])


def unmark_repeats(df: DataFrame, key: Sequence[str], order: Sequence[Column], values: Sequence[str]) -> DataFrame:
    """The inverse of :func:`mark_repeats`, for columns without nulls."""
    w = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.select(*[F.last(F.when(F.col(c) != REPEAT, F.col(c)), ignorenulls=True).over(w).alias(c) if c in values else F.col(c) for c in df.columns])


def delta_encode(df: DataFrame, key: Sequence[str], value: str, out: str = "delta") -> DataFrame:
    """Difference to the next smaller value of the key; the first keeps its value."""
    w = Window.partitionBy(*key).orderBy(value)
    return df.withColumn(out, F.col(value) - F.coalesce(F.lag(value).over(w), F.lit(0)))


def delta_decode(df: DataFrame, key: Sequence[str], order: Sequence[Column], delta: str, out: str = "value") -> DataFrame:
    w = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.sum(delta).over(w))


def rank_index(df: DataFrame, order: Sequence[str], out: str = "idx") -> DataFrame:
    """``df`` with its place from 0 in the order, without gathering rows: partitions by range, one count each.

    The range partitions are written first, so that places don't change if a task is run again.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *order).withColumn("__part", F.spark_partition_id())
    held = store(ranged, "ranks")
    counts = {r["__part"]: r["n"] for r in held.groupBy("__part").agg(F.count("*").alias("n")).collect()}
    offsets, total = [], 0
    for p in range(max(counts, default=-1) + 1):
        offsets.append(total)
        total += counts.get(p, 0)
    place = F.row_number().over(Window.partitionBy("__part").orderBy(*order)) - 1
    offset = F.get(F.array(*[F.lit(o).cast("long") for o in offsets or [0]]), F.col("__part"))
    return held.withColumn(out, (place + offset).cast("long")).drop("__part")


def top_k(df: DataFrame, score: Column, ties: Sequence[Column], k: int) -> DataFrame:
    """The k best distinct rows: a bounded heap per task, never a global sort."""
    return df.distinct().orderBy(score.desc(), *ties).limit(k)


def fill_whole(df: DataFrame, key: Sequence[str], order: Sequence[Column], value: str) -> DataFrame:
    """Unknown values take the last known one of their whole key."""
    w = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return df.withColumn(value, F.coalesce(value, F.last(value, ignorenulls=True).over(w)))


def path_stack(df: DataFrame, key: Sequence[str], order: Sequence[Column], depth: str, name: str, deepest: int, out: str = "path") -> DataFrame:
    """Paths of a tree listed depth-first: the names of the last row of each smaller depth (from 1), then the row's own.

    Depths beyond ``deepest`` raise an error, as their path would lack names.
    """
    w = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    level = F.when(F.col(depth) <= deepest, F.col(depth)).otherwise(F.raise_error(F.concat(F.lit("depth over the limit: "), F.col(depth).cast("string"))).cast("int"))
    marked = df.withColumn("__depth", level)
    at = [F.when(F.col("__depth") >= d, F.last(F.when(F.col("__depth") == d, F.col(name)), ignorenulls=True).over(w)) for d in range(1, deepest + 1)]
    return marked.withColumn(out, F.concat_ws("/", *at)).drop("__depth")
