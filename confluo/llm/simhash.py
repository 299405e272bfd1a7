"""SimHash near-dedup: segment-popcount embedding, grid range-join, exact verification.

A 64-bit fingerprint is cut into 32 segments of two bits; the vector of segment
popcounts lies within Manhattan distance ``d`` of another whenever the fingerprints
differ in at most ``d`` bits.  The segments form ``d + s`` groups, so two linked vectors
agree exactly on at least ``s`` groups: each choice of ``s`` groups is a grid whose cells are
those groups' popcounts, and linked vectors share a cell of some grid; ``s`` rises with the
number of fingerprints, which keeps cells small.  A candidate pair is kept
only in the first grid where it meets, if its Manhattan distance and then its exact
Hamming distance are at most ``d``.  Nothing is approximate.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.components import components, fold_links
from ..plans.storage import discard, store
from .textio import add_columns

SEED = 42
SHINGLE_WORDS = 4
MAX_BITS = 4
#: Groups of several rows up to which the row that stays of each is broadcast (some 50 bytes a group).
BROADCAST_GROUPS = 200_000
_LOW = 0x5555555555555555


def fingerprint(text: bytes, words_per_shingle: int = SHINGLE_WORDS) -> int:
    """Fingerprint of one text: a bit is set if it is set in over half the shingle hashes; no words: 0."""
    words = text.lower().split()  # bytes: A-Z only, and cuts at 0x20 and 0x09-0x0D only
    if not words:
        return 0
    joined = b" ".join(words)
    n = len(words) - words_per_shingle + 1
    if n <= 1:
        return xxhash.xxh64_intdigest(joined, SEED)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths)
    starts = (ends - lengths)[:n].tolist()
    stops = (ends[words_per_shingle - 1 :] - 1).tolist()
    digest = xxhash.xxh64_digest
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 8192):
        hashes = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts[at : at + 8192], stops[at : at + 8192])])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8)).reshape(-1, 64)
        ones += bits.sum(0, dtype=np.int32)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def with_fingerprint(docs: DataFrame, text_col: str = "text", words_per_shingle: int = SHINGLE_WORDS) -> DataFrame:
    """``docs`` and column ``fingerprint_bits`` (the fingerprint as a signed long)."""

    def make():
        def score(texts: list[bytes]) -> list[pa.Array]:
            values = np.array([fingerprint(t, words_per_shingle) for t in texts], np.uint64)
            return [pa.array(values.view(np.int64))]

        return score

    return add_columns(docs, text_col, [("fingerprint_bits", T.LongType())], make)


def _lit(mask: int) -> Column:
    return F.lit(mask - (1 << 64) if mask >> 63 else mask)


def _unary_popcounts(fp: Column) -> Column:
    """Segment popcounts 0, 1, 2 as 00, 01, 11: Manhattan distance is then the bit count of an XOR."""
    low = fp.bitwiseAND(_lit(_LOW))
    high = F.shiftrightunsigned(fp, 1).bitwiseAND(_lit(_LOW))
    return low.bitwiseOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))


def _group_masks(groups: int) -> list[int]:
    cuts = [round(32 * g / groups) * 2 for g in range(groups + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]


def groups_for(n: int, max_bits: int) -> int:
    """Groups that a grid's cells agree on, for ``n`` distinct fingerprints: as few as keep cells at some 256 of them.

    A segment of two bits tells about 1.5 bits apart, so a cell on s of max_bits + s groups tells 48 s / (max_bits + s).
    The result of the join is the same for any number.
    """
    wanted = max(0.0, math.log2(max(n, 1)) - 8)
    return next((s for s in range(2, 29 - max_bits) if 48 * s / (max_bits + s) >= wanted), 2)


def linked_fingerprints(prints: DataFrame, max_bits: int = MAX_BITS, shared_groups: int = 2) -> DataFrame:
    """Pairs (src, dst) with src < dst of distinct fingerprints at ``max_bits`` or fewer differing bits.

    ``prints`` has one long column of distinct fingerprints and must be a stored table (it is read twice).
    Work is the number of pairs that share a cell; a larger ``shared_groups`` makes cells smaller and grids more.
    """
    groups = max_bits + shared_groups
    if not 1 <= groups <= 32:
        raise ValueError("max_bits + shared_groups must be between 1 and 32")
    masks = _group_masks(groups)
    grids = list(combinations(range(groups), shared_groups))
    fp = F.col(f"`{prints.columns[0]}`")
    embedded = prints.select(fp.alias("fp")).filter("fp is not null").withColumn("unary", _unary_popcounts(F.col("fp")))
    cells = F.array(
        *[
            F.struct(
                F.lit(sum(1 << g for g in grid)).alias("grid"),
                F.lit((2 << max(grid)) - 1).alias("upto"),
                F.col("unary").bitwiseAND(_lit(sum(masks[g] for g in grid))).alias("cell"),
            )
            for grid in grids
        ]
    )
    placed = embedded.select("fp", "unary", F.explode(cells).alias("at")).select("fp", "unary", "at.grid", "at.upto", "at.cell")
    a, b = placed.alias("a"), placed.alias("b")
    apart = F.col("a.unary").bitwiseXOR(F.col("b.unary"))
    agree = sum((F.when(apart.bitwiseAND(_lit(m)) == 0, F.lit(1 << g)).otherwise(F.lit(0)) for g, m in enumerate(masks)), F.lit(0))
    first = agree.bitwiseAND(F.col("a.upto"))  # the lowest groups that agree name the one grid where this pair counts
    return a.join(
        b,
        (F.col("a.grid") == F.col("b.grid"))
        & (F.col("a.cell") == F.col("b.cell"))
        & (F.col("a.fp") < F.col("b.fp"))
        & (F.bit_count(apart) <= max_bits)
        & (F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= max_bits)
        & (first == F.col("a.grid")),
    ).select(F.col("a.fp").alias("src"), F.col("b.fp").alias("dst"))


def _roots(prints: DataFrame, max_bits: int) -> DataFrame:
    """(fingerprint_bits, root) of the distinct fingerprints of ``prints``, a stored table: one root per component."""
    distinct = store(prints.select("fingerprint_bits").distinct(), "prints")
    links = linked_fingerprints(distinct, max_bits, groups_for(distinct.count(), max_bits))
    reached = components(links).select(F.col("node").alias("fingerprint_bits"), F.col("component").alias("root"))
    return store(distinct.join(reached, "fingerprint_bits", "left").withColumn("root", F.coalesce("root", "fingerprint_bits")), "roots")


def simhash_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_bits: int = MAX_BITS,
    words_per_shingle: int = SHINGLE_WORDS,
) -> DataFrame:
    """(id, fingerprint, component_id) of every row of ``docs``, as a stored table's join.

    component_id is the smallest id reachable over links of ``max_bits`` or fewer differing bits.
    Null or empty texts and texts without words have fingerprint zero and link like any other; rows that repeat
    an id keep one row each; a row with a null id takes part but names no group, so a group of null ids only has a
    null component_id.  Extra columns are not read.  An empty table gives an empty table.
    """
    ids = docs.select(F.col(f"`{id_col}`").cast("long").alias(id_col), F.col(f"`{text_col}`").alias("text" if id_col != "text" else "body"))
    prints = store(
        with_fingerprint(ids, ids.columns[1], words_per_shingle).select(id_col, "fingerprint_bits"), "simhash"
    )
    roots = _roots(prints, max_bits)
    named = prints.groupBy("fingerprint_bits").agg(F.min(id_col).alias("first_id")).join(roots, "fingerprint_bits")
    named = store(named, "named")
    smallest = store(named.groupBy("root").agg(F.min("first_id").alias("component_id")), "smallest")
    of_print = store(named.join(smallest, "root").select("fingerprint_bits", "component_id"), "ofprint")
    discard(roots, named, smallest)
    return prints.join(of_print, "fingerprint_bits").select(
        id_col, F.lpad(F.lower(F.hex("fingerprint_bits")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """One row of ``docs`` for each group: that with the smallest id, then the smallest hash of its text.

    Rows are judged one by one, whatever id they share; rows with a null id come last of their group.  Of rows that repeat
    both id and text one stays.  Null and empty texts are a group like any other; an empty table gives an empty table.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    own, body = F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`").cast("string")
    rows = docs.select(own.alias("id"), F.xxhash64(body).alias("hash"), body.alias("body"))
    prints = store(with_fingerprint(rows, "body").select("id", "hash", "fingerprint_bits"), "simhash")
    roots = _roots(prints, max_bits)
    placed = prints.join(roots, "fingerprint_bits").groupBy("root", "id", "hash").agg(F.count("*").alias("n"))
    placed = store(placed.withColumn("late", F.col("id").isNull()), "placed")
    first = F.struct("late", "id", "hash")
    best = store(placed.groupBy("root").agg(F.min(first).alias("best"), F.count("*").alias("rows")).filter("rows > 1").drop("rows"), "best")
    others = placed.join(F.broadcast(best) if best.count() <= BROADCAST_GROUPS else best, "root")
    gone = store(others.filter(first != F.col("best")).select(F.col("id").alias("__cf_id"), F.col("hash").alias("__cf_hash")), "gone")
    again = store(placed.filter("n > 1").select(F.col("id").alias("__cf_id"), F.col("hash").alias("__cf_hash")), "again")
    same = own.eqNullSafe(F.col("__cf_id")) & (F.xxhash64(body) == F.col("__cf_hash"))
    left = docs.join(gone, same, "left_anti")
    if again.isEmpty():
        return left.select(*columns)
    key = F.struct(own.isNull(), own, F.xxhash64(body))
    repeated = left.join(again, same, "left_semi").withColumn("__cf_key", key).dropDuplicates(["__cf_key"])
    return left.join(again, same, "left_anti").select(*columns).union(repeated.select(*columns))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))


__all__ = ["fingerprint", "fold_links", "keep_one_per_group", "linked_fingerprints", "op8_simhash", "simhash_groups"]
