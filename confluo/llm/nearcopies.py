"""Near copies of texts: MinHash bands of five-word shingles propose pairs, exact Jaccard decides.

Bands propose; a pair counts only if the sets of its whole texts' shingles have a Jaccard similarity of ``SIMILARITY``
or more, so documents without a near copy stay.  A pair just at 0.8 meets in no band once in some 2,800 pairs
((1 - 0.8 ** ROWS) ** BANDS), or has too few rows alike (``LEAST_ROWS``); all pairs above it less often.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ordered import rank_index
from ..plans.shipping import ship
from ..plans.storage import discard, store
from .textio import add_columns, give_back

SIMILARITY = 0.8
SHINGLE_WORDS = 5
BANDS, ROWS = 20, 5
#: Once all pairs in the buckets left are at most so many times the band keys of all documents, they are compared at once.
PAIRS_PER_KEY = 1
#: Of the BANDS * ROWS least hashes so many must be equal before texts are compared: at 0.8 they are 80 on average, and
#: fewer than this once in some 6,800 pairs.
LEAST_ROWS = 65
_rng = np.random.default_rng(20)
_FLIP, _ODD = (_rng.integers(0, 1 << 64, (BANDS * ROWS, 1), np.uint64) for _ in range(2))
_ODD |= np.uint64(1)


def shingles(text: bytes) -> set[bytes]:
    """Distinct runs of five words after lower-casing A-Z; a shorter text is one shingle, no words are none."""
    words = text.lower().split()
    if not words:
        return set()
    joined = b" ".join(words)
    n = len(words) - SHINGLE_WORDS + 1
    if n <= 1:
        return {joined}
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths)
    return {joined[a:b] for a, b in zip((ends - lengths)[:n].tolist(), (ends[SHINGLE_WORDS - 1 :] - 1).tolist(), strict=True)}


def signature(text: bytes) -> tuple[list[int], list[int]]:
    """(one signed long per band, the last eight bits of every row's least hash); none for a text without words."""
    mine = shingles(text)
    if not mine:
        return [], []
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, mine), np.uint64, len(mine))
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 1024):
        least = np.minimum(least, ((hashes[at : at + 1024] ^ _FLIP) * _ODD).min(1))
    rows = least.reshape(BANDS, ROWS)
    keys = np.array([xxhash.xxh64_intdigest(r.tobytes(), b) for b, r in enumerate(rows)], np.uint64)
    return keys.view(np.int64).tolist(), (least & np.uint64(255)).astype(np.uint8).view(np.int8).tolist()


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(low, id) of the rows (low, id, low's text, id's text) that are near copies."""
    held, held_set = None, set()
    for batch in batches:
        low, high, a, b = (batch.column(i) for i in range(4))
        kept = []
        for x, y in zip(a.cast(pa.binary()).to_pylist(), b.cast(pa.binary()).to_pylist(), strict=True):
            if x != held:
                held, held_set = x, shingles(x)
            other = shingles(y)
            shared = len(held_set & other)
            kept.append(shared * 10 >= round(SIMILARITY * 10) * (len(held_set) + len(other) - shared) and shared > 0)
        yield pa.RecordBatch.from_arrays([low, high], names=["low", "id"]).filter(pa.array(kept, pa.bool_()))
    give_back()


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The (low, id) pairs whose texts are near copies, stored."""
    both = pairs.join(texts.select("id", F.col("body").alias("b")), "id").join(texts.select(F.col("id").alias("low"), F.col("body").alias("a")), "low")
    return store(both.select("low", "id", "a", "b").mapInArrow(_alike, "low long, id long").distinct(), "alike")


def _crowded(members: DataFrame) -> DataFrame:
    """(key, id) of the buckets with two members or more, with the bucket's smallest id and size."""
    buckets = members.groupBy("key").agg(F.min("id").alias("low"), F.count("*").alias("n")).filter("n > 1")
    return members.join(buckets, "key")


def _all_pairs(ranked: DataFrame, banded: DataFrame) -> DataFrame:
    """(low, id) of all pairs that share a bucket and ``LEAST_ROWS`` of their rows, each given by the first band that the two share."""
    rows = store(ranked.select("key", "id").join(banded, "id"), "paired")
    a, b = rows.alias("a"), rows.alias("b")
    first = F.array_position(F.zip_with("a.keys", "b.keys", lambda x, y: x == y), True)
    alike = F.size(F.filter(F.zip_with("a.rows", "b.rows", lambda x, y: x == y), lambda same: same))
    own = F.get("a.keys", first.cast("int") - 1) == F.col("a.key")
    return a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.id") < F.col("b.id")) & own & (alike >= LEAST_ROWS)).select(
        F.col("a.id").alias("low"), F.col("b.id").alias("id")
    )


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(low, id) links of near copies, low < id: of any two near copies that share a band, one at least is an ``id``.

    The smallest id of every bucket is compared with all others; it and those found leave, until no bucket holds two.  A
    large group of copies so costs its size, not its square.  Null ids and texts without words have no links.
    """
    spark = docs.sparkSession
    ship(spark)
    plain = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("body")).filter("id is not null")

    def make():
        def score(texts: list[bytes]) -> list[pa.Array]:
            found = [signature(t) for t in texts]
            return [pa.array([f[0] for f in found], pa.list_(pa.int64())), pa.array([f[1] for f in found], pa.list_(pa.int8()))]

        return score

    keys = add_columns(plain, "body", [("keys", T.ArrayType(T.LongType())), ("rows", T.ArrayType(T.ByteType()))], make)
    banded = store(keys.select("id", "keys", "rows").dropDuplicates(["id"]), "bands")
    every = banded.select("id", F.explode("keys").alias("key"))
    members = store(_crowded(every).select("key", "id"), "members")
    texts = store(plain.join(members.select("id").distinct(), "id", "left_semi").dropDuplicates(["id"]), "texts")
    most, found = PAIRS_PER_KEY * every.count(), []
    while True:
        ranked = store(_crowded(members), "ranked")
        rows, pairs = ranked.agg(F.count("*"), F.sum(F.col("n") - 1) / 2).first()
        if not rows:
            break
        if last := pairs <= most:
            met = _all_pairs(ranked, banded)
        else:
            met = ranked.filter("id <> low").select("low", "id")
        found.append(_verified(met.distinct(), texts))
        if last:
            break
        left = ranked.filter("id <> low").join(found[-1].select("id").distinct(), "id", "left_anti")
        stepped = store(left.select("key", "id"), "members")
        discard(members, ranked)
        members = stepped
    links = spark.createDataFrame([], "low long, id long")
    for part in found:
        links = links.union(part)
    return links


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` (a stored table) without the rows that are near copies of an earlier one: smaller id, then hash of the text.

    Rows are judged one by one, whatever id they share; null ids come last.  Rows that repeat both id and text stay or go
    together.  Texts without words stay; an empty table gives an empty table.
    """
    own, hashed = F.col(f"`{id_col}`").cast("long"), F.xxhash64(F.col(f"`{text_col}`").cast("string"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    rows = store(docs.select(own.alias("__cf_id"), hashed.alias("__cf_hash")).distinct(), "rows")
    if rows.groupBy("__cf_id").agg(F.count("*").alias("n")).filter("n > 1 or __cf_id is null").isEmpty():
        gone = near_copies(docs, id_col, text_col).select(F.col("id").alias("__cf_gone")).distinct()
        return docs.join(gone, own == F.col("__cf_gone"), "left_anti").select(*columns)
    ranks = rank_index(rows.withColumn("__cf_late", F.col("__cf_id").isNull()), ["__cf_late", "__cf_id", "__cf_hash"], "__cf_row")
    placed = docs.join(ranks, own.eqNullSafe(F.col("__cf_id")) & (hashed == F.col("__cf_hash")))
    placed = store(placed.select(*columns, "__cf_row"), "placed")
    gone = near_copies(placed, "__cf_row", text_col).select(F.col("id").alias("__cf_gone")).distinct()
    return placed.join(gone, F.col("__cf_row") == F.col("__cf_gone"), "left_anti").select(*columns)
