"""Embedding near-dedup by lattice hashing.

Unit vectors are projected at random to eight dimensions and decoded to the nearest point of the E8
lattice; near vectors share a lattice point, or one's point is among the lattice cells that the
other probes next.  Several tables with projections of their own make a miss of a linked pair very
unlikely; every candidate pair is verified by its cosine in double precision, and counted only in
the first table where it meets.  Equal vectors of a label are one class, so copies are never paired
with each other.  Cells with many vectors are cut into blocks, and pairs of blocks go to different tasks;
a task hands on link counts and a spanning forest, not the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.components import components
from ..plans.shipping import ship
from ..plans.storage import discard, store

MIN_COSINE = 0.93
#: Tables, cells that a vector probes besides its own, and the width of lattice cells against projections.
TABLES, PROBES, SCALE = 4, 3, 1.5
#: Vectors of one block of a cell.
BLOCK = 256
SEED = 9


@cache
def _neighbours() -> np.ndarray:
    """The 240 shortest vectors of E8, from their rule."""
    out = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            out.append(v)
    out += [np.array(s) * 0.5 for s in product((1.0, -1.0), repeat=8) if s.count(-1.0) % 2 == 0]
    return np.array(out)


def _decode_d8(x: np.ndarray) -> np.ndarray:
    """Nearest integer points with an even sum."""
    near = np.rint(x)
    odd = np.flatnonzero(near.sum(1) % 2)
    if len(odd):
        off = x[odd] - near[odd]
        worst = np.abs(off).argmax(1)
        near[odd, worst] += np.where(off[np.arange(len(odd)), worst] >= 0, 1.0, -1.0)
    return near


def decode_e8(x: np.ndarray) -> np.ndarray:
    """Nearest points of E8 (D8 and D8 shifted by one half) to the rows of ``x``."""
    whole, half = _decode_d8(x), _decode_d8(x - 0.5) + 0.5
    closer = ((x - half) ** 2).sum(1) < ((x - whole) ** 2).sum(1)
    return np.where(closer[:, None], half, whole)


def _keys(points: np.ndarray, table: int) -> np.ndarray:
    """One long for each lattice point of a table; 12 bits a coordinate keep points within +-1000 apart, then mixed."""
    twice = np.rint(points * 2).astype(np.int64)
    key = np.full(twice.shape[:-1], table + 1, np.uint64)
    for i in range(8):
        key = (key ^ (twice[..., i].astype(np.uint64) & np.uint64(0xFFFFFFFF))) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


@cache
def _projections(dim: int) -> np.ndarray:
    """(tables, dim, 8) random orthonormal directions, scaled so that lengths are kept on average, in lattice units."""
    rng = np.random.default_rng(SEED)
    out = []
    for _ in range(TABLES):
        basis = np.linalg.qr(rng.standard_normal((max(dim, 8), 8)))[0][:dim]
        out.append(basis * np.sqrt(max(dim, 8) / 8) * SCALE)
    return np.array(out)


def lattice_keys(unit: np.ndarray) -> np.ndarray:
    """(rows, tables, 1 + probes) cells of unit vectors: own cell first, then the nearest neighbouring cells."""
    out = np.zeros((len(unit), TABLES, 1 + PROBES), np.int64)
    steps = _neighbours()
    for t, projection in enumerate(_projections(unit.shape[1])):
        y = unit @ projection
        home = decode_e8(y)
        nearest = np.argsort(-((y - home) @ steps.T), axis=1, kind="stable")[:, :PROBES]
        out[:, t, 0] = _keys(home, t)
        out[:, t, 1:] = _keys(home[:, None, :] + steps[nearest], t)
    return out


def _unit(vectors: np.ndarray) -> np.ndarray:
    widest = np.abs(vectors).max(1, keepdims=True)
    scaled = vectors / widest  # no overflow of squares
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _cells(labels: np.ndarray, vectors: list) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, cells) for the vectors of each length; cells belong to one label and length."""
    sizes = np.array([len(v) for v in vectors])
    for dim in np.unique(sizes):
        mine = np.flatnonzero(sizes == dim)
        cells = lattice_keys(_unit(np.array([vectors[i] for i in mine], np.float64)))
        salt = (labels[mine].astype(np.int64) * 1_000_003 + dim).view(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        yield mine, cells.reshape(len(mine), -1) ^ salt.view(np.int64)[:, None]


_EACH = TABLES * (1 + PROBES)
_TABLE = np.repeat(np.arange(TABLES, dtype=np.int32), 1 + PROBES)
_PROBE = np.tile(np.arange(1 + PROBES) > 0, TABLES)


def _place(batches: Iterator[pa.RecordBatch], full: bool) -> Iterator[pa.RecordBatch]:
    """From (label, rep, n, vector) a row for each cell that a class is put in or probes; if not ``full``, only where."""
    for whole in batches:
        for start in range(0, whole.num_rows, 1000):
            batch = whole.slice(start, 1000)
            labels, ids, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            for mine, cells in _cells(labels, batch.column(3).to_pylist()):
                again = np.repeat(mine, _EACH)
                columns = {
                    "cell": pa.array(cells.reshape(-1)),
                    "tab": pa.array(np.tile(_TABLE, len(mine))),
                    "probe": pa.array(np.tile(_PROBE, len(mine))),
                }
                if full:
                    columns |= {
                        "id": pa.array(ids[again]),
                        "n": pa.array(n[again]),
                        "vector": batch.column(3).take(pa.array(again)),
                        "cells": pa.array(list(np.repeat(cells, _EACH, axis=0)), pa.list_(pa.int64())),
                    }
                yield pa.RecordBatch.from_pydict(columns)


def _met(cells_a: np.ndarray, cells_b: np.ndarray) -> np.ndarray:
    """(pairs, tables, 2): whether a's cells hold b's own cell, and the other way round."""
    a, b = (c.reshape(len(c), TABLES, 1 + PROBES) for c in (cells_a, cells_b))
    return np.stack([(a == b[:, :, :1]).any(2), (b == a[:, :, :1]).any(2)], 2)


def _candidates(group: np.ndarray, left: np.ndarray, right: np.ndarray, unit: np.ndarray, low: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs (home, other) of each group whose cosine may reach ``low``; rows are ordered by group."""
    cuts = np.flatnonzero(np.diff(group)) + 1
    waiting_i: list[np.ndarray] = []
    waiting_j: list[np.ndarray] = []
    waiting = 0
    for a, b in zip(np.append(0, cuts), np.append(cuts, len(group)), strict=True):
        if b - a < 2:
            continue
        homes, others = a + np.flatnonzero(left[a:b]), a + np.flatnonzero(right[a:b])
        size = len(homes) * len(others)
        if size > 4096:
            near = np.argwhere(unit[homes] @ unit[others].T >= low)
            yield homes[near[:, 0]], others[near[:, 1]]
        elif size:
            waiting_i.append(np.repeat(homes, len(others)))
            waiting_j.append(np.tile(others, len(homes)))
            waiting += size
            if waiting > 50_000:
                yield np.concatenate(waiting_i), np.concatenate(waiting_j)
                waiting_i, waiting_j, waiting = [], [], 0
    if waiting:
        yield np.concatenate(waiting_i), np.concatenate(waiting_j)


def _link(rows: pa.Table, min_cosine: float) -> pa.RecordBatch:
    """(id, n, other): of whole groups the links of each class, and a smaller or equal class that it is joined with."""
    ids, n, group, table = (rows.column(c).to_numpy() for c in ("id", "n", "group", "tab"))
    probe, side = rows.column("probe").to_numpy(), rows.column("side").to_numpy()
    lengths = np.diff(rows.column("vector").combine_chunks().offsets.to_numpy())
    cells = rows.column("cells").combine_chunks().flatten().to_numpy().reshape(-1, _EACH)
    flat = rows.column("vector").combine_chunks().flatten().to_numpy().astype(np.float64)
    width = int(lengths.max())
    unit = np.zeros((len(ids), width))  # a group holds one length, so zeros past a shorter one change no product
    unit[np.arange(width) < lengths[:, None]] = flat
    unit = _unit(unit)
    src, dst, n_src, n_dst = [], [], [], []
    for i, j in _candidates(group, (side != 1) & ~probe, side != 0, unit, min_cosine - 1e-9):
        keep = np.where(probe[j], ids[i] != ids[j], ids[i] < ids[j])  # two homes meet once; a probe isn't its own home
        i, j = i[keep], j[keep]
        for s in range(0, len(i), 50_000):
            x, y = i[s : s + 50_000], j[s : s + 50_000]
            keep = np.einsum("ij,ij->i", unit[x], unit[y]) >= min_cosine
            x, y = x[keep], y[keep]
            met, at = _met(cells[y], cells[x]), table[x]
            earlier = met.any(2) & (np.arange(TABLES) < at[:, None])
            # in this table: if each probes the other's cell, only the probe of the smaller id counts
            twice = met[np.arange(len(x)), at].all(1) & probe[y] & (ids[y] > ids[x])
            x, y = x[~earlier.any(1) & ~twice], y[~earlier.any(1) & ~twice]
            src.append(ids[x])
            dst.append(ids[y])
            n_src.append(n[x])
            n_dst.append(n[y])
    a, b = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (src, dst))
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    links = np.bincount(place, np.concatenate([*n_dst, *n_src]) if len(a) else None, len(nodes)).astype(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(links), pa.array(_forest(a, b, nodes))], names=["id", "n", "other"])


#: Rows at a time that a task holds besides the group at hand.
_HELD = 8_000


def _link_runs(batches: Iterator[pa.RecordBatch], min_cosine: float) -> Iterator[pa.RecordBatch]:
    """Groups come in order, and may go across batches; a group is at most two blocks."""
    held: list[pa.RecordBatch] = []
    for whole in batches:
        for start in range(0, whole.num_rows, _HELD):
            held.append(whole.slice(start, _HELD))
            if sum(b.num_rows for b in held) >= _HELD:
                rows = pa.Table.from_batches(held)
                group = rows.column("group").to_numpy()
                last = int(np.flatnonzero(group != group[-1])[-1]) + 1 if group[0] != group[-1] else 0
                if last:
                    yield _link(rows.slice(0, last), min_cosine)
                held = rows.slice(last).to_batches()
    if held:
        yield _link(pa.Table.from_batches(held), min_cosine)


def _forest(src: np.ndarray, dst: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """For each of ``nodes`` the smallest node of its component under the links, by pointer jumping."""
    a, b = np.searchsorted(nodes, src), np.searchsorted(nodes, dst)
    low = np.arange(len(nodes))
    while len(nodes):
        new = low.copy()
        np.minimum.at(new, a, low[b])
        np.minimum.at(new, b, low[a])
        np.minimum.at(new, low[a], new[a])
        np.minimum.at(new, low[b], new[b])
        new = new[new]
        if (new == low).all():
            break
        low = new
    return nodes[low]


def embedding_links(
    embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", min_cosine: float = MIN_COSINE
) -> DataFrame:
    """(id, n_links, component_id, kept) of every row of ``embeddings``.

    Only vectors with equal, non-null labels and equal length are compared.  Vectors that are null, empty or zero or
    hold null or non-finite components, and rows with a null id, link with nothing: n_links 0, component_id the id.
    Rows that repeat an id are other vectors to each other.  Extra columns are not read; an empty table gives an empty
    table.  Classes of equal vectors have numbers of their own, which no id decides.
    """
    spark = embeddings.sparkSession
    ship(spark)
    vector = F.col(f"`{vector_col}`")
    if embeddings.schema[vector_col].dataType.elementType.typeName() != "float":
        vector = vector.cast("array<double>")
    rows = embeddings.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("long").alias("label"), vector.alias("vector"))
    sound = (
        F.col("id").isNotNull()
        & F.col("label").isNotNull()
        & F.coalesce(
            F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))) & F.exists("vector", lambda v: v != 0),
            F.lit(False),
        )
    )
    good = rows.filter(sound)
    classes = good.groupBy("label", "vector").agg(F.min("id").alias("least"), F.count("*").alias("n"))
    classes = store(classes.withColumn("rep", F.monotonically_increasing_id()), "vectors")  # written once, so numbers stay
    given = classes.select("label", "rep", "n", "vector")
    kind = given.schema["vector"].dataType.simpleString()
    # how many blocks a large cell is cut into, from counts alone
    where = given.mapInArrow(lambda batches: _place(batches, False), "cell long, tab int, probe boolean")
    sizes = where.groupBy("cell", "tab").agg(F.count("*").alias("rows"), F.sum((~F.col("probe")).cast("long")).alias("homes"))
    cut = store(
        sizes.filter((F.col("rows") > BLOCK) & (F.col("homes") > 0))
        .select("cell", "tab", F.ceil(F.col("homes") / BLOCK).alias("nh"), F.ceil(F.col("rows") / BLOCK).alias("nr")),
        "blocks",
    )
    placed = given.mapInArrow(
        lambda batches: _place(batches, True), f"cell long, tab int, probe boolean, id long, n long, vector {kind}, cells array<long>"
    ).join(cut, ["cell", "tab"], "left")
    drawn = F.xxhash64("id")
    zero = F.lit(0).cast("long")

    def at(side: int, h, r):
        return F.struct(F.lit(side).alias("side"), h.alias("h"), r.alias("r"))

    as_home = F.transform(F.sequence(zero, F.col("nr") - 1), lambda r: at(0, F.pmod(drawn, F.col("nh")), r))
    as_other = F.transform(F.sequence(zero, F.col("nh") - 1), lambda h: at(1, h, F.pmod(drawn, F.col("nr"))))
    places = F.when(F.col("nh").isNull(), F.array(at(2, zero, zero))).when(F.col("probe"), as_other).otherwise(F.concat(as_home, as_other))
    dealt = (
        placed.withColumn("at", F.explode(places))
        .select(F.xxhash64("cell", "tab", "at.h", "at.r").alias("group"), "tab", "at.side", "probe", "id", "n", "vector", "cells")
        .repartition("group").sortWithinPartitions("group")
    )
    found = dealt.mapInArrow(lambda batches: _link_runs(batches, min_cosine), "id long, n long, other long")
    found = store(found, "found")
    counts = found.groupBy("id").agg(F.sum("n").alias("n_other"))
    reached = store(components(found.select("other", "id")).toDF("rep", "root"), "reached")
    least = reached.join(classes.select("rep", "least"), "rep").groupBy("root").agg(F.min("least").alias("component"))
    named = reached.join(least, "root").select("rep", "component")
    by_class = store(
        classes.join(counts.withColumnRenamed("id", "rep"), "rep", "left").join(named, "rep", "left")
        .select("label", "vector", (F.coalesce("n_other", F.lit(0)) + F.col("n") - 1).alias("links"), F.coalesce("component", "least").alias("component")),
        "byclass",
    )
    discard(found, reached, cut)
    of_good = good.join(by_class, ["label", "vector"]).select("id", F.col("links").alias("n_links"), F.col("component").alias("component_id"))
    rest = rows.filter(~sound).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return of_good.union(rest).select(
        F.col("id").alias(id_col), "n_links", "component_id", (F.col("id").eqNullSafe(F.col("component_id"))).alias("kept")
    )


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_links(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
