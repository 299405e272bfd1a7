"""Connected components of a link table, without gathering links anywhere.

Alternating large-star and small-star steps: every step is one partial-aggregated
``min`` per node and one equi-join, so the number of links never grows and a node
with very many links only meets a ``min`` (combined map-side) and a join that AQE
can split.  Steps are written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shipping import ship
from .storage import discard, store

#: Links that one task folds into a forest before it hands them on; bounds its memory.
FOREST_ROWS = 2_000_000


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spanning forest of each run of links: at most one link per node leaves the task."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent.setdefault(top, top)) != top:
            top = up
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    def flush() -> pa.RecordBatch:
        pairs = [(root(x), x) for x in list(parent)]
        pairs = [(a, b) for a, b in pairs if a != b]
        parent.clear()
        return pa.RecordBatch.from_pydict(
            {"src": pa.array([a for a, _ in pairs], pa.int64()), "dst": pa.array([b for _, b in pairs], pa.int64())}
        )

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            x, y = root(a), root(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
        if len(parent) >= FOREST_ROWS:
            yield flush()
    yield flush()


def fold_links(links: DataFrame) -> DataFrame:
    """(src, dst) links with the same components as ``links`` and at most one per node and task."""
    ship(links.sparkSession)
    return links.mapInArrow(_fold, "src long, dst long")


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*").alias("n"),
        F.expr("sum(cast(xxhash64(src, dst) as decimal(38,0)))").alias("h"),
    ).first()
    return row["n"], row["h"]


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step; ``edges`` hold src < dst and are a stored table."""
    if large:
        pairs = edges.union(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        pairs = pairs.toDF("node", "other")
    else:
        pairs = edges.select(F.col("dst").alias("node"), F.col("src").alias("other"))
    lows = store(pairs.groupBy("node").agg(F.min("other").alias("low")), "lows")
    joined = pairs.join(lows, "node").withColumn("low", F.least("low", "node"))
    if large:
        out = joined.filter("other > node").select(F.col("low").alias("src"), F.col("other").alias("dst"))
    else:
        out = joined.select(F.col("low").alias("src"), F.col("other").alias("dst")).union(
            lows.select(F.col("low").alias("src"), F.col("node").alias("dst"))
        )
    stepped = store(out.filter("src <> dst").distinct(), "star")
    discard(lows)
    return stepped


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links`` (two long columns): component is its smallest node.

    Self-links, repeated links and either direction are accepted; rows with a null end
    are ignored; no links give an empty table.
    """
    first, second = (F.col(f"`{c}`") for c in links.columns[:2])
    clean = links.select(first.alias("src"), second.alias("dst")).filter("src <> dst")
    edges = store(
        fold_links(clean)
        .select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"))
        .distinct(),
        "links",
    )
    before = _digest(edges)
    while before[0]:
        wide = _star(edges, large=True)
        narrow = _star(wide, large=False)
        discard(edges, wide)
        edges, after = narrow, _digest(narrow)
        if after == before:
            break
        before = after
    return edges.select(F.col("dst").alias("node"), F.col("src").alias("component")).union(
        edges.select(F.col("src").alias("node"), F.col("src").alias("component")).distinct()
    )
