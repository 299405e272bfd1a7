"""Helpers that the text operators share: Arrow in, Arrow out, whole texts, all columns carried."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..plans.shipping import ship

#: Text carried next to the input's own columns, under a name that no input uses.
TEXT = "__cf_text"


def give_back() -> None:
    """At a task's end: freed memory goes back to the system, as idle workers stay beside their executor."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library
        ctypes.CDLL(None).malloc_trim(0)


def texts_of(batch: pa.RecordBatch, at: int = -1) -> list[bytes]:
    """UTF-8 bytes of the texts; null is empty."""
    return [x or b"" for x in batch.column(at).cast(pa.binary()).to_pylist()]


def add_columns(
    docs: DataFrame,
    text_col: str,
    new: list[tuple[str, T.DataType]],
    make: Callable[[], Callable[[list[bytes]], list[pa.Array]]],
) -> DataFrame:
    """``docs`` with the columns ``new`` that ``make()(texts)`` computes from whole texts, batch by batch.

    An input column with the name of a new one is replaced.  ``make`` runs once per task.
    """
    names = {n.lower() for n, _ in new}
    kept = [c for c in docs.columns if c.lower() not in names]
    source = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text_col}`").cast("string").alias(TEXT))
    schema = T.StructType([*source.schema.fields[:-1], *(T.StructField(n, t) for n, t in new)])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = make()
        for batch in batches:
            if batch.num_rows:
                columns = [*batch.columns[:-1], *score(texts_of(batch))]
                columns = [c if c.type == f.type else c.cast(f.type) for c, f in zip(columns, arrow, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)
        give_back()

    ship(docs.sparkSession)
    return source.mapInArrow(run, schema)
