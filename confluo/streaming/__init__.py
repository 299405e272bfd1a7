"""Batch operators on streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def first_per_key(stream: DataFrame, key: list[str], time: str, late: str = "1 hour") -> DataFrame:
    """First row of each key; state of a key is dropped once the watermark has passed it."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark(key)


def each_batch(stream: DataFrame, batch: Callable[[DataFrame], DataFrame], path: str, checkpoint: str) -> StreamingQuery:
    """Applies a batch operator to what has arrived and appends its result; a batch run again replaces its own folder."""

    def write(df: DataFrame, number: int) -> None:
        batch(df).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
