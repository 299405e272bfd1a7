from __future__ import annotations

from confluo.operators import records
from confluo.streaming import each_batch, first_per_key


def test_stream_keeps_first_and_runs_batch_operators(spark, tmp_path):
    rows = [(1, "a", "2024-01-01 00:00:00"), (1, "b", "2024-01-01 00:00:01"), (2, "c", "2024-01-01 00:00:02")]
    spark.createDataFrame(rows, "k int, v string, t string").selectExpr("k", "v", "timestamp(t) t").write.parquet(f"{tmp_path}/in")
    schema = spark.read.parquet(f"{tmp_path}/in").schema
    stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
    each_batch(first_per_key(stream, ["k"], "t"), lambda df: df, f"{tmp_path}/first", f"{tmp_path}/c1").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/first").select("k").distinct().count() == spark.read.parquet(f"{tmp_path}/first").count() == 2
    stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
    each_batch(stream, lambda df: records.majority(df, ["k"], "v"), f"{tmp_path}/votes", f"{tmp_path}/c2").awaitTermination()
    assert sorted(tuple(r)[:2] for r in spark.read.parquet(f"{tmp_path}/votes").select("k", "v").collect()) == [(1, "a"), (2, "c")]
