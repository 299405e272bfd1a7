"""Intermediate tables that survive a lost executor.

A table written to the folder that the cluster names in ``spark.checkpoint.dir``
cuts the lineage, is read back with column pruning, and is seen alike by the
driver and by every executor.  Nothing here uses a machine-local folder unless
the session runs in local mode and names none.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The shared folder: ``spark.checkpoint.dir``, else the context's, else (local mode only) a new one."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    sc = spark.sparkContext
    set_by_hand = sc._jsc.sc().getCheckpointDir()
    if set_by_hand.isDefined():
        return set_by_hand.get().rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if sc.applicationId not in _OWN:
        _OWN[sc.applicationId] = "file://" + tempfile.mkdtemp(prefix="confluo-")
    return _OWN[sc.applicationId]


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/confluo/{label}-{uuid.uuid4().hex}"


def store(df: DataFrame, label: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` to the shared folder and return a frame that reads it back."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.option("compression", codec).parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._confluo_path = path
    return back


def discard(*tables: DataFrame) -> None:
    """Delete tables made by :func:`store` that nothing lazy refers to any more."""
    for table in tables:
        path = getattr(table, "_confluo_path", None)
        if path:
            remove_path(table.sparkSession, path)


def remove_path(spark: SparkSession, path: str) -> None:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)
