"""Folders keyed by batch id, and the state store of keyed streams."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def batches(spark: SparkSession, folder: str) -> list[int]:
    """Ids of the ``batch=<id>`` folders under ``folder``."""
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(at):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(at)]
    return sorted(int(n[len("batch="):]) for n in names if n.startswith("batch="))


def prune(spark: SparkSession, folder: str, keep_from: int) -> None:
    """Drop the folders of batches before ``keep_from``."""
    for old in batches(spark, folder):
        if old < keep_from:
            at = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/batch={old}")
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Streams started inside keep their state in RocksDB."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


__all__ = ["batches", "prune", "rocksdb_state"]
