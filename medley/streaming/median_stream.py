"""Exact median per group and event-time window on a stream.

``windowed_median`` is the built-in form: each (window, group) is an
aggregation state emitted once the watermark closes it (append mode), but
``F.median`` keeps every distinct value of an open (window, group) in one
task's buffer, so a hot group is one task.

``run_windowed_median`` is the skew-safe form for a run that ends with its
input. The stream keeps only tie-collapsed counts, ``(window, keys, value) ->
count``, as aggregation state hashed over the value too, so a hot group is spread
over tasks. Each micro-batch writes the counts it changed to a staging folder of
the shared checkpoint folder, keyed by batch id and overwritten, so a replayed
batch leaves one copy. When the input is exhausted the latest count of each
(window, keys, value) goes through the batch rank median. There is no watermark,
so no row is late and every window is in the result, however the input is cut
into files.

``start_windowed_median`` is the same on an endless stream. The counts are aggregation
state again, one row per (window, keys, value) and so spread over the tasks by value;
the watermark closes a window, all its counts leave in one micro-batch, and that
batch's rank median reads the middle off them and appends it to the results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from medley.functions.conversions import ltz_to_utc_ntz
from medley.operators.median import check_median_input, median, median_col
from medley.session import scratch_path
from medley.streaming.event_time import event_time
from medley.streaming.folders import prune, rocksdb_state


def windowed_median(stream: DataFrame, value: str, keys: list[str] = (), ts: str = "ts",
                    window: str = "1 hour", watermark: str = "10 minutes",
                    alias: str = "median") -> DataFrame:
    check_median_input(stream, value)
    stream = event_time(stream, ts)
    win = F.window("_event_time", window)
    return (stream.withWatermark("_event_time", watermark).groupBy(win, *keys)
            .agg(median_col(value).alias(alias), F.count(value).alias("n"))
            .select(ltz_to_utc_ntz(F.col("window.start")).alias("window_start"),
                    ltz_to_utc_ntz(F.col("window.end")).alias("window_end"),
                    *keys, alias, "n"))


def window_value_counts(stream: DataFrame, value: str, keys: list[str] = (), ts: str = "ts",
                        window: str = "1 hour", watermark: str | None = "10 minutes") -> DataFrame:
    """Streaming state of the skew-safe form: count per (window, keys, value);
    without ``watermark`` the state keeps every window."""
    check_median_input(stream, value)
    stream = event_time(stream, ts)
    if watermark:
        stream = stream.withWatermark("_event_time", watermark)
    return (stream.groupBy(F.window("_event_time", window).alias("_win"), *keys,
                           F.col(value).cast("double").alias("_v"))
            .agg(F.count(F.lit(1)).alias("_c")))


def closed_window_medians(counts: DataFrame, keys: list[str] = (),
                          alias: str = "median") -> DataFrame:
    """Batch rank median of closed windows from their value counts; the same
    columns as ``windowed_median``."""
    b = counts.select(ltz_to_utc_ntz(F.col("_win.start")).alias("window_start"),
                      ltz_to_utc_ntz(F.col("_win.end")).alias("window_end"), *keys, "_v", "_c")
    m = median(b, "_v", ["window_start", "window_end", *keys], weight="_c", alias=alias,
               combine_aggs=[("n", "count", "_v")])
    return m.select("window_start", "window_end", *keys, alias, "n")


def run_windowed_median(spark: SparkSession, stream: DataFrame, value: str,
                        keys: list[str] = (), ts: str = "ts", window: str = "1 hour",
                        alias: str = "median", name: str = "windowed-median",
                        folder: str | None = None) -> DataFrame:
    """Run the skew-safe form until the input is exhausted (``availableNow``) and
    return the table of all window medians. ``folder`` (shared storage) keeps the
    stream's progress: a run that was cut short resumes there."""
    keys = list(keys)
    counts = window_value_counts(stream, value, keys, ts, window, watermark=None)
    folder = folder or scratch_path(spark, name)
    stage = f"{folder}/stage"
    spark.createDataFrame([], counts.schema).write.mode("overwrite").parquet(f"{stage}/batch=-1")

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{stage}/batch={batch_id}")

    q = (counts.writeStream.foreachBatch(keep).option("checkpointLocation", f"{folder}/checkpoint")
         .outputMode("update").trigger(availableNow=True).start())
    q.awaitTermination()
    # counts only grow, so the largest is the latest
    last = (spark.read.parquet(stage).groupBy("_win", *keys, "_v").agg(F.max("_c").alias("_c")))
    return closed_window_medians(last, keys, alias)


def start_windowed_median(spark: SparkSession, stream: DataFrame, value: str, folder: str,
                          keys: list[str] = (), ts: str = "ts", window: str = "1 hour",
                          watermark: str = "10 minutes", alias: str = "median", trigger: dict | None = None):
    """A9 without end: medians of each window appended to ``folder``/out once the
    watermark has passed its end; returns the running query. A batch that is
    replayed writes its own folder anew. State is kept in RocksDB, and that of a
    closed window is dropped; rows later than the watermark are dropped as well."""
    keys = list(keys)
    counts = window_value_counts(stream, value, keys, ts, window, watermark)
    none = closed_window_medians(spark.createDataFrame([], counts.schema), keys, alias)
    none.write.mode("overwrite").parquet(f"{folder}/out/batch=-1")

    def close(batch: DataFrame, batch_id: int) -> None:
        own = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{folder}/closed/batch={batch_id}")
        closed = own.read.schema(counts.schema).parquet(f"{folder}/closed/batch={batch_id}")
        if not closed.isEmpty():
            (closed_window_medians(closed, keys, alias)
             .write.mode("overwrite").parquet(f"{folder}/out/batch={batch_id}"))
        prune(own, f"{folder}/closed", batch_id + 1)       # only the medians stay

    with rocksdb_state(spark):
        return (counts.writeStream.foreachBatch(close).option("checkpointLocation", f"{folder}/checkpoint")
                .outputMode("append").trigger(**(trigger or {"processingTime": "10 seconds"})).start())


def window_medians(spark: SparkSession, folder: str) -> DataFrame:
    """The medians of all windows closed so far."""
    return spark.read.parquet(f"{folder}/out").drop("batch")


__all__ = ["windowed_median", "start_windowed_median", "window_medians", "window_value_counts", "closed_window_medians",
           "run_windowed_median"]
