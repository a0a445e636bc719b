"""Metric samples on unbounded streams.

``run_resource_report`` / ``start_resource_report`` handle each micro-batch as a
table: the rows go through the batch report's two-level carry, so a host with
half of all rows is split over time buckets, and a small state table (a row per
host: last row seen, last good counters) links one micro-batch to the next.
State and output folders are keyed by batch id and overwritten, so a replayed
batch leaves one copy; both lie in a folder the caller may name, so a stopped
stream resumes.

``resource_report_stream`` is the form with Spark's keyed state, for streams
whose hosts are all small: ``lag`` is not allowed on a stream, so the "previous good sample" of each
host lives in keyed state (``applyInPandasWithState``). The state function
only attaches ``prev_ts`` / ``prev_<counter>``; the rate arithmetic is the
same column expressions as the batch report (``report_from_previous``), so
stream and batch results are equal by construction.

Ordering: rows of one host inside one micro-batch are sorted by (ts, seq); a
row at or before the last row already processed for its host (a late arrival
from an earlier micro-batch) is kept, flagged ``late`` and gets no rate, so a
late row can never be mistaken for a counter reset. State per host is one row.
The rows of one host inside one micro-batch are handled by one task: bound
micro-batches with ``maxFilesPerTrigger`` / ``maxBytesPerTrigger``.
"""

from __future__ import annotations

from typing import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from medley.functions.conversions import ltz_to_utc_ntz
from medley.operators import intervals as iv, metrics as mx
from medley.streaming.event_time import event_time
from medley.streaming.folders import batches, prune
from medley.session import scratch_path

COUNTERS = mx.COUNTERS
_STATE = T.StructType(
    [T.StructField("seen_us", T.LongType()), T.StructField("seen_seq", T.LongType()),
     T.StructField("good_us", T.LongType())]
    + [T.StructField(c, T.LongType()) for c in COUNTERS])
_EPOCH = pd.Timestamp("1970-01-01")


def _to_us(ts: pd.Series) -> pd.Series:
    return ((ts - _EPOCH) // pd.Timedelta(microseconds=1)).astype("Int64")


def _carry(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    pdf = pd.concat(list(batches), ignore_index=True)
    pdf = pdf.sort_values(["ts", "seq"], kind="stable").reset_index(drop=True)
    if state.exists:
        st = state.get
        seen_us, seen_seq, good_us = st[0], st[1], st[2]
        good_vals = list(st[3:])
    else:
        seen_us = seen_seq = good_us = None
        good_vals = [None] * len(COUNTERS)

    ts_us = _to_us(pdf["ts"])
    if seen_us is not None:
        late = (ts_us < seen_us) | ((ts_us == seen_us) & (pdf["seq"] <= seen_seq))
    else:
        late = pd.Series(False, index=pdf.index)
    late = late.fillna(False).astype(bool)
    ok = pdf["ok"].fillna(False).astype(bool) & ~late

    # previous good value = last good value strictly before the row
    frame = pd.DataFrame({"_us": ts_us.where(ok)})
    for c in COUNTERS:
        frame[c] = pdf[c].astype("Int64").where(ok)
    prev = frame.shift(1).ffill()
    first = {"_us": good_us, **dict(zip(COUNTERS, good_vals))}
    prev = prev.fillna({k: v for k, v in first.items() if v is not None})

    out = pdf.copy()
    out["prev_ts"] = _EPOCH + pd.to_timedelta(prev["_us"].astype("float64"), unit="us")
    out.loc[prev["_us"].isna(), "prev_ts"] = pd.NaT
    for c in COUNTERS:
        out[f"prev_{c}"] = prev[c].astype("Int64")
    out["late"] = late
    out.loc[late, "prev_ts"] = pd.NaT

    on_time = ~late
    if on_time.any():
        last = pdf[on_time].iloc[-1]
        seen_us, seen_seq = int(ts_us[on_time].iloc[-1]), int(last["seq"])
    goods = pdf[ok]
    if len(goods):
        g = goods.iloc[-1]
        good_us = int(ts_us[ok].iloc[-1])
        good_vals = [None if pd.isna(g[c]) else int(g[c]) for c in COUNTERS]
    state.update((seen_us, seen_seq, good_us, *good_vals))
    yield out


def with_previous_good_stream(samples: DataFrame) -> DataFrame:
    """M19 state step: attach ``prev_ts``, ``prev_<counter>`` and ``late``."""
    out_schema = T.StructType(
        samples.schema.fields
        + [T.StructField("prev_ts", T.TimestampNTZType())]
        + [T.StructField(f"prev_{c}", T.LongType()) for c in COUNTERS]
        + [T.StructField("late", T.BooleanType())])
    return samples.groupBy("host").applyInPandasWithState(
        _carry, out_schema, _STATE, "append", GroupStateTimeout.NoTimeout)


def resource_report_stream(samples: DataFrame, rate_basis: str = "elapsed") -> DataFrame:
    """M19 + M20 on a stream: the batch report arithmetic over stream state.
    Late rows keep their gauges and get NULL rates."""
    # a late row has prev_ts NULL, so its guarded rates are NULL
    return mx.report_from_previous(with_previous_good_stream(samples), rate_basis)


REPORT_STATE = T.StructType([T.StructField("host", T.StringType()),
                             T.StructField("seen", T.StructType([T.StructField("ts", T.TimestampNTZType()),
                                                                 T.StructField("seq", T.LongType())])),
                             T.StructField("good", T.StructType(
                                 [T.StructField("ts", T.TimestampNTZType()), T.StructField("seq", T.LongType())]
                                 + [T.StructField(c, T.LongType()) for c in COUNTERS]))])


def report_batch(batch: DataFrame, state: DataFrame, rate_basis: str = "elapsed"):
    """(report rows, new state) of one micro-batch and the state before it. Rows
    at or before their host's last seen row are ``late``: kept, without rates,
    and never anyone's previous sample."""
    here = F.struct("ts", "seq")
    # hosts meet as structs, which are never NULL, so rows without a host have state too
    seen = state.select(F.struct("host").alias("_h"), F.col("seen").alias("_seen"))
    rows = batch.withColumn("_h", F.struct("host")).join(seen, "_h", "left")
    rows = rows.withColumn("late", F.coalesce(here <= F.col("_seen"), F.lit(False))).drop("_seen", "_h")
    on_time = rows.where(~F.col("late"))
    # the last good sample of each host enters as a row of its own
    before = state.where("good is not null").select("host", "good.*").withColumn("ok", F.lit(True))
    before = before.withColumn("late", F.lit(None).cast("boolean"))
    carried = mx.with_previous_good(on_time.unionByName(before, allowMissingColumns=True))
    carried = carried.where("late is not null")
    late = rows.where("late")
    for c in ["ts", *COUNTERS]:
        late = late.withColumn(f"prev_{c}", F.lit(None).cast(carried.schema[f"prev_{c}"].dataType))
    report = mx.report_from_previous(carried.unionByName(late), rate_basis)
    packed = F.struct("ts", "seq", *[F.col(c).cast("bigint").alias(c) for c in COUNTERS])
    fresh = on_time.groupBy("host").agg(F.max(here).alias("seen"), F.max(F.when(F.col("ok"), packed)).alias("good"))
    merged = (state.select("host", "seen", "good").unionByName(fresh).groupBy("host")
              .agg(F.max("seen").alias("seen"), F.max("good").alias("good")))
    return report, merged


def _report_writer(spark: SparkSession, samples: DataFrame, folder: str, rate_basis: str, also=None):
    """The stream writer whose batches go through ``report_batch``. ``also(report)``, if
    given, makes a further table of each batch's report, kept under ``also``.

    What only links the batches is pruned: of the state, the batch before the one at
    work stays (a replayed batch starts from it); of the rows, the one at work."""
    none = spark.createDataFrame([], samples.schema)
    empty = spark.createDataFrame([], REPORT_STATE)
    first = report_batch(none, empty, rate_basis)[0]
    first.write.mode("overwrite").parquet(f"{folder}/out/batch=-1")
    if also:
        also(first).write.mode("overwrite").parquet(f"{folder}/also/batch=-1")
    if not batches(spark, f"{folder}/state"):
        empty.write.mode("overwrite").parquet(f"{folder}/state/batch=-1")

    def emit(batch: DataFrame, batch_id: int) -> None:
        own = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{folder}/rows/batch={batch_id}")
        rows = own.read.schema(samples.schema).parquet(f"{folder}/rows/batch={batch_id}")
        state = own.read.schema(REPORT_STATE).parquet(f"{folder}/state/batch={batch_id - 1}")
        report, merged = report_batch(rows, state, rate_basis)
        report.write.mode("overwrite").parquet(f"{folder}/out/batch={batch_id}")
        merged.write.mode("overwrite").parquet(f"{folder}/state/batch={batch_id}")
        if also:
            done = own.read.schema(report.schema).parquet(f"{folder}/out/batch={batch_id}")
            also(done).write.mode("overwrite").parquet(f"{folder}/also/batch={batch_id}")
        prune(own, f"{folder}/state", batch_id - 1)
        prune(own, f"{folder}/rows", batch_id)

    return samples.writeStream.foreachBatch(emit).option("checkpointLocation", f"{folder}/checkpoint")


def run_resource_report(spark: SparkSession, samples: DataFrame, rate_basis: str = "elapsed",
                        folder: str | None = None) -> DataFrame:
    """M19 + M20 until the input is exhausted; the report of all rows with
    ``late``. ``folder`` (shared storage) keeps progress, so a run can resume."""
    folder = folder or scratch_path(spark, "resource-report")
    _report_writer(spark, samples, folder, rate_basis).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{folder}/out").drop("batch")


def run_interval_rollup(spark: SparkSession, samples: DataFrame, interval_seconds: int = 300,
                        rate_basis: str = "elapsed", folder: str | None = None) -> DataFrame:
    """M18 until the input is exhausted, with the columns of the batch rollup: each
    micro-batch leaves partial aggregates of its report, and these are merged. No
    watermark, so late rows count and open intervals are in the result. A ``folder``
    resumes as in ``run_resource_report``; it keeps one interval from its start."""
    mx.check_interval(interval_seconds)
    folder = folder or scratch_path(spark, "interval-rollup")
    writer = _report_writer(spark, samples, folder, rate_basis, lambda r: mx.interval_rollup(r, interval_seconds))
    writer.trigger(availableNow=True).start().awaitTermination()
    return mx.merge_rollups(spark.read.parquet(f"{folder}/also").drop("batch"))


SETTINGS = "effective_from timestamp_ntz, interval_sec int"


def settings_now(spark: SparkSession, path: str | None, default: int) -> list[iv.Setting]:
    """The interval settings as the table at ``path`` (Parquet) has them now; a
    table that isn't there yet has none."""
    if path is None:
        return iv.fixed(default)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return iv.fixed(default)
    return iv.read_settings(spark.read.schema(SETTINGS).parquet(path), default)


def interval_writer(spark: SparkSession, samples: DataFrame, folder: str, interval_seconds: int = 300,
                    settings: str | None = None, rate_basis: str = "elapsed"):
    """The stream writer of ``interval_records``: every micro-batch reads the parameter
    table at ``settings`` anew, so a width changes while the query runs, from the
    event time the setting names on. Samples that a micro-batch handled before a
    setting was written keep the interval they were put in."""
    mx.check_interval(interval_seconds)

    def partial(report: DataFrame) -> DataFrame:
        own = report.sparkSession
        return iv.interval_partials(report, settings_now(own, settings, interval_seconds))

    return _report_writer(spark, samples, folder, rate_basis, partial)


def stream_records(spark: SparkSession, folder: str, interval_seconds: int = 300,
                   settings: str | None = None) -> DataFrame:
    """What a query of ``interval_writer`` has recorded so far, one record per host
    and interval between its first and last sample, intervals without samples too."""
    parts = spark.read.parquet(f"{folder}/also").drop("batch")
    return iv.records_from_partials(iv.merge_partials(parts), settings_now(spark, settings, interval_seconds))


def run_interval_records(spark: SparkSession, samples: DataFrame, interval_seconds: int = 300,
                         settings: str | None = None, rate_basis: str = "elapsed",
                         folder: str | None = None) -> DataFrame:
    """M18 (and M17, with ``settings``) until the input is exhausted; equal to the batch
    ``interval_records`` of the same report."""
    folder = folder or scratch_path(spark, "interval-records")
    writer = interval_writer(spark, samples, folder, interval_seconds, settings, rate_basis)
    writer.trigger(availableNow=True).start().awaitTermination()
    return stream_records(spark, folder, interval_seconds, settings)


def start_resource_report(spark: SparkSession, samples: DataFrame, folder: str, interval_seconds: int = 5,
                          rate_basis: str = "elapsed"):
    """The same as an endless stream that looks for new samples every
    ``interval_seconds``; returns the running query. Stop it and start it anew
    with another interval and the same folder to change the interval."""
    mx.check_interval(interval_seconds)
    writer = _report_writer(spark, samples, folder, rate_basis)
    return writer.trigger(processingTime=f"{interval_seconds} seconds").start()


def interval_rollup_stream(samples: DataFrame, interval_seconds: int = 300,
                           watermark: str = "10 minutes") -> DataFrame:
    """M18 counts on a stream as it goes: one record per host and tumbling interval,
    emitted once the watermark passes the interval end (append mode); without rates,
    rows behind the watermark and open intervals, which ``run_interval_rollup`` has."""
    mx.check_interval(interval_seconds)
    samples = event_time(samples, "ts")
    win = F.window("_event_time", f"{interval_seconds} seconds")
    return (samples.withWatermark("_event_time", watermark).groupBy("host", win)
            .agg(F.count(F.lit(1)).alias("samples"),
                 F.sum(F.when(~F.col("ok"), 1).otherwise(0)).alias("failed"),
                 F.max(mx.connections_col()).alias("max_db_connections"),
                 F.max("questions").alias("max_questions"))
            .select("host", ltz_to_utc_ntz(F.col("window.start")).alias("interval_start"), "samples",
                    "failed", "max_db_connections", "max_questions"))


def samples_stream(spark: SparkSession, folder: str, schema: T.StructType,
                   glob: str = "*.parquet", max_files_per_trigger: int = 1) -> DataFrame:
    """Parquet files arriving in ``folder`` as a stream (bounded micro-batches)."""
    return (spark.readStream.schema(schema).option("pathGlobFilter", glob)
            .option("maxFilesPerTrigger", max_files_per_trigger).parquet(folder))


def run_to_table(spark: SparkSession, stream: DataFrame, name: str,
                 output_mode: str = "append", folder: str | None = None) -> DataFrame:
    """Run a stream until its input is exhausted (``availableNow``) into a
    Parquet table; return the table. The file sink with its checkpoint is
    exactly-once, so a lost executor is replayed; with a ``folder`` of the
    caller's a later run resumes where this one ended."""
    folder = folder or scratch_path(spark, name)
    out, ckpt = f"{folder}/out", f"{folder}/checkpoint"
    q = (stream.writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", ckpt).outputMode(output_mode)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


__all__ = ["run_resource_report", "start_resource_report", "report_batch", "with_previous_good_stream", "resource_report_stream", "interval_rollup_stream", "run_interval_rollup",
           "run_interval_records", "interval_writer", "stream_records", "settings_now",
           "samples_stream", "run_to_table"]
