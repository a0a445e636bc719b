"""M19 with rows put in order first: the resource report of a stream whose rows may
come late.

``run_resource_report`` (metrics_stream) gives a late row no rate. Here a row waits
until the watermark, which follows the newest sample by ``bound``, has passed its
time; then no earlier row can come any more, and the host's waiting rows leave in
order of (ts, seq), each with the last good counters before it. So a row late by
less than the bound gets its own rate, and the row after it the right one: the
result is that of the batch report whatever the order of arrival within the bound.
Later rows are dropped by the watermark, as in any windowed stream. A host that was
silent for ``forget_after`` is forgotten: its next sample is a first one.

``start_ordered_report`` and ``run_ordered_report`` handle each micro-batch as a table.
The rows that wait (those of the last ``bound``), the last good sample of each host and
the watermark lie in folders keyed by batch id, overwritten by a replay and pruned
behind the batch at work; the rows that leave go through the batch report's two-level
carry, so neither a host with most of the rows nor a first batch that holds a whole
table is one task, and no row passes through Python.

``ordered_report_stream`` is the form with Spark's keyed state, a streaming frame for
further streaming operators: ``transformWithState`` in RocksDB keeps the waiting rows, the
last good counters and one event-time timer per host. The rows of one host that wait are
sorted in one task, row by row in Python, so it is for streams of small hosts.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from medley.functions.conversions import micros_to_ntz, ntz_to_micros
from medley.operators import metrics as mx
from medley.session import scratch_path
from medley.streaming.event_time import event_time
from medley.streaming.folders import batches, prune

GOOD = T.StructType([T.StructField(c, T.LongType()) for c in ["ts", *mx.COUNTERS]])

DUE = T.StructType([T.StructField("ts", T.LongType())])


class InOrder(StatefulProcessor):
    """Attaches ``prev_ts`` and ``prev_<counter>`` to the rows of one host, in order."""

    def __init__(self, columns: T.StructType, forget_us: int | None):
        self.columns, self.forget_us = columns, forget_us
        names = columns.names
        self.ts, self.seq, self.ok = (names.index(c) for c in ("ts", "seq", "ok"))
        self.counters = [names.index(c) for c in mx.COUNTERS]
        self.names = [*names, *(f"prev_{c}" for c in GOOD.names)]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", self.columns)
        self.good = handle.getValueState("good", GOOD)
        self.due = handle.getValueState("due", DUE)       # time of the first row that waits

    def _wake(self, at_us: int) -> None:
        """One timer per host, at the millisecond after ``at_us``."""
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        self.handle.registerTimer(at_us // 1000 + 1)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        least, block = None, []
        for row in rows:
            least = row[self.ts] if least is None else min(least, row[self.ts])
            block.append(tuple(row))
            if len(block) == 1000:
                self.waiting.appendList(block)
                block = []
        if block:
            self.waiting.appendList(block)
        due = self.due.get()[0] if self.due.exists() else None
        if least is not None and (due is None or least < due):
            self.due.update((least,))
            self._wake(least)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        rows = [tuple(r) for r in self.waiting.get()]
        ready = sorted((r for r in rows if r[self.ts] <= now),
                       key=lambda r: (r[self.ts], r[self.seq] is not None, r[self.seq]))
        rest = [r for r in rows if r[self.ts] > now]
        good = tuple(self.good.get()) if self.good.exists() else None
        out, made = [], Row(*self.names)
        for r in ready:
            if good and self.forget_us is not None and r[self.ts] > good[0] + self.forget_us:
                good = None                           # whenever the timer came
            out.append(made(*r, *(good or (None,) * len(GOOD))))
            if r[self.ok]:
                good = (r[self.ts], *(r[c] for c in self.counters))
        if good:
            self.good.update(good)
        elif ready:
            self.good.clear()
        if rest:
            if ready:
                self.waiting.put(rest)
            due = min(r[self.ts] for r in rest)
            self.due.update((due,))
            self._wake(due)
        else:
            self.waiting.clear()
            self.due.clear()
            if good and self.forget_us is not None:
                if now >= good[0] + self.forget_us:
                    self.good.clear()
                else:
                    self._wake(good[0] + self.forget_us)
        return iter(out)

    def close(self) -> None:
        pass


def _as_numbers(samples: DataFrame) -> DataFrame:
    """Samples with ``ts`` as microseconds; rows without a time have no place in an
    order and are left out."""
    return samples.where("ts is not null").withColumn("ts", ntz_to_micros("ts"))


def _as_times(rows: DataFrame) -> DataFrame:
    return rows.withColumn("ts", micros_to_ntz("ts")).withColumn("prev_ts", micros_to_ntz("prev_ts"))


def ordered_report_stream(samples: DataFrame, bound_seconds: int = 600, forget_after: int | None = 86_400,
                          rate_basis: str = "elapsed") -> DataFrame:
    """M19 + M20 on a stream: the batch report's columns, each row once its time is
    ``bound_seconds`` past. ``forget_after`` (seconds, None: never) must be more than
    the bound. Start it inside ``folders.rocksdb_state``."""
    if forget_after is not None and forget_after <= bound_seconds:
        raise ValueError("forget_after must be more than bound_seconds")
    timed = event_time(samples.where("ts is not null"), "ts").withWatermark("_event_time", f"{bound_seconds} seconds")
    rows = _as_numbers(timed)
    kept = T.StructType([f for f in rows.schema if f.name != "_event_time"])
    out = T.StructType(kept.fields + [T.StructField(f"prev_{f.name}", f.dataType) for f in GOOD])
    forget_us = None if forget_after is None else forget_after * 1_000_000
    ordered = (rows.select(*kept.names, "_event_time").groupBy("host")
               .transformWithState(InOrder(kept, forget_us), out, "append", "eventTime"))
    return mx.report_from_previous(_as_times(ordered), rate_basis)


GOOD_ROWS = T.StructType([T.StructField("host", T.StringType()), T.StructField("ts", T.TimestampNTZType())]
                         + [T.StructField(c, T.LongType()) for c in mx.COUNTERS])
MARKS = T.StructType([T.StructField("before_us", T.LongType()), T.StructField("now_us", T.LongType())])


def _read(spark: SparkSession, folder: str, name: str, batch_id: int, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{folder}/{name}/batch={batch_id}")


def _carried(rows: DataFrame, good: DataFrame, forget_after: int | None) -> DataFrame:
    """``prev_ts`` and ``prev_<counter>`` of the rows, after the last good samples before
    them. These enter as rows of their own; their seq only breaks ties."""
    before = good.withColumn("ok", F.lit(True)).withColumn("seq", F.lit(None).cast("bigint"))
    rows = rows.withColumn("_row", F.lit(True)).unionByName(before, allowMissingColumns=True)
    out = mx.with_previous_good(rows).where("_row").drop("_row")
    if forget_after is None:
        return out
    silent = ntz_to_micros("ts") > ntz_to_micros("prev_ts") + F.lit(forget_after * 1_000_000)
    return out.withColumns({f"prev_{c}": F.when(~F.coalesce(silent, F.lit(False)), F.col(f"prev_{c}"))
                            for c in GOOD.names})


def _last_good(rows: DataFrame, good: DataFrame) -> DataFrame:
    """The last good sample of each host, NULL being a host like any other."""
    fresh = rows.where("ok").select(*GOOD_ROWS.names, F.col("seq").alias("_seq"))
    both = fresh.unionByName(good.withColumn("_seq", F.lit(None).cast("bigint")))
    last = both.groupBy("host").agg(F.max_by(F.struct(*GOOD_ROWS.names[1:]), F.struct("ts", "_seq")).alias("g"))
    return last.select("host", *[F.col("g")[f.name].cast(f.dataType).alias(f.name) for f in GOOD_ROWS.fields[1:]])


def _ordered_writer(spark: SparkSession, samples: DataFrame, folder: str, bound_seconds: int,
                    forget_after: int | None, rate_basis: str, behind: bool):
    """The stream writer. A batch gives out the rows that the watermark after it has
    passed and drops those that the watermark before it had; with ``behind``, both go by
    the watermarks of one batch earlier, which batches that follow one another at once
    have in Spark, and what has not left is for ``waiting_report``."""
    if forget_after is not None and forget_after <= bound_seconds:
        raise ValueError("forget_after must be more than bound_seconds")
    bound_us, schema = bound_seconds * 1_000_000, samples.schema
    if not batches(spark, f"{folder}/marks"):
        none, no_good = spark.createDataFrame([], schema), spark.createDataFrame([], GOOD_ROWS)
        none.write.mode("overwrite").parquet(f"{folder}/waiting/batch=-1")
        no_good.write.mode("overwrite").parquet(f"{folder}/good/batch=-1")
        first = mx.report_from_previous(_carried(none, no_good, forget_after), rate_basis)
        first.write.mode("overwrite").parquet(f"{folder}/out/batch=-1")
        spark.createDataFrame([(None, None)], MARKS).write.mode("overwrite").parquet(f"{folder}/marks/batch=-1")

    def emit(batch: DataFrame, batch_id: int) -> None:
        own = batch.sparkSession
        batch.where("ts is not null").write.mode("overwrite").parquet(f"{folder}/rows/batch={batch_id}")
        arrived = _read(own, folder, "rows", batch_id, schema)
        before, now = _read(own, folder, "marks", batch_id - 1, MARKS).first()
        newest = arrived.agg(F.max(ntz_to_micros("ts"))).first()[0]
        after = max((m for m in (now, None if newest is None else newest // 1000 * 1000 - bound_us)
                     if m is not None), default=None)
        late, due = (before, now) if behind else (now, after)
        us = ntz_to_micros("ts")
        rows = arrived if late is None else arrived.where(us > late)
        rows = _read(own, folder, "waiting", batch_id - 1, schema).unionByName(rows)
        good = _read(own, folder, "good", batch_id - 1, GOOD_ROWS)
        if due is not None:
            ready, rows = rows.where(us <= due), rows.where(us > due)
            report = mx.report_from_previous(_carried(ready, good, forget_after), rate_basis)
            report.write.mode("overwrite").parquet(f"{folder}/out/batch={batch_id}")
            good = _last_good(ready, good)
            if forget_after is not None:
                good = good.where(us > due - forget_after * 1_000_000)
        rows.write.mode("overwrite").parquet(f"{folder}/waiting/batch={batch_id}")
        good.write.mode("overwrite").parquet(f"{folder}/good/batch={batch_id}")
        (own.createDataFrame([(now, after)], MARKS).coalesce(1)
         .write.mode("overwrite").parquet(f"{folder}/marks/batch={batch_id}"))
        prune(own, f"{folder}/rows", batch_id)
        for name in ("waiting", "good", "marks"):
            prune(own, f"{folder}/{name}", batch_id - 1)

    return samples.writeStream.foreachBatch(emit).option("checkpointLocation", f"{folder}/checkpoint")


def start_ordered_report(spark: SparkSession, samples: DataFrame, folder: str, bound_seconds: int = 600,
                         forget_after: int | None = 86_400, rate_basis: str = "elapsed",
                         trigger: dict | None = None):
    """The report as a running query into ``folder``/out (Parquet, one folder per batch, each
    overwritten by a replay). Started again with the same folder it goes on where it stopped."""
    writer = _ordered_writer(spark, samples, folder, bound_seconds, forget_after, rate_basis, behind=False)
    return writer.trigger(**(trigger or {"processingTime": "5 seconds"})).start()


def waiting_report(spark: SparkSession, folder: str, rate_basis: str = "elapsed",
                   forget_after: int | None = None) -> DataFrame:
    """The report of the rows that still wait, read from a stopped query's folders and
    not taken from them: what a run that ends with its input has not given out yet."""
    last = batches(spark, f"{folder}/marks")[-1]
    waiting = spark.read.parquet(f"{folder}/waiting/batch={last}")
    return mx.report_from_previous(
        _carried(waiting, _read(spark, folder, "good", last, GOOD_ROWS), forget_after), rate_basis)


def run_ordered_report(spark: SparkSession, samples: DataFrame, bound_seconds: int = 600,
                       rate_basis: str = "elapsed", folder: str | None = None) -> DataFrame:
    """The report until the input is exhausted, the rows that still wait included.
    Nothing is forgotten in between."""
    folder = folder or scratch_path(spark, "ordered-report")
    writer = _ordered_writer(spark, samples, folder, bound_seconds, None, rate_basis, behind=True)
    writer.trigger(availableNow=True).start().awaitTermination()
    done = waiting_report(spark, folder, rate_basis)
    return spark.read.schema(done.schema).parquet(f"{folder}/out").drop("batch").unionByName(done)


__all__ = ["InOrder", "ordered_report_stream", "start_ordered_report", "run_ordered_report",
           "waiting_report"]
