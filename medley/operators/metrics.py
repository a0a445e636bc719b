"""Metric-sample analysis on batch tables.

Input: one row per (host, sample time) with cumulative counters and gauges:

    host string, ts timestamp_ntz, seq bigint (tie-break), interval_sec int,
    ok boolean (false = failed read),
    cpu_user, cpu_sys, cpu_idle, cpu_nice            bigint, cumulative ticks
    mem_total_bytes, page_size, free_pages, speculative_pages  bigint
    disk_bytes_read, disk_bytes_written              bigint, cumulative
    connections bigint (gauge), questions bigint (cumulative)
    load1_raw (load x 65536), ram_total_units, ram_free_units, mem_unit  bigint

* a failed sample yields 0 rates and 0 connections, and is never the
  "previous" value of a later sample: the last good counters are carried;
* a counter that went down (reset) gives delta 0 and restarts from the new
  value; CPU ticks are guarded the same way (-> 0.0);
* the first good sample of a host has no rate of its own (NULL; M11 drops it);
* two samples of a host at one instant: the later has no rate (NULL);
* rates divide by the elapsed time since the previous good sample
  (``rate_basis='elapsed'``, default) or by the configured interval
  (``'nominal'``, the reference's arithmetic).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from medley.operators.carry import DEFAULT_BUCKET_SECONDS, with_previous, with_time_bucket

KEYS = ["host"]
ORDER = ["ts", "seq"]
COUNTERS = ["cpu_user", "cpu_sys", "cpu_idle", "cpu_nice",
            "disk_bytes_read", "disk_bytes_written", "questions"]
RATE_BASES = ("elapsed", "nominal")
MIB = 1024 * 1024

# The seven status variable names and their order.
STATUS_VARIABLES = [
    "my_resource_cpu_pct",
    "my_resource_mem_used_mb",
    "my_resource_mem_total_mb",
    "my_resource_disk_read_kbps",
    "my_resource_disk_write_kbps",
    "my_resource_db_connections",
    "my_resource_db_queries_ps",
]
REPORT_COLUMNS = ["cpu_pct", "mem_used_mb", "mem_total_mb", "disk_read_kbps",
                  "disk_write_kbps", "db_connections", "db_queries_ps"]


def check_interval(seconds: int) -> int:
    """Sampling interval, 1 to 3600 seconds (default 5)."""
    if not isinstance(seconds, int) or not 1 <= seconds <= 3600:
        raise ValueError("interval must be an integer from 1 to 3600 seconds")
    return seconds


def with_previous_good(samples: DataFrame, counters: list[str] = COUNTERS,
                       bucket_seconds: int | str = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """Attach ``prev_<counter>`` and ``prev_ts`` from the last good sample."""
    return with_previous(samples, counters + ["ts"], KEYS, ORDER, good=F.col("ok"),
                         time_col="ts", bucket_seconds=bucket_seconds)


# ----------------------------------------------------------------- column rules

def counter_delta(cur: str, prev: str | None = None) -> Column:
    """M6: delta of a cumulative counter; a decrease (reset) gives 0."""
    prev = prev or f"prev_{cur}"
    c, p = F.col(cur), F.col(prev)
    return F.when(c >= p, c - p).otherwise(F.lit(0))


def _elapsed_us() -> Column:
    """Microseconds from the previous good sample: the difference of two
    timestamps is a zone-free interval, read out exactly as seconds with six
    decimals (a compact decimal, long arithmetic)."""
    iv = F.col("ts") - F.col("prev_ts")
    secs = iv.cast("interval second").cast("decimal(18,6)")
    return F.round(secs.cast("double") * F.lit(1e6)).cast("bigint")


def _per_second(delta_col: str, basis: str) -> Column:
    """floor(delta / seconds) by the chosen basis, as bigint (exact integer
    division for the nominal interval)."""
    if basis == "nominal":
        return F.expr(f"{delta_col} div interval_sec")
    if basis == "elapsed":
        return F.floor(F.try_divide(F.col(delta_col).cast("double") * F.lit(1e6),
                                    _elapsed_us().cast("double")))
    raise ValueError(f"rate_basis must be one of {RATE_BASES}")


def _kib_per_second(delta_col: str, basis: str) -> Column:
    if basis == "nominal":
        return F.expr(f"({delta_col} div interval_sec) div 1024")
    if basis == "elapsed":
        return F.floor(F.try_divide(F.col(delta_col).cast("double") * F.lit(1e6),
                                    _elapsed_us().cast("double")) / F.lit(1024.0))
    raise ValueError(f"rate_basis must be one of {RATE_BASES}")


def with_deltas(prev: DataFrame, counters: list[str]) -> DataFrame:
    """``d_<counter>``: guarded delta against the carried previous value."""
    return prev.select("*", *[counter_delta(c).alias(f"d_{c}") for c in counters])


def _guarded(value: Column, failed_value) -> Column:
    """Failed sample -> ``failed_value``; no previous good sample -> NULL."""
    return (F.when(~F.col("ok"), F.lit(failed_value))
            .when(F.col("prev_ts").isNull(), F.lit(None))
            .otherwise(value))


def cpu_pct_col() -> Column:
    """M1: 100 * (d_user + d_sys + d_nice) / (d_user + d_sys + d_idle + d_nice)."""
    d = {c: F.col(c) - F.col(f"prev_{c}") for c in ("cpu_user", "cpu_sys", "cpu_idle", "cpu_nice")}
    busy = d["cpu_user"] + d["cpu_sys"] + d["cpu_nice"]
    total = busy + d["cpu_idle"]
    any_reset = (d["cpu_user"] < 0) | (d["cpu_sys"] < 0) | (d["cpu_idle"] < 0) | (d["cpu_nice"] < 0)
    pct = (F.when(any_reset | (total == 0), F.lit(0.0))
           .otherwise(F.lit(100.0) * busy.cast("double") / total.cast("double")))
    return _guarded(pct, 0.0)


def mem_total_mb_col() -> Column:
    """M3: floor(total bytes / 2^20)."""
    return F.expr(f"mem_total_bytes div {MIB}")


def mem_used_mb_col() -> Column:
    """M3: total MB minus floor((free + speculative pages) * page size / 2^20)."""
    return F.expr(f"mem_total_bytes div {MIB} - ((free_pages + speculative_pages) * page_size) div {MIB}")


def disk_kbps_col(counter: str, basis: str = "elapsed") -> Column:
    """M5: floor(floor(delta / seconds) / 1024) with the reset guard
    (needs ``d_<counter>`` from ``with_deltas``)."""
    return _guarded(_kib_per_second(f"d_{counter}", basis), 0).cast("bigint")


def queries_per_sec_col(basis: str = "elapsed") -> Column:
    """M7: floor(delta questions / seconds) with the reset guard."""
    return _guarded(_per_second("d_questions", basis), 0).cast("bigint")


def connections_col() -> Column:
    """M8: gauge passed through; 0 when the read failed."""
    return F.when(F.col("ok"), F.coalesce(F.col("connections"), F.lit(0))).otherwise(F.lit(0)).cast("bigint")


def load_avg_col() -> Column:
    """M9: 1-minute load = raw / 65536."""
    return F.col("load1_raw") / F.lit(65536.0)


def ram_mb_cols() -> tuple[Column, Column]:
    """floor(floor(units * mem_unit / 1024) / 1024) for total and free."""
    return (F.expr("((ram_total_units * mem_unit) div 1024) div 1024"),
            F.expr("((ram_free_units * mem_unit) div 1024) div 1024"))


# ----------------------------------------------------------------- operators

def resource_report(samples: DataFrame, rate_basis: str = "elapsed",
                    bucket_seconds: int | str = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """Per sample the seven derived values (M1, M3, M5, M7, M8)."""
    if rate_basis not in RATE_BASES:
        raise ValueError(f"rate_basis must be one of {RATE_BASES}")
    return report_from_previous(with_previous_good(samples, bucket_seconds=bucket_seconds),
                                rate_basis)


def report_from_previous(prev: DataFrame, rate_basis: str = "elapsed") -> DataFrame:
    """M20 arithmetic on samples that already carry ``prev_ts`` and
    ``prev_<counter>`` (from the batch carry or from stream state, which also
    marks rows that came ``late``)."""
    p = with_deltas(prev, COUNTERS)
    return p.select(
        "host", "ts", "seq",
        cpu_pct_col().alias("cpu_pct"),
        mem_used_mb_col().alias("mem_used_mb"),
        mem_total_mb_col().alias("mem_total_mb"),
        disk_kbps_col("disk_bytes_read", rate_basis).alias("disk_read_kbps"),
        disk_kbps_col("disk_bytes_written", rate_basis).alias("disk_write_kbps"),
        connections_col().alias("db_connections"),
        queries_per_sec_col(rate_basis).alias("db_queries_ps"),
        *["late"] * ("late" in p.columns),
    )


def cpu_pct(samples: DataFrame, **kw) -> DataFrame:
    """M1."""
    p = with_previous_good(samples, ["cpu_user", "cpu_sys", "cpu_idle", "cpu_nice"], **kw)
    return p.select("host", "ts", "seq", cpu_pct_col().alias("cpu_pct"))


def mem_used_mb(samples: DataFrame) -> DataFrame:
    """M3 (no state: a pure projection)."""
    return samples.select("host", "ts", "seq", mem_used_mb_col().alias("mem_used_mb"),
                          mem_total_mb_col().alias("mem_total_mb"))


def disk_rate_kbps(samples: DataFrame, rate_basis: str = "elapsed", **kw) -> DataFrame:
    """M5."""
    disk = ["disk_bytes_read", "disk_bytes_written"]
    p = with_deltas(with_previous_good(samples, disk, **kw), disk)
    return p.select("host", "ts", "seq",
                    disk_kbps_col("disk_bytes_read", rate_basis).alias("disk_read_kbps"),
                    disk_kbps_col("disk_bytes_written", rate_basis).alias("disk_write_kbps"))


def counter_deltas(samples: DataFrame, counter: str, **kw) -> DataFrame:
    """M6: per sample the guarded delta of one counter (NULL for the first
    good sample and 0 for failed samples)."""
    p = with_previous_good(samples, [counter], **kw)
    return p.select("host", "ts", "seq", F.col(counter).alias("counter"),
                    _guarded(counter_delta(counter), 0).cast("bigint").alias("delta"))


def queries_per_sec(samples: DataFrame, rate_basis: str = "elapsed", **kw) -> DataFrame:
    """M7."""
    p = with_deltas(with_previous_good(samples, ["questions"], **kw), ["questions"])
    return p.select("host", "ts", "seq", queries_per_sec_col(rate_basis).alias("db_queries_ps"))


def connections_gauge(samples: DataFrame) -> DataFrame:
    """M8."""
    return samples.select("host", "ts", "seq", connections_col().alias("db_connections"))


def load_avg(samples: DataFrame) -> DataFrame:
    """M9."""
    return samples.select("host", "ts", "seq", load_avg_col().alias("load_avg"))


def ram_mb(samples: DataFrame) -> DataFrame:
    """M10."""
    total, free = ram_mb_cols()
    return samples.select("host", "ts", "seq", total.alias("ram_total_mb"),
                          free.alias("ram_free_mb"))


def drop_baseline(report: DataFrame) -> DataFrame:
    """Keep only samples that have a previous good sample (the first good
    sample of a host is the baseline and yields no rate of its own)."""
    return report.where(F.col("disk_read_kbps").isNotNull())


def device_sums(readings: DataFrame, cols: list[str], slot_seconds: int = 300,
                device_col: str = "device") -> DataFrame:
    """M2 / M4: cumulative counters summed over a host's devices (CPUs, drives)
    as they stood in a sampling slot: each device counts with its latest good
    reading of the slot, so a device read three times is never added to
    itself. Two aggregates, both partial before their shuffle."""
    check_interval(slot_seconds)
    slot = F.window("ts", f"{slot_seconds} seconds").start.alias("slot")
    good = readings.where("ok") if "ok" in readings.columns else readings
    order = F.struct(*[c for c in ORDER if c in readings.columns])
    latest = good.groupBy("host", slot, device_col).agg(F.max_by(F.struct(*cols), order).alias("r"))
    return (latest.groupBy("host", "slot")
            .agg(F.count(F.lit(1)).alias("devices"),
                 *[F.sum(F.col("r")[c]).alias(f"sum_{c}") for c in cols]))


def cpu_ticks_sum(readings: DataFrame, slot_seconds: int = 300, device_col: str = "device") -> DataFrame:
    """M2."""
    return device_sums(readings, ["cpu_user", "cpu_sys", "cpu_idle", "cpu_nice"], slot_seconds, device_col)


def disk_sum(readings: DataFrame, slot_seconds: int = 300, device_col: str = "device") -> DataFrame:
    """M4."""
    return device_sums(readings, ["disk_bytes_read", "disk_bytes_written"], slot_seconds, device_col)


def latest_report(samples: DataFrame, rate_basis: str = "elapsed",
                  bucket_seconds: int | str = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """The M20 row of each host's latest sample, without computing the others.

    The latest row needs only itself and its previous good sample, so only
    the rows of each host's last time bucket are windowed; the good sample
    carried into that bucket comes from per-(host, bucket) summaries, a
    partial aggregate. No step shuffles every sample.
    """
    # a struct is never NULL, so the samples without a host are a host of their own
    s = with_time_bucket(samples, "ts", bucket_seconds).withColumn("_h", F.struct("host"))
    packed = [F.col(c) for c in ["ts", "seq"] + COUNTERS]
    # scan 1 ends in a partial aggregate: per (host, bucket) the latest good row
    per_bucket = s.groupBy("_h", "_tb").agg(
        F.max(F.when(F.col("ok"), F.struct(*packed))).alias("_lg"))
    by_host = Window.partitionBy("_h").orderBy("_tb")
    last = (per_bucket
            .withColumn("_carry", F.last("_lg", ignorenulls=True).over(
                by_host.rowsBetween(Window.unboundedPreceding, -1)))
            .withColumn("_rk", F.row_number().over(by_host.orderBy(F.desc("_tb"))))
            .where(F.col("_rk") == 1).select("_h", "_tb", "_carry"))   # one row per host
    # scan 2 keeps only the rows of each host's last bucket
    recent = s.join(last, ["_h", "_tb"])
    w = Window.partitionBy("_h").orderBy("ts", "seq")
    prev = F.last(F.when(F.col("ok"), F.struct(*packed)), ignorenulls=True).over(
        w.rowsBetween(Window.unboundedPreceding, -1))
    newest = F.row_number().over(w.orderBy(F.desc("ts"), F.desc("seq")))
    rows = (recent.withColumn("_in", prev).withColumn("_rn", newest).where(F.col("_rn") == 1)
            .withColumn("_p", F.coalesce("_in", "_carry")))
    rows = rows.select("*", *[F.col("_p")[c].alias(f"prev_{c}") for c in COUNTERS + ["ts"]])
    return report_from_previous(rows, rate_basis)


def status_snapshot(report: DataFrame) -> DataFrame:
    """Latest values per host as (Variable_name, Value) rows; the CPU
    figure with 6 decimals, the others as plain integers. ``report`` may be
    the full report or ``latest_report`` (one row per host, far cheaper)."""
    latest = (report.groupBy("host")
              .agg(F.max_by(F.struct(*REPORT_COLUMNS), F.struct("ts", "seq")).alias("r"))
              .select("host", "r.*"))
    cpu = F.coalesce(F.col("cpu_pct"), F.lit(0.0))       # a figure that was never read shows 0
    text = [F.format_string("%.6f", F.round(cpu, 6)).alias(STATUS_VARIABLES[0])]
    text += [F.coalesce(F.col(c), F.lit(0)).cast("string").alias(n)
             for c, n in zip(REPORT_COLUMNS[1:], STATUS_VARIABLES[1:])]
    wide = latest.select("host", *text)
    return wide.unpivot(["host"], STATUS_VARIABLES, "Variable_name", "Value")


def status_like(snapshot: DataFrame, pattern: str) -> DataFrame:
    """Snapshot rows whose name matches a LIKE pattern (``_`` is a wildcard)."""
    return snapshot.where(F.col("Variable_name").like(pattern))


def interval_rollup(report: DataFrame, interval_seconds: int = 300) -> DataFrame:
    """One record per host and interval (tumbling, epoch aligned)."""
    check_interval(interval_seconds)
    win = F.window("ts", f"{interval_seconds} seconds").start.alias("interval_start")
    return (report.groupBy("host", win).agg(
        F.count(F.lit(1)).alias("samples"),
        F.max("cpu_pct").alias("max_cpu_pct"),
        F.max("mem_used_mb").alias("max_mem_used_mb"),
        F.sum("disk_read_kbps").alias("sum_disk_read_kbps"),
        F.sum("disk_write_kbps").alias("sum_disk_write_kbps"),
        F.max("db_connections").alias("max_db_connections"),
        F.sum("db_queries_ps").alias("sum_db_queries_ps")))


def merge_rollups(partials: DataFrame) -> DataFrame:
    """Rollups of parts of a report, merged into the rollup of the whole."""
    how = {"samples": F.sum, "max_cpu_pct": F.max, "max_mem_used_mb": F.max, "sum_disk_read_kbps": F.sum,
           "sum_disk_write_kbps": F.sum, "max_db_connections": F.max, "sum_db_queries_ps": F.sum}
    return partials.groupBy("host", "interval_start").agg(
        *[f(c).cast(partials.schema[c].dataType).alias(c) for c, f in how.items()])


__all__ = ["resource_report", "report_from_previous", "latest_report", "cpu_pct", "mem_used_mb", "disk_rate_kbps", "counter_deltas",
           "queries_per_sec", "connections_gauge", "load_avg", "ram_mb", "drop_baseline",
           "cpu_ticks_sum", "disk_sum", "status_snapshot", "status_like", "interval_rollup", "merge_rollups",
           "counter_delta", "with_deltas", "check_interval", "with_previous_good", "STATUS_VARIABLES",
           "REPORT_COLUMNS", "RATE_BASES"]
