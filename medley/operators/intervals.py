"""A record for every interval, whether anything was read in it or not, and
M17: intervals whose width changes over time.

``interval_records`` is the rollup plus a record for each interval between a host's
first and last sample in which nothing was read: no samples, no rates, and the
gauges (memory, connections) as they were last read. What lies between two
intervals of a host that have samples is found with the skew-safe carry, so a
host of many intervals is not one task; a gap is cut into runs of ``RUN`` intervals,
which are dealt over the tasks before they become rows, so neither is a host that
was silent for years.

The rollup is made from partial records (``interval_partials``) that can be merged
(``merge_partials``), so a stream keeps one small table per micro-batch.

``settings`` is a small table (effective_from timestamp_ntz, interval_sec int). An
interval is as wide as the setting in force at its start says, counted from the
moment the setting came into force, and ends where the next setting does. Before
the first setting the default width holds, counted from the epoch.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from medley.functions.conversions import micros_to_ntz, ntz_to_micros
from medley.operators.carry import with_previous
from medley.operators.metrics import check_interval
from medley.session import scratch_path

RUN = 4096              # intervals of a gap that one row stands for
MOST_SETTINGS = 1000    # interval settings that one expression looks through
GAUGES = ["mem_used_mb", "db_connections"]
FIGURES = {"max_cpu_pct": "max", "max_mem_used_mb": "max", "sum_disk_read_kbps": "sum",
           "sum_disk_write_kbps": "sum", "max_db_connections": "max", "sum_db_queries_ps": "sum"}
RECORD = ["host", "interval_start", "interval_sec", "samples", *FIGURES]


@dataclass(frozen=True)
class Setting:
    """A width in force from a moment (microseconds since 1970) on."""
    from_us: int
    seconds: int


def fixed(seconds: int) -> list[Setting]:
    """One width for all time, counted from the epoch."""
    return [Setting(0, check_interval(seconds))]


def read_settings(settings: DataFrame, default: int = 300) -> list[Setting]:
    """The settings in order of time, the default first. Of settings with one
    ``effective_from`` the last in order of width holds; NULLs are ignored. More
    than ``MOST_SETTINGS`` rows are refused: this is a parameter table."""
    rows = (settings.where("effective_from is not null and interval_sec is not null")
            .groupBy(ntz_to_micros("effective_from").alias("us")).agg(F.max("interval_sec").alias("s"))
            .orderBy("us").limit(MOST_SETTINGS + 1).collect())
    if len(rows) > MOST_SETTINGS:
        raise ValueError(f"more than {MOST_SETTINGS} interval settings")
    return fixed(default) + [Setting(r.us, check_interval(int(r.s))) for r in rows]


def interval_of(ts: str, settings: list[Setting]) -> tuple[Column, Column]:
    """(start, width in seconds) of the interval a timestamp_ntz lies in."""
    us = ntz_to_micros(ts)
    first, *later = settings

    def start(s: Setting) -> Column:
        return us - F.pmod(us - s.from_us, F.lit(s.seconds * 1_000_000))

    begin, width = start(first), F.lit(first.seconds)
    for s in later:                                  # ascending: the last that is in force stays
        begin = F.when(us >= s.from_us, start(s)).otherwise(begin)
        width = F.when(us >= s.from_us, F.lit(s.seconds)).otherwise(width)
    return begin, width


def interval_partials(report: DataFrame, settings: list[Setting]) -> DataFrame:
    """Partial records of (a part of) a report: figures that merge, and the last
    gauges read. One partial aggregate; rows without a time are left out."""
    start, width = interval_of("ts", settings)
    read = F.when(F.col("mem_used_mb").isNotNull(), F.struct("ts", "seq", *GAUGES))
    return (report.where("ts is not null").withColumn("interval_start", micros_to_ntz(start))
            .withColumn("interval_sec", width).groupBy("host", "interval_start", "interval_sec")
            .agg(F.count(F.lit(1)).alias("samples"),
                 *[getattr(F, how)(c.split("_", 1)[1]).alias(c) for c, how in FIGURES.items()],
                 F.max(read).alias("gauges")))


def merge_partials(partials: DataFrame) -> DataFrame:
    """Partial records of parts of a report, merged into those of the whole."""
    how = {"samples": "sum", **FIGURES, "gauges": "max"}
    return partials.groupBy("host", "interval_start", "interval_sec").agg(
        *[getattr(F, f)(c).cast(partials.schema[c].dataType).alias(c) for c, f in how.items()])


def _gaps(partials: DataFrame, settings: list[Setting]) -> DataFrame:
    """(host, gauges, from_us, upto_us, width) of each stretch without samples, cut at
    the moments a setting comes into force; gauges as last read before it."""
    here = with_previous(partials, ["interval_start", "interval_sec"], ["host"], ["interval_start"],
                         time_col="interval_start")
    here = with_previous(here, ["gauges"], ["host"], ["interval_start"], time_col="interval_start",
                         good=F.col("gauges").isNotNull())
    begin = ntz_to_micros("prev_interval_start") + F.col("prev_interval_sec").cast("bigint") * 1_000_000
    end = ntz_to_micros("interval_start")
    spans = []
    for s, nxt in zip(settings, [*settings[1:], None]):
        low = F.lit(None).cast("bigint") if s is settings[0] else F.lit(s.from_us)
        high = F.lit(None).cast("bigint") if nxt is None else F.lit(nxt.from_us)
        spans.append(F.struct(low.alias("low"), high.alias("high"), F.lit(s.from_us).alias("origin"),
                              F.lit(s.seconds).alias("width")))
    cut = (here.where("prev_interval_start is not null")
           # a setting that came into force ends the interval before it early
           .select("host", F.col("prev_gauges").alias("gauges"), begin.alias("b"), end.alias("e"),
                   ntz_to_micros("prev_interval_start").alias("p"), F.explode(F.array(*spans)).alias("s"))
           .where("(s.low is null or e > s.low) and (s.high is null or p < s.high)")
           .withColumn("width", F.col("s.width").cast("bigint") * 1_000_000)
           # the previous interval lies in this setting's time, or the setting begins after it
           .withColumn("from_us", F.when(F.col("s.low").isNull() | (F.col("p") >= F.col("s.low")), F.col("b"))
                       .otherwise(F.col("s.low")))
           .withColumn("upto_us", F.least("e", F.coalesce("s.high", "e"))))
    return cut.where("from_us < upto_us").select("host", "gauges", "from_us", "upto_us", "width")


def _filled(partials: DataFrame, settings: list[Setting]) -> DataFrame:
    """Records of the intervals without samples."""
    spark = partials.sparkSession
    runs = (_gaps(partials, settings)
            .withColumn("n", F.expr("(upto_us - from_us + width - 1) div width"))
            .withColumn("k", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1, F.lit(RUN).cast("bigint")))))
    # a row of a run is small whatever comes of it: dealt out by number, not by size
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    runs = runs.repartition(parts, "host", "from_us", "k")
    rows = runs.select("*", F.explode(F.sequence(F.col("k"), F.least(F.col("n") - 1, F.col("k") + RUN - 1))).alias("i"))
    types = partials.schema
    values = {"samples": F.lit(0), "max_cpu_pct": F.lit(0.0), "max_mem_used_mb": F.col("gauges.mem_used_mb"),
              "max_db_connections": F.coalesce("gauges.db_connections", F.lit(0))}
    return rows.select(
        "host", micros_to_ntz(F.col("from_us") + F.col("i") * F.col("width")).alias("interval_start"),
        F.expr("int(width div 1000000)").alias("interval_sec"),
        *[values.get(c, F.lit(0)).cast(types[c].dataType).alias(c) for c in ["samples", *FIGURES]])


def records_from_partials(partials: DataFrame, settings: list[Setting]) -> DataFrame:
    """One record per host and interval from the host's first to its last sample.
    The partial records are written first: the search for gaps reads them several times."""
    path = scratch_path(partials.sparkSession, "interval-partials")
    partials.write.parquet(path)
    kept = partials.sparkSession.read.schema(partials.schema).parquet(path)
    return kept.select(*RECORD).unionByName(_filled(kept, settings))


def interval_records(report: DataFrame, interval_seconds: int = 300,
                     settings: DataFrame | None = None) -> DataFrame:
    """M18 over a report (M20), complete: host, interval_start, interval_sec, samples and
    the rollup's figures. An interval without samples has 0 samples, 0 rates and CPU,
    and the memory and connections last read (memory NULL before the first reading).
    A NULL host is a host. With ``settings`` the width follows the table (M17)."""
    widths = fixed(interval_seconds) if settings is None else read_settings(settings, interval_seconds)
    return records_from_partials(interval_partials(report, widths), widths)


__all__ = ["Setting", "fixed", "read_settings", "interval_of", "interval_partials", "merge_partials",
           "records_from_partials", "interval_records", "RECORD"]
