"""The driver-given tables and the metric samples derived from them.

There is no monitor table in the given data, so ``metric_samples`` derives one
row per event: host = user_id mod 8, device = user_id div 8, sample order = (ts, event_id), failed
read = an 'error' event. Counters are monotone functions of the event id (a
value term smaller than the id step keeps them monotone) taken modulo a bound,
which produces counter resets. ``SAMPLES_SQL`` is the same derivation for
DuckDB; both sides compute identical integers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from medley.sources.tables import bind_parquet

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]

# declared, positional schema of lineitem used by the flagship query
LINEITEM_DECLARED = ("orderkey BIGINT, partkey BIGINT, suppkey BIGINT, linenumber INT, "
                     "quantity DOUBLE, extendedprice DOUBLE, discount DOUBLE, tax DOUBLE, "
                     "returnflag STRING, linestatus STRING, shipdate DATE")


def path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(path(sf_dir, name))


def bound(spark: SparkSession, sf_dir: str, name: str, schema, mode="permissive") -> DataFrame:
    return bind_parquet(spark, path(sf_dir, name), schema, mode)


def bound_folder(spark: SparkSession, sf_dir: str, schema, mode="permissive") -> DataFrame:
    """Every Parquet file of the folder bound by position."""
    return bind_parquet(spark, sf_dir, schema, mode)


def metric_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples_from_events(table(spark, sf_dir, "events"))


def table_stream(spark: SparkSession, sf_dir: str, name: str, max_files_per_trigger: int = 1) -> DataFrame:
    """A table as a file stream, whether it is one file or a folder of part
    files. A stream source path must be a folder, so a single file is its
    parent folder with that file's name as glob. A missing table is an error
    (a stream over nothing would just stay empty)."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path(sf_dir, name))
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(at):
        raise FileNotFoundError(path(sf_dir, name))
    reader = (spark.readStream.schema(table(spark, sf_dir, name).schema)
              .option("maxFilesPerTrigger", max_files_per_trigger))
    if fs.getFileStatus(at).isDirectory():
        return reader.parquet(path(sf_dir, name))
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def events_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: int = 1) -> DataFrame:
    return table_stream(spark, sf_dir, "events", max_files_per_trigger)


def samples_from_events(e: DataFrame) -> DataFrame:
    """Derive metric samples from events (works on batch and stream frames)."""
    ok = F.coalesce(F.col("event_type") != F.lit("error"), F.lit(False))
    base = F.col("event_id") % 1_000_000
    tv = F.col("value").cast("bigint")           # truncation toward zero
    uid = F.col("user_id")

    def good(c):
        return F.when(ok, c)

    return e.select(
        F.concat(F.lit("h"), (uid % 8).cast("string")).alias("host"),
        F.expr("user_id div 8").alias("device"),
        F.col("ts"), F.col("event_id").alias("seq"), F.lit(5).alias("interval_sec"),
        ok.alias("ok"),
        good((base * 1000 + tv) % 5_000_000).alias("cpu_user"),
        good(base * 400 + (base % 37) * 3).alias("cpu_sys"),
        good(base * 2500 + (F.col("value") * 3).cast("bigint")).alias("cpu_idle"),
        good(base * 10).alias("cpu_nice"),
        good((uid % 8 + 8) * 1_073_741_824).alias("mem_total_bytes"),
        F.lit(16384).cast("bigint").alias("page_size"),
        good((F.col("value") * 1000).cast("bigint")).alias("free_pages"),
        good(base % 5000).alias("speculative_pages"),
        good((base * 23_000_000 + tv * 40_000) % 50_000_000_000).alias("disk_bytes_read"),
        good((base * 9_000_000 + (base % 97) * 50_000) % 30_000_000_000).alias("disk_bytes_written"),
        good(uid % 50 + 1).alias("connections"),
        good((base * 60_000 + tv * 100) % 900_000_000).alias("questions"),
        ((base * 7919) % 262_144).alias("load1_raw"),
        (uid % 8 * 262_144 + 4_194_304).alias("ram_total_units"),
        (F.col("value") * 5000).cast("bigint").alias("ram_free_units"),
        F.lit(4096).cast("bigint").alias("mem_unit"),
    )


SAMPLES_SQL = """
samples AS (
  SELECT 'h' || CAST(user_id % 8 AS VARCHAR) AS host, CAST(user_id // 8 AS BIGINT) AS device, ts, event_id AS seq,
         5 AS interval_sec, ok,
         CASE WHEN ok THEN ((event_id % 1000000) * 1000 + CAST(trunc(value) AS BIGINT)) % 5000000 END AS cpu_user,
         CASE WHEN ok THEN (event_id % 1000000) * 400 + ((event_id % 1000000) % 37) * 3 END AS cpu_sys,
         CASE WHEN ok THEN (event_id % 1000000) * 2500 + CAST(trunc(value * 3) AS BIGINT) END AS cpu_idle,
         CASE WHEN ok THEN (event_id % 1000000) * 10 END AS cpu_nice,
         CASE WHEN ok THEN (user_id % 8 + 8) * 1073741824 END AS mem_total_bytes,
         CAST(16384 AS BIGINT) AS page_size,
         CASE WHEN ok THEN CAST(trunc(value * 1000) AS BIGINT) END AS free_pages,
         CASE WHEN ok THEN (event_id % 1000000) % 5000 END AS speculative_pages,
         CASE WHEN ok THEN ((event_id % 1000000) * 23000000 + CAST(trunc(value) AS BIGINT) * 40000) % 50000000000 END AS disk_bytes_read,
         CASE WHEN ok THEN ((event_id % 1000000) * 9000000 + ((event_id % 1000000) % 97) * 50000) % 30000000000 END AS disk_bytes_written,
         CASE WHEN ok THEN user_id % 50 + 1 END AS connections,
         CASE WHEN ok THEN ((event_id % 1000000) * 60000 + CAST(trunc(value) AS BIGINT) * 100) % 900000000 END AS questions,
         ((event_id % 1000000) * 7919) % 262144 AS load1_raw,
         user_id % 8 * 262144 + 4194304 AS ram_total_units,
         CAST(trunc(value * 5000) AS BIGINT) AS ram_free_units,
         CAST(4096 AS BIGINT) AS mem_unit
  FROM (SELECT *, coalesce(event_type <> 'error', false) AS ok FROM events) e
)"""

# previous good sample per host (DuckDB window over the whole host: fine as an
# oracle on small data; the Spark side splits hosts by time bucket)
PREV_SQL = """
prev AS (
  SELECT s.*,
    last_value(cpu_user IGNORE NULLS) OVER w AS prev_cpu_user,
    last_value(cpu_sys IGNORE NULLS) OVER w AS prev_cpu_sys,
    last_value(cpu_idle IGNORE NULLS) OVER w AS prev_cpu_idle,
    last_value(cpu_nice IGNORE NULLS) OVER w AS prev_cpu_nice,
    last_value(disk_bytes_read IGNORE NULLS) OVER w AS prev_disk_bytes_read,
    last_value(disk_bytes_written IGNORE NULLS) OVER w AS prev_disk_bytes_written,
    last_value(questions IGNORE NULLS) OVER w AS prev_questions,
    last_value(CASE WHEN ok THEN ts END IGNORE NULLS) OVER w AS prev_ts
  FROM samples s
  WINDOW w AS (PARTITION BY host ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
deltas AS (
  SELECT *,
    CASE WHEN disk_bytes_read >= prev_disk_bytes_read THEN disk_bytes_read - prev_disk_bytes_read ELSE 0 END AS d_read,
    CASE WHEN disk_bytes_written >= prev_disk_bytes_written THEN disk_bytes_written - prev_disk_bytes_written ELSE 0 END AS d_written,
    CASE WHEN questions >= prev_questions THEN questions - prev_questions ELSE 0 END AS d_questions,
    CAST(epoch_us(ts) - epoch_us(prev_ts) AS DOUBLE) AS elapsed_us,
    cpu_user - prev_cpu_user AS du, cpu_sys - prev_cpu_sys AS ds,
    cpu_idle - prev_cpu_idle AS di, cpu_nice - prev_cpu_nice AS dn
  FROM prev
)"""

REPORT_SQL = """
report AS (
  SELECT host, ts, seq,
    CASE WHEN NOT ok THEN CAST(0.0 AS DOUBLE) WHEN prev_ts IS NULL THEN NULL
         WHEN du < 0 OR ds < 0 OR di < 0 OR dn < 0 OR du + ds + di + dn = 0 THEN CAST(0.0 AS DOUBLE)
         ELSE CAST(100.0 AS DOUBLE) * CAST(du + ds + dn AS DOUBLE) / CAST(du + ds + di + dn AS DOUBLE) END AS cpu_pct,
    mem_total_bytes // 1048576 - ((free_pages + speculative_pages) * page_size) // 1048576 AS mem_used_mb,
    mem_total_bytes // 1048576 AS mem_total_mb,
    CASE WHEN NOT ok THEN 0 WHEN prev_ts IS NULL THEN NULL
         ELSE CAST(floor(CAST(d_read AS DOUBLE) * 1e6 / elapsed_us / CAST(1024.0 AS DOUBLE)) AS BIGINT) END AS disk_read_kbps,
    CASE WHEN NOT ok THEN 0 WHEN prev_ts IS NULL THEN NULL
         ELSE CAST(floor(CAST(d_written AS DOUBLE) * 1e6 / elapsed_us / CAST(1024.0 AS DOUBLE)) AS BIGINT) END AS disk_write_kbps,
    CAST(CASE WHEN ok THEN coalesce(connections, 0) ELSE 0 END AS BIGINT) AS db_connections,
    CASE WHEN NOT ok THEN 0 WHEN prev_ts IS NULL THEN NULL
         ELSE CAST(floor(CAST(d_questions AS DOUBLE) * 1e6 / elapsed_us) AS BIGINT) END AS db_queries_ps
  FROM deltas
)"""


def with_samples(sql: str, report: bool = False) -> str:
    """Prefix an oracle statement with the samples (and report) CTEs."""
    ctes = [SAMPLES_SQL] + ([PREV_SQL, REPORT_SQL] if report else [])
    return "WITH " + ",".join(ctes) + "\n" + sql


__all__ = ["TABLES", "LINEITEM_DECLARED", "path", "table", "bound", "metric_samples",
           "with_samples", "SAMPLES_SQL"]
