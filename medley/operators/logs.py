"""Monitor log lines: formatting (M14, M15) and parsing back.

Java's ``%.Nf`` rounds the shortest decimal form half-up while C rounds the
exact binary value; values are therefore ``round``-ed to N places first, so
the text is the same as printing the rounded number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The two line formats and their parse patterns.
RESOURCE_FORMAT = ("my_resource: CPU=%.1f%% | MEM=%d/%dMB | DISK_R=%dKB/s DISK_W=%dKB/s"
                   " | CONN=%d | QPS=%d")
OS_FORMAT = "[os_logger] CPU Load: %.2f, RAM: %d/%d MB"
RESOURCE_PATTERN = (r"my_resource: CPU=(-?[0-9]+\.[0-9]+)% \| MEM=(-?[0-9]+)/(-?[0-9]+)MB"
                    r" \| DISK_R=(-?[0-9]+)KB/s DISK_W=(-?[0-9]+)KB/s"
                    r" \| CONN=(-?[0-9]+) \| QPS=(-?[0-9]+)")
OS_PATTERN = r"\[os_logger\] CPU Load: (-?[0-9]+\.[0-9]+), RAM: ([0-9]+)/([0-9]+) MB"

RESOURCE_FIELDS = [("cpu_pct", "double"), ("mem_used_mb", "bigint"), ("mem_total_mb", "bigint"),
                   ("disk_read_kbps", "bigint"), ("disk_write_kbps", "bigint"),
                   ("db_connections", "bigint"), ("db_queries_ps", "bigint")]
OS_FIELDS = [("load_avg", "double"), ("ram_free_mb", "bigint"), ("ram_total_mb", "bigint")]


def _z(name: str, zero) -> Column:
    return F.coalesce(F.col(name), F.lit(zero))


def resource_line_col() -> Column:
    """M14 line from the seven report columns (NULL figures print as 0, the
    monitor's initial value)."""
    return F.format_string(
        RESOURCE_FORMAT, F.round(_z("cpu_pct", 0.0), 1), _z("mem_used_mb", 0),
        _z("mem_total_mb", 0), _z("disk_read_kbps", 0), _z("disk_write_kbps", 0),
        _z("db_connections", 0), _z("db_queries_ps", 0))


def os_line_col(load="load_avg", free="ram_free_mb", total="ram_total_mb") -> Column:
    """M15 line: load with 2 decimals, free/total RAM in MB."""
    return F.format_string(OS_FORMAT, F.round(F.col(load), 2), F.col(free), F.col(total))


def resource_lines(report: DataFrame) -> DataFrame:
    return report.select("host", "ts", "seq", resource_line_col().alias("line"))


def os_lines(samples: DataFrame) -> DataFrame:
    from medley.operators.metrics import load_avg_col, ram_mb_cols
    total, free = ram_mb_cols()
    return samples.select("host", "ts", "seq", F.format_string(
        OS_FORMAT, F.round(load_avg_col(), 2), free, total).alias("line"))


def _extract(line: Column, pattern: str, fields) -> list[Column]:
    """The fields of the first match of ``pattern`` in ``line``: the whole
    match is taken once and split at the non-numeric text between the
    numbers (in both formats the fixed text holds no digit, dot or minus), so
    the full pattern runs once per line instead of once per field. No match:
    every field is NULL."""
    numbers = F.split(F.regexp_extract(line, pattern, 0), r"[^0-9.\-]+")
    # element 0 is the (empty) text before the first number
    return [F.get(numbers, i + 1).try_cast(t).alias(n) for i, (n, t) in enumerate(fields)]


def parse_resource_lines(df: DataFrame, line: str = "line") -> DataFrame:
    """M14 lines -> typed columns; lines that do not match get NULLs."""
    return df.select("*", *_extract(F.col(line), RESOURCE_PATTERN, RESOURCE_FIELDS))


def parse_os_lines(df: DataFrame, line: str = "line") -> DataFrame:
    return df.select("*", *_extract(F.col(line), OS_PATTERN, OS_FIELDS))


def parse_log(df: DataFrame, line: str = "line") -> tuple[DataFrame, DataFrame]:
    """Any mix of M14 / M15 lines -> (parsed, rejects).

    ``parsed`` has a ``kind`` column ('resource' or 'os') and the fields of
    both formats (NULL where not applicable); ``rejects`` holds the lines that
    match neither format.
    """
    c = F.col(line)
    kind = (F.when(c.rlike(RESOURCE_PATTERN), F.lit("resource"))
            .when(c.rlike(OS_PATTERN), F.lit("os")))
    tagged = df.withColumn("kind", kind)
    parsed = tagged.where(F.col("kind").isNotNull()).select(
        "*", *_extract(c, RESOURCE_PATTERN, RESOURCE_FIELDS), *_extract(c, OS_PATTERN, OS_FIELDS))
    rejects = tagged.where(F.col("kind").isNull()).drop("kind")
    return parsed, rejects


__all__ = ["resource_line_col", "os_line_col", "resource_lines", "os_lines",
           "parse_resource_lines", "parse_os_lines", "parse_log", "RESOURCE_FORMAT",
           "OS_FORMAT", "RESOURCE_PATTERN", "OS_PATTERN"]
