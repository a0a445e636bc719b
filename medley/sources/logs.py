"""Text log sink and source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from medley.operators.logs import parse_log


def write_log(lines: DataFrame, path: str, line: str = "line", mode: str = "append") -> None:
    """One text line per row (batch). Each task writes its own part file,
    so the sink scales with the partitions and a lost task is simply redone."""
    lines.select(lines[line].alias("value")).write.mode(mode).text(path)


def write_log_stream(lines: DataFrame, path: str, checkpoint: str, line: str = "line"):
    """S14 for a streaming frame: the file sink is exactly-once with its
    checkpoint in the shared folder."""
    return (lines.select(lines[line].alias("value")).writeStream.format("text")
            .option("checkpointLocation", checkpoint).option("path", path).start())


def read_log(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Text lines back as typed columns; returns (parsed, rejects)."""
    return parse_log(spark.read.text(path).withColumnRenamed("value", "line"))


def read_log_stream(spark: SparkSession, path: str, max_files_per_trigger: int = 100):
    """S15 on a growing folder (the re-aimed ``tail -f``)."""
    raw = (spark.readStream.format("text").option("maxFilesPerTrigger", max_files_per_trigger)
           .load(path).withColumnRenamed("value", "line"))
    return parse_log(raw)


__all__ = ["write_log", "write_log_stream", "read_log", "read_log_stream"]
