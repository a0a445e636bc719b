"""Event-time column for watermarks.

Watermarks need an instant (TIMESTAMP); the tables hold UTC wall clocks as
TIMESTAMP_NTZ. The conversion goes through epoch microseconds, so it does not
depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from medley.functions.conversions import ntz_to_micros


def event_time(df: DataFrame, ts: str = "ts", out: str = "_event_time") -> DataFrame:
    dt = df.schema[ts].dataType
    if isinstance(dt, T.TimestampType):
        return df.withColumn(out, F.col(ts))
    return df.withColumn(out, F.timestamp_micros(ntz_to_micros(ts)))


__all__ = ["event_time"]
