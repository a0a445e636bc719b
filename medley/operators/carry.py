"""Skew-safe "previous row" lookup for per-key time series.

``Window.partitionBy(key).orderBy(ts)`` puts a whole key in one task; one hot
host would then be one task. Here the window is cut into (key, time bucket)
pieces and the value that enters a bucket from the past is carried by a second,
tiny window over per-bucket summaries (one row per key and bucket):

1. inside each (key, bucket): ``last(pack, ignorenulls)`` over earlier rows;
2. per (key, bucket): the latest packed row (``max`` of a struct whose first
   fields are the order columns). Catalyst computes it from the scan with a
   partial aggregate, so only one row per (key, bucket) and task is shuffled;
3. per key over buckets: the latest summary of the earlier buckets;
4. join back on (key, bucket) and take 1. if present, else 3.

Only rows passing ``good`` are candidates (a failed sample never becomes the
"previous" value: the last good one is carried over it).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from medley.functions.conversions import ntz_to_micros
from medley.operators.cuts import bucket_ids, value_cuts

# "auto": cut the time axis at sampled quantiles of all rows, so that every
# bucket holds about BUCKET_ROWS rows of all keys together (at most
# MAX_TIME_BUCKETS buckets); an int is a fixed width in seconds.
DEFAULT_BUCKET_SECONDS = "auto"
BUCKET_ROWS = 2_000
MAX_TIME_BUCKETS = 65_536


def time_bucket(ts_col: str, seconds: int) -> Column:
    """Bucket number of a timestamp column: whole epoch seconds (zone-free for
    timestamp_ntz) divided by the width. Only monotonicity in time matters
    here: the bucket decides partitioning, never a value."""
    return F.floor(F.unix_timestamp(F.col(ts_col)) / F.lit(seconds)).cast("bigint")


def with_time_bucket(df: DataFrame, ts_col: str, bucket_seconds="auto", out: str = "_tb",
                     bucket_rows: int | None = None) -> DataFrame:
    """Add the time bucket ``out``: fixed-width for an int ``bucket_seconds``;
    for "auto", buckets cut at approximate quantiles of the time column over
    all rows, at every size alike. A bucket then holds about ``bucket_rows`` rows
    of all keys together, so a (key, bucket) piece is bounded however hot the
    key is or however bursty its samples (only rows sharing one timestamp
    cannot be split). Costs a count pass and a sample pass over the time
    column; both decide partitioning, never a value."""
    if bucket_seconds != "auto":
        return df.withColumn(out, time_bucket(ts_col, int(bucket_seconds)))
    t = ntz_to_micros(F.col(ts_col)).cast("double")
    _n, cuts = value_cuts(df.select(t.alias("_v")), bucket_rows or BUCKET_ROWS, MAX_TIME_BUCKETS)
    return bucket_ids(df, t, cuts, out)


def with_previous(df: DataFrame, cols: list[str], keys: list[str], order: list[str],
                  time_col: str, good: Column | None = None,
                  bucket_seconds: int | str = DEFAULT_BUCKET_SECONDS,
                  prefix: str = "prev_") -> DataFrame:
    """Add ``prefix + c`` for every ``c`` in ``cols``: its value on the latest
    earlier row of the same key (by ``order``) for which ``good`` holds.

    ``time_col``: a timestamp_ntz that orders like ``order``; it carries the
    two-level split. Rows whose keys are NULL are one series, like any other key.
    """
    packed_fields = list(order) + [c for c in cols if c not in order]
    pack = F.struct(*[F.col(c).alias(c) for c in packed_fields])
    if good is not None:
        pack = F.when(good, pack)
    df = df.withColumn("_pack", pack)

    # one struct of the keys is never NULL and equal where its fields are, NULLs
    # too: a NULL key is a key of its own in the windows and in the join alike
    keys = [F.col(k) for k in keys]
    df = with_time_bucket(df.withColumn("_key", F.struct(*keys)), time_col, bucket_seconds)
    part = ["_key", "_tb"]
    w1 = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inner = df.withColumn("_in", F.last("_pack", ignorenulls=True).over(w1))
    summary = inner.groupBy(*part).agg(F.max("_pack").alias("_last"))
    w2 = Window.partitionBy("_key").orderBy("_tb").rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select(*part, F.last("_last", ignorenulls=True).over(w2).alias("_carry"))
    out = (inner.join(carry, part, "left")
           .withColumn("_prev", F.coalesce("_in", "_carry"))
           .drop("_in", "_carry", "_tb", "_key"))
    out = out.select("*", *[F.col("_prev")[c].alias(prefix + c) for c in cols])
    return out.drop("_pack", "_prev")


__all__ = ["with_previous", "time_bucket", "with_time_bucket", "DEFAULT_BUCKET_SECONDS"]
