"""Split points for cutting a value axis into buckets of bounded row count.

Shared by the rank median (value axis) and the per-key series carry (time
axis). The splits come from a count pass and a seeded sample; they only decide
how work is divided, never a result.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, functions as F

SAMPLE_PER_BUCKET = 64


def value_cuts(src: DataFrame, piece_rows: int, max_buckets: int) -> tuple[int, list | None]:
    """(number of values, bucket splits for the value axis), about one bucket
    for each ``piece_rows`` values; None where that is a single bucket.

    The count is one long per task. Split points are sketched from a seeded
    sample of about ``SAMPLE_PER_BUCKET`` rows per bucket, as Spark's range
    partitioner does, so the sketch merge stays small however many tasks there
    are. The sample only places split points: every row is still counted and
    ranked exactly, so the result never depends on it. At most ``max_buckets``
    doubles reach the driver; beyond ``piece_rows * max_buckets`` values pieces
    grow in proportion."""
    n = src.agg(F.count("_v")).first()[0] or 0
    wanted = max(1, min(max_buckets, math.ceil(n / piece_rows)))
    if wanted == 1:
        return n, None
    fraction = min(1.0, (SAMPLE_PER_BUCKET * wanted + 10_000) / n)
    rows = src if fraction >= 1.0 else src.sample(fraction=fraction, seed=17)
    probs = [i / wanted for i in range(1, wanted)]
    finite = F.when(~F.isnan("_v"), F.col("_v"))
    q = rows.agg(F.percentile_approx(finite, probs, max(10_000, 8 * wanted))).first()[0]
    finite_cuts = sorted({float(x) for x in (q or []) if x is not None and math.isfinite(x)})
    splits = [-math.inf] + finite_cuts + [math.inf]
    return n, (splits if len(splits) >= 3 else None)


def bucket_ids(df: DataFrame, value: Column, cuts: list | None, out: str = "_b") -> DataFrame:
    """``out`` = the bucket of ``value`` among ``cuts`` as a non-NULL int
    (-1 for a NULL value; NaN gets the last bucket); 0 when there are no cuts."""
    if not cuts:
        return df.withColumn(out, F.when(value.isNull(), F.lit(-1)).otherwise(F.lit(0)))
    tmp = df.withColumn("_bv", value.cast("double"))
    tmp = Bucketizer(splits=cuts, inputCol="_bv", outputCol="_bd",
                     handleInvalid="keep").transform(tmp)
    return tmp.withColumn(out, F.coalesce(F.col("_bd").cast("int"), F.lit(-1))).drop("_bv", "_bd")


__all__ = ["value_cuts", "bucket_ids", "SAMPLE_PER_BUCKET"]
