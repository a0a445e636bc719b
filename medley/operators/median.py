"""Exact median, global and per group.

Semantics: one numeric argument, converted to double; NULLs skipped; no
non-NULL value -> NULL (the group row stays); odd n -> middle value, even n ->
mean of the two middle values; NaN sorts greatest (Spark's order).

Strategies
----------
``rank`` (default)  exact rank selection, one plan for every size; no task ever
             holds a whole group:

  1. the value axis is cut at approximate quantiles into buckets of about
     ``piece_rows`` values (a bounded array of at most ``max_buckets`` doubles
     reaches the driver, sketched from a seeded sample as Spark's range
     partitioner does);
  2. one scan counts rows per (keys, bucket), partially aggregated, and carries
     the combinable aggregates along: at most keys x buckets rows are shuffled;
  3. a running sum over a key's buckets locates the one or two buckets that hold
     ranks (n-1) div 2 and n div 2;
  4. a second scan keeps only the rows of those buckets (a join on (keys, bucket)
     before any shuffle when the bucket table is small, as its file size tells
     the planner), collapses ties and reads the two middle values off.

  The answer is exact whatever the quality of the quantiles; they only decide
  how many rows step 4 handles.

``builtin``  ``F.median``, on request only: one aggregate pass, but the final
             buffer of a group holds every distinct value of that group in one
             task's memory. Right for small groups.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from medley.errors import ArgumentCountError, ArgumentTypeError
from medley.operators.cuts import bucket_ids, value_cuts as _cuts
from medley.session import scratch_path

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)

STRATEGIES = ("rank", "builtin")
PIECE_ROWS = 4_096
MAX_BUCKETS = 65_536


def check_median_input(df: DataFrame, *cols) -> str:
    """Exactly one numeric argument; text, boolean, date etc. are refused
    before any row is read."""
    if len(cols) != 1:
        raise ArgumentCountError("median() requires exactly one argument")
    name = cols[0]
    if not isinstance(name, str):
        raise ArgumentTypeError("median() takes a column name")
    dt = df.select(name).schema.fields[0].dataType
    if not isinstance(dt, _NUMERIC):
        raise ArgumentTypeError(
            f"median() accepts REAL, INT or DECIMAL arguments, not {dt.simpleString()}")
    return name


def median_col(col) -> Column:
    """Built-in exact median of a numeric column as double (A1/A2 small path)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.median(c.cast("double"))


def median(df: DataFrame, value: str, keys: list[str] | tuple = (),
           strategy: str = "rank", alias: str = "median",
           extra_aggs: list[Column] | None = None, piece_rows: int = PIECE_ROWS,
           max_buckets: int = MAX_BUCKETS,
           combine_aggs: list[tuple[str, str, str]] | None = None,
           weight: str | None = None) -> DataFrame:
    """Exact median of ``value`` per group of ``keys`` (global when empty).

    ``extra_aggs`` (any aggregate Columns) are computed in the same grouping
    (A3). ``combine_aggs`` are ``(alias, function, column)`` triples with
    function ``sum``, ``count``, ``min``, ``max`` or ``avg`` (column ``*``
    counts rows): on the rank path they ride in the bucket count, so no further
    scan of the input is needed for them, which ``extra_aggs`` do need; their
    types are those of the built-in aggregates. Every group of the input appears
    once, with NULL when it has no non-NULL value (A4, A5). ``weight`` names a
    count column: each row then stands for that many copies of itself, for the
    median and for ``combine_aggs`` (``extra_aggs`` are refused, as their meaning
    is not known)."""
    check_median_input(df, value)
    keys = list(keys)
    extra = list(extra_aggs or [])
    combine = [_check_combine(t) for t in (combine_aggs or [])]
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}")
    if weight is not None and (strategy == "builtin" or extra):
        raise ValueError("weight needs the rank strategy and no extra_aggs")
    if strategy == "builtin":
        return _builtin(df, value, keys, alias, extra, combine)
    src = df.select(F.col(value).cast("double").alias("_v"))
    _n, cuts = _cuts(src, piece_rows, max_buckets)
    return _rank_median(df, value, keys, alias, extra, cuts, combine, weight)


COMBINABLE = ("sum", "count", "min", "max", "avg")


def _check_combine(t):
    alias, fn, col = t
    if fn not in COMBINABLE:
        raise ValueError(f"combine_aggs function must be one of {COMBINABLE}, not {fn!r}")
    if col == "*" and fn != "count":
        raise ValueError("'*' is only allowed with count")
    return alias, fn, col


def _direct(fn, col) -> Column:
    if col == "*":
        return F.count(F.lit(1))
    return {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max, "avg": F.avg}[fn](col)


def _integral(df, col) -> bool:
    return isinstance(df.schema[col].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))


def _partials(df, combine, weight) -> list[Column]:
    """Per (keys, bucket) partial states of the combinable aggregates."""
    copies = F.coalesce(F.col(weight), F.lit(0)) if weight else None

    def total(c):
        return F.sum(c * copies) if weight else F.sum(c)

    def present(col):
        return F.sum(F.when(F.col(col).isNotNull(), copies)) if weight else F.count(col)

    out = []
    for i, (_a, fn, col) in enumerate(combine):
        if col == "*":
            continue                                   # the row count itself
        if fn == "avg":                                # integers add up as doubles, as in avg()
            c = F.col(col).cast("double") if _integral(df, col) else F.col(col)
            out += [total(c).alias(f"_ps{i}"), present(col).alias(f"_pc{i}")]
        elif fn == "sum":
            out.append(total(F.col(col)).alias(f"_p{i}"))
        elif fn == "count":
            out.append(present(col).alias(f"_p{i}"))
        else:
            out.append(_direct(fn, col).alias(f"_p{i}"))
    return out


def _finals(combine, types) -> list[Column]:
    """Per key, the combinable aggregates merged from their partial states."""
    out = []
    for i, (alias, fn, col) in enumerate(combine):
        if col == "*":
            c = F.coalesce(F.sum("_rows"), F.lit(0))
        elif fn == "avg":
            c = F.sum(f"_ps{i}") / F.sum(f"_pc{i}")
        elif fn == "count":
            c = F.coalesce(F.sum(f"_p{i}"), F.lit(0))
        else:
            c = {"sum": F.sum, "min": F.min, "max": F.max}[fn](f"_p{i}")
        out.append(c.cast(types[alias]).alias(alias))
    return out


def _builtin(df, value, keys, alias, extra, combine=()):
    direct = [_direct(fn, col).alias(a) for a, fn, col in combine]
    return df.groupBy(*keys).agg(median_col(value).alias(alias), *direct, *extra)


def median_by_group(df, value, keys, strategy="rank", **kw) -> DataFrame:
    """A2 / A7."""
    return median(df, value, keys, strategy=strategy, **kw)


def median_distributed(df, value, **kw) -> DataFrame:
    """Exact global median with no single-task value buffer."""
    return median(df, value, (), strategy="rank", **kw)


# --------------------------------------------------------------------------- rank path

_KEY_DEFAULTS = {T.StringType: "", T.BooleanType: False, T.BinaryType: b""}


def _key_default(dt):
    """A non-NULL stand-in of the key's type, or None when there is none."""
    if isinstance(dt, _NUMERIC):
        return F.lit(0).cast(dt)
    if isinstance(dt, T.DateType):
        return F.date_from_unix_date(F.lit(0))
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return F.timestamp_micros(F.lit(0)).cast(dt)
    for t, v in _KEY_DEFAULTS.items():
        if isinstance(dt, t):
            return F.lit(v).cast(dt)
    return None


def _encode_keys(df, keys):
    """Each group key k becomes (coalesce(k, default), isnull(k)): non-NULL
    columns, so every join below is a plain equi-join (no IS NOT NULL filter
    inferred into one branch, and the aggregates' hash partitioning serves the
    joins) while a NULL key still is its own group, as in GROUP BY. Returns
    (frame, internal keys, columns restoring the keys, plain joins are safe)."""
    enc, restore, internal = [], [], []
    for i, k in enumerate(keys):
        d = _key_default(df.schema[k].dataType)
        if d is None:                       # nested key type: keep it, join null-safe
            internal.append(k)
            restore.append(F.col(k))
            continue
        enc += [F.coalesce(F.col(k), d).alias(f"_k{i}"), F.col(k).isNull().alias(f"_z{i}")]
        internal += [f"_k{i}", f"_z{i}"]
        restore.append(F.when(F.col(f"_z{i}"), F.lit(None).cast(df.schema[k].dataType))
                       .otherwise(F.col(f"_k{i}")).alias(k))
    plain = all(c.startswith("_k") or c.startswith("_z") for c in internal)
    # the original columns stay (the value or extra aggregates may read a key)
    return df.select(*enc, *df.columns), internal, restore, plain


def _rank_median(df, value, keys, alias, extra, cuts, combine=(), weight=None):
    spark = df.sparkSession
    out_keys = list(keys)
    types = {f.name: f.dataType for f in df.groupBy().agg(
        *[_direct(fn, col).alias(a) for a, fn, col in combine] or [F.count(F.lit(1)).alias("_")]).schema}
    if not keys:
        # a constant group key keeps every join below an equi-join
        df, keys = df.withColumn("_g", F.lit(0)), ["_g"]
        restore, join = [], _join_plain
    else:
        df, keys, restore, plain = _encode_keys(df, keys)
        join = _join_plain if plain else _join_null_safe
    copies = F.coalesce(F.col(weight).cast("bigint"), F.lit(0)) if weight else F.lit(1).cast("bigint")
    v = F.col(value).cast("double")
    # NULL values get bucket -1 and weight 0, so that their group keeps its row
    tagged = bucket_ids(df, v, cuts).withColumn("_copies", copies)
    tagged = tagged.withColumn("_w", F.when(v.isNull(), F.lit(0)).otherwise(F.col("_copies")))

    # 2. rows per (keys, bucket), written: at most buckets rows a key, read twice
    #    below, and its size on disk tells the planner whether to broadcast
    path = scratch_path(spark, "median-buckets")
    per_bucket = tagged.groupBy(*keys, "_b").agg(
        F.sum("_w").alias("_cnt"), F.sum("_copies").alias("_rows"), *_partials(df, combine, weight))
    schema = per_bucket.schema
    per_bucket.write.parquet(path)
    per_bucket = spark.read.schema(schema).parquet(path)
    summary = (per_bucket.groupBy(*keys) if out_keys else per_bucket.groupBy()).agg(
        F.sum("_cnt").alias("_n"), *_finals(combine, types))
    if not out_keys:   # a global aggregate has its one row even for an empty input
        summary = summary.withColumn("_g", F.lit(0))
    if extra:
        more = (df.groupBy(*keys) if out_keys else df.groupBy()).agg(*extra)
        if not out_keys:
            more = more.withColumn("_g", F.lit(0))
        summary = join(summary, more, keys)

    # 3. over the buckets of a key a running count and the key's total give the ranks
    by_key = Window.partitionBy(*keys).orderBy("_b")
    before = by_key.rowsBetween(Window.unboundedPreceding, -1)
    whole = by_key.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = (per_bucket.select(*keys, "_b", "_cnt")
              .withColumn("_before", F.coalesce(F.sum("_cnt").over(before), F.lit(0)))
              .withColumn("_n", F.sum("_cnt").over(whole))
              .withColumn("_rlo", F.expr("(_n - 1) div 2")).withColumn("_rhi", F.expr("_n div 2")))

    def holds(rank):
        return ((F.col("_before") <= F.col(rank)) & (F.col(rank) < F.col("_before") + F.col("_cnt")))

    path = scratch_path(spark, "median-targets")
    targets = ranked.where(holds("_rlo") | holds("_rhi")).select(*keys, "_b", "_before", "_rlo", "_rhi")
    schema = targets.schema
    targets.write.parquet(path)                        # 1 or 2 rows a key
    targets = spark.read.schema(schema).parquet(path)

    # 4. exact ranks inside the target buckets: only their rows pass the join
    near = join(tagged.where("_w > 0").select(*keys, "_b", v.alias("_v"), "_w"), targets, keys + ["_b"])
    ties = near.groupBy(*keys, "_b", "_before", "_rlo", "_rhi", "_v").agg(F.sum("_w").alias("_w"))
    along = Window.partitionBy(*keys, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ties = (ties.withColumn("_upto", F.col("_before") + F.sum("_w").over(along))
            .withColumn("_from", F.col("_upto") - F.col("_w")))

    def covers(rank):
        return (F.col("_from") <= F.col(rank)) & (F.col(rank) < F.col("_upto"))

    picked = (ties.where(covers("_rlo") | covers("_rhi")).groupBy(*keys).agg(
        F.first("_rlo").alias("_lo"), F.first("_rhi").alias("_hi"),
        F.min(F.when(covers("_rlo"), F.col("_v"))).alias("_vlo"),
        F.max(F.when(covers("_rhi"), F.col("_v"))).alias("_vhi")))
    # odd n: the middle value itself; even n: halves are added, which cannot overflow
    med = F.when(F.col("_lo") == F.col("_hi"), F.col("_vlo")).otherwise(
        F.col("_vlo") / F.lit(2.0) + F.col("_vhi") / F.lit(2.0)).alias(alias)
    out = join(summary, picked, keys, "left")
    return out.select(*restore, med, *[F.col(c) for c in summary.columns if c not in keys and c != "_n"])


def _join_plain(left: DataFrame, right: DataFrame, cols: list[str], how: str = "inner"):
    return left.join(right, cols, how)


def _join_null_safe(left: DataFrame, right: DataFrame, cols: list[str], how: str = "inner"):
    """Equi-join on ``cols`` where NULL matches NULL (a NULL group key is a
    group, as in GROUP BY). Still a hash/sort-merge equi-join, and no
    IS NOT NULL filter is inferred and pushed into either side."""
    r = right.select(*[F.col(c).alias(f"_r{i}") for i, c in enumerate(cols)],
                     *[c for c in right.columns if c not in cols])
    cond = functools.reduce(lambda a, b: a & b,
                            [left[c].eqNullSafe(r[f"_r{i}"]) for i, c in enumerate(cols)])
    return left.join(r, cond, how).drop(*[f"_r{i}" for i in range(len(cols))])


__all__ = ["median", "median_by_group", "median_distributed", "median_col",
           "check_median_input", "STRATEGIES"]
