"""Aggregates that SQL calls by name, as polymorphic table functions.

A Spark SQL function may not contain an aggregate, and a grouped pandas function
would hold a whole group in one Python worker. A table function with a TABLE
argument gets each group as a stream of sorted rows instead, and keeps counters:

    SELECT * FROM my_median(
      TABLE(SELECT dept, score, count(score) OVER (PARTITION BY dept) AS n FROM exam)
        PARTITION BY dept ORDER BY score,
      value => 'score', keys => 'dept')

The column named by ``size`` ('n' unless told otherwise) holds the number of non-NULL
values of the group. With it the middle ranks are known before the first row, so
the function remembers its position and at most two values, whatever the size of
the group; Spark sorts, and spills, in the JVM. The count shares the partitioning
of the call, so the table is shuffled once.

A group called so is one task, which its sort and its count make as large as the group.
``median_pieces`` cuts groups of any size into pieces of bounded row count, values that
repeat counted instead of repeated; the function is called on every piece alike and
gives a group's row from the piece that holds its middle:

    SELECT * FROM my_median(
      TABLE(pieces) PARTITION BY (dept, piece) ORDER BY score,
      value => 'score', keys => 'dept', weight => 'copies', before => 'before')

What can be told from the columns is told at analysis: a value that is not numeric,
names that the table does not have. An input that is not sorted, or a count that
does not hold, fails the query rather than giving a wrong figure.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession, Window, functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import udtf
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from medley.errors import ArgumentTypeError
from medley.operators.cuts import bucket_ids, value_cuts
from medley.session import scratch_path

PIECE_ROWS = 100_000
MAX_BUCKETS = 65_536

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def _names(text: str | None) -> list[str]:
    return [k.strip() for k in (text or "").split(",") if k.strip()]


def _constant(argument: AnalyzeArgument | None, what: str, default: str) -> str:
    if argument is None:
        return default
    if not isinstance(argument.value, str):
        raise ArgumentTypeError(f"{what} must be a constant string")
    return argument.value


def _is_nan(x: float) -> bool:
    return x != x


class Median:
    """The exact median of each group of a sorted table (A1-A3 semantics): NULLs do
    not count, NaN is above every number, an even count gives the mean of the two
    middle values, and a group without values gives NULL."""

    @staticmethod
    def analyze(table: AnalyzeArgument, value: AnalyzeArgument, keys: AnalyzeArgument | None = None,
                size: AnalyzeArgument | None = None, weight: AnalyzeArgument | None = None,
                before: AnalyzeArgument | None = None) -> AnalyzeResult:
        if not table.isTable:
            raise ArgumentTypeError("my_median() takes a TABLE argument")
        columns = {f.name: f.dataType for f in table.dataType.fields}
        of, count = _constant(value, "value", ""), _constant(size, "size", "n")
        groups = _names(_constant(keys, "keys", ""))
        extra = [_constant(a, what, "") for a, what in ((weight, "weight"), (before, "before")) if a is not None]
        for name in [of, count, *groups, *extra]:
            if name not in columns:
                raise ArgumentTypeError(f"the table has no column {name!r}; it has {', '.join(columns)}")
        if not isinstance(columns[of], NUMERIC):
            raise ArgumentTypeError(f"my_median() needs a numeric value, not {columns[of].simpleString()}")
        schema = T.StructType([T.StructField(k, columns[k], True) for k in groups]
                              + [T.StructField("median", T.DoubleType(), True),
                                 T.StructField("n", T.LongType(), False)])
        return AnalyzeResult(schema=schema)

    def __init__(self):
        self.seen, self.n, self.low, self.last, self.median, self.group = 0, None, None, None, None, None
        self.piece = False

    def eval(self, table: Row, value: str, keys: str | None = None, size: str | None = None,
             weight: str | None = None, before: str | None = None):
        if self.n is None:
            self.n = int(table[size or "n"])
            self.group = tuple(table[k] for k in _names(keys))
            if before is not None:
                self.piece, self.seen = True, int(table[before])
        x = table[value]
        if x is None:
            return
        x = float(x)
        if self.last is not None and (x < self.last or _is_nan(self.last) and not _is_nan(x)):
            raise ValueError("my_median() needs its table sorted: PARTITION BY the keys, ORDER BY the value")
        self.last = x
        upto = self.seen + (1 if weight is None else int(table[weight]))
        if self.seen <= (self.n - 1) // 2 < upto:
            self.low = x
        if self.seen <= self.n // 2 < upto:
            if self.low is None:
                raise ValueError("my_median() needs both middle values of a group in one piece")
            self.median = x if self.n % 2 else self.low / 2 + x / 2
        self.seen = upto

    def terminate(self):
        if self.n is None:                        # no row at all: SQL gives no group
            return
        if self.seen > self.n or self.seen != self.n and not self.piece:
            raise ValueError(f"my_median() was told of {self.n} values and got {self.seen}")
        if self.piece and self.n and self.median is None:
            return                                # the middle lies in another piece
        yield (*self.group, self.median, self.n)


def median_pieces(df: DataFrame, value: str, keys: list[str], piece_rows: int = PIECE_ROWS,
                  max_buckets: int = MAX_BUCKETS) -> DataFrame:
    """The rows of ``df`` cut for ``my_median``: the keys, ``piece``, the value, ``copies``
    (rows alike in all of these), ``n`` (the group's values) and ``before`` (how many of
    them come before the piece).

    The value axis is cut at sampled quantiles into buckets of about ``piece_rows`` rows
    of all groups together; one scan counts rows per group and bucket, another collapses
    equal values with a partial aggregate. Where the two middle values of a group lie in
    two buckets, these are one piece. The cuts decide how work is dealt, never a value."""
    v = F.col(value).cast("double")
    _n, cuts = value_cuts(df.select(v.alias("_v")), piece_rows, max_buckets)
    # a struct is never NULL, so a NULL key is a group like any other in the join too
    group = F.struct(*keys) if keys else F.struct(F.lit(0).alias("_all"))
    tagged = bucket_ids(df.select(group.alias("_key"), F.col(value)), F.col(value).cast("double"), cuts)
    # written: at most buckets rows a group, and the file size tells the planner whether to broadcast
    path = scratch_path(df.sparkSession, "median-pieces")
    counts = tagged.groupBy("_key", "_b").agg(F.count(value).alias("_cnt"))
    schema = counts.schema
    counts.write.parquet(path)
    counts = df.sparkSession.read.schema(schema).parquet(path)
    along = Window.partitionBy("_key").orderBy("_b")
    counts = (counts.withColumn("n", F.sum("_cnt").over(along.rowsBetween(
                  Window.unboundedPreceding, Window.unboundedFollowing)))
              .withColumn("_upto", F.sum("_cnt").over(along.rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("_before", F.col("_upto") - F.col("_cnt")))
    # the upper middle value opens this bucket, so the lower one ends the bucket before it
    parted = (F.col("_cnt") > 0) & (F.col("n") % 2 == 0) & (F.col("_before") * 2 == F.col("n"))
    cut = counts.select("_key", "_b", "n",
                        F.when(parted, F.lag("_b").over(along)).otherwise(F.col("_b")).alias("piece"),
                        F.when(parted, F.lag("_before").over(along)).otherwise(F.col("_before")).alias("before"))
    rows = tagged.groupBy("_key", "_b", value).agg(F.count(F.lit(1)).alias("copies"))
    return rows.join(cut, ["_key", "_b"]).select(
        *[F.col("_key")[k].alias(k) for k in keys], "piece", value, "copies", "n", "before")


TABLE_AGGREGATES = {"my_median": Median}


def register_table_aggregate(spark: SparkSession, name: str, cls=Median, replace: bool = False) -> None:
    """Register a table function under a SQL name; a name that exists is an error
    unless ``replace`` (U13). ``registry.drop`` drops it (U12)."""
    if not replace and spark.catalog.functionExists(name):
        raise ValueError(f"function {name} already exists")
    spark.udtf.register(name, udtf(cls))


def register_table_aggregates(spark: SparkSession, replace: bool = True) -> list[str]:
    """Register every table aggregate of this package in the session."""
    for name, cls in TABLE_AGGREGATES.items():
        register_table_aggregate(spark, name, cls, replace)
    return list(TABLE_AGGREGATES)


__all__ = ["Median", "TABLE_AGGREGATES", "median_pieces", "register_table_aggregate", "register_table_aggregates"]
