"""A1 = A6 and A2 = A7: the rank strategy equals the built-in and a brute
force on random frames with NULLs, ties, one-row and all-NULL groups."""

import math
import statistics

from hypothesis import HealthCheck, given, settings, strategies as st

from medley.operators import median as med

value = st.one_of(st.none(), st.integers(-5, 5).map(float),
                  st.floats(-1e6, 1e6, allow_nan=False, allow_infinity=False))
rows = st.lists(st.tuples(st.sampled_from(["a", "b", "c", "d", None]), value), min_size=0, max_size=60)


def brute(vals):
    vals = [v for v in vals if v is not None]
    return statistics.median(sorted(vals)) if vals else None


def close(a, b):
    if a is None or b is None:
        return a is None and b is None
    return math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-9)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(data=rows, finish=st.sampled_from([1, 3, 1_000_000]))
def test_rank_equals_builtin_and_brute_force(spark, data, finish):
    df = spark.createDataFrame(data + [("allnull", None)], "k STRING, v DOUBLE")
    rank = {r.k: r.median for r in med.median(df, "v", ["k"], strategy="rank",
                                              piece_rows=finish, max_buckets=4).collect()}
    built = {r.k: r.median for r in med.median(df, "v", ["k"], strategy="builtin").collect()}
    assert set(rank) == set(built)
    for k in rank:
        expect = brute([v for kk, v in data if kk == k])
        assert close(rank[k], expect) and close(built[k], expect), (k, rank[k], built[k], expect)
    g = med.median(df, "v", strategy="rank", piece_rows=finish, max_buckets=4).first().median
    assert close(g, brute([v for _, v in data]))


def test_hot_group_with_heavy_ties(spark):
    # one key holds most rows, one value repeated thousands of times
    data = [("hot", 7.0)] * 3000 + [("hot", float(i)) for i in range(2000)] + \
           [("cold", 1.0), ("cold", 2.0)] + [("one", 5.0)]
    df = spark.createDataFrame(data, "k STRING, v DOUBLE")
    got = {r.k: r.median for r in med.median(df, "v", ["k"], piece_rows=100).collect()}
    assert got == {"hot": 7.0, "cold": 1.5, "one": 5.0}
    assert med.median_distributed(df, "v", piece_rows=50).first().median == 7.0


def test_piece_size_never_changes_the_answer(spark):
    data = [("a", float(i % 7)) for i in range(50)] + [("b", None), ("c", 2.0)]
    df = spark.createDataFrame(data, "k STRING, v DOUBLE")
    want = {"a": brute([v for k, v in data if k == "a"]), "b": None, "c": 2.0}
    for piece in (1, 5, 10**6):
        got = med.median(df, "v", ["k"], piece_rows=piece, max_buckets=8).collect()
        assert {r.k: r.median for r in got} == want


def test_odd_counts_give_the_middle_value_itself(spark):
    big = 1.7e308
    df = spark.createDataFrame([("a", big), ("b", big), ("b", big), ("b", 1.0), ("c", big), ("c", big)],
                               "k STRING, v DOUBLE")
    assert {r.k: r.median for r in med.median(df, "v", ["k"]).collect()} == {"a": big, "b": big, "c": big}


def test_combined_aggregates_have_the_builtin_types_and_range(spark):
    from decimal import Decimal
    df = spark.createDataFrame([(Decimal("1.00"), 2**62), (Decimal("2.00"), 2**62), (Decimal("3.25"), 2**62)],
                               "d DECIMAL(12,2), n BIGINT")
    combine = [("s", "sum", "d"), ("m", "avg", "d"), ("a", "avg", "n"), ("lo", "min", "d"), ("k", "count", "*")]
    rank = med.median(df, "d", combine_aggs=combine, piece_rows=1)
    built = med.median(df, "d", combine_aggs=combine, strategy="builtin")
    assert [f.dataType for f in rank.schema] == [f.dataType for f in built.schema]
    assert rank.collect() == built.collect()


def test_weights_count_in_combined_aggregates(spark):
    df = spark.createDataFrame([(1.0, 3), (2.0, 1), (None, 2)], "x DOUBLE, c BIGINT")
    r = med.median(df, "x", weight="c", combine_aggs=[("s", "sum", "x"), ("n", "count", "x"),
                                                      ("avg", "avg", "x"), ("rows", "count", "*")]).first()
    assert (r["median"], r.s, r.n, r.avg, r.rows) == (1.0, 5.0, 4, 1.25, 6)


def test_empty_input_gives_null_and_zero_counts(spark):
    df = spark.createDataFrame([], "v DOUBLE")
    r = med.median(df, "v", combine_aggs=[("n", "count", "*"), ("s", "sum", "v")]).first()
    assert (r["median"], r.n, r.s) == (None, 0, None)


def test_null_group_key_is_a_group_with_extra_aggregates(spark):
    from pyspark.sql import functions as F
    data = [(None, 1.0), (None, 5.0), (None, None), ("a", 2.0), ("a", None), ("n", None)]
    df = spark.createDataFrame(data, "k STRING, v DOUBLE")
    for kw in ({}, {"extra_aggs": [F.count("*").alias("rows"), F.sum("v").alias("total")]}):
        rank = med.median(df, "v", ["k"], strategy="rank", piece_rows=1, max_buckets=4, **kw)
        built = med.median(df, "v", ["k"], strategy="builtin", **kw)
        assert sorted(rank.collect(), key=str) == sorted(built.collect(), key=str)
        assert {r.k: r.median for r in rank.collect()} == {None: 3.0, "a": 2.0, "n": None}


def _shuffled_records(plan):
    """Records written to shuffles in an executed plan (py4j walk over its nodes)."""
    total, name = 0, plan.nodeName()
    if name.startswith("AdaptiveSparkPlan"):
        return _shuffled_records(plan.executedPlan())
    if name.startswith(("ShuffleQueryStage", "BroadcastQueryStage", "ResultQueryStage")):
        return _shuffled_records(plan.plan())
    metric = plan.metrics().get("shuffleRecordsWritten")
    if metric.isDefined():
        total += metric.get().value()
    children = plan.children()
    return total + sum(_shuffled_records(children.apply(i)) for i in range(children.size()))


def test_only_target_buckets_are_shuffled(spark):
    """The value column is not shuffled as a whole: what reaches the final sort
    is the one or two target buckets of each key."""
    n = 40_000
    df = spark.range(0, n, numPartitions=4).selectExpr("CAST(id % 3 AS STRING) AS k", "CAST(id * 7919 % 40009 AS DOUBLE) AS v")
    out = med.median(df, "v", ["k"], piece_rows=400)
    rows = {r.k: r.median for r in out.collect()}
    want = {r.k: r.median for r in med.median(df, "v", ["k"], strategy="builtin").collect()}
    assert rows == want
    assert _shuffled_records(out._jdf.queryExecution().executedPlan()) < n / 10


COMBINE = [("rows", "count", "*"), ("nv", "count", "v"), ("total", "sum", "v"),
           ("lo", "min", "v"), ("hi", "max", "v"), ("mean", "avg", "v")]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(data=rows)
def test_combined_aggregates_equal_direct_ones(spark, data):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(data + [("allnull", None)], "k STRING, v DOUBLE")
    extra = [F.count(F.lit(1)).alias("rows2")]
    for keys in (["k"], []):
        rank = med.median(df, "v", keys, strategy="rank", piece_rows=1, max_buckets=4,
                          combine_aggs=COMBINE, extra_aggs=extra)
        built = med.median(df, "v", keys, strategy="builtin", combine_aggs=COMBINE, extra_aggs=extra)
        assert rank.columns == built.columns
        a = {tuple(r[c] for c in keys): r for r in rank.collect()}
        b = {tuple(r[c] for c in keys): r for r in built.collect()}
        assert set(a) == set(b)
        for key in a:
            for c in rank.columns:
                x, y = a[key][c], b[key][c]
                assert (close(x, y) if isinstance(x, float) or isinstance(y, float) else x == y), (key, c, x, y)


def test_key_types_with_nulls_and_nested_key(spark):
    import datetime as dt
    d1 = dt.date(2024, 1, 1)
    data = [(d1, 1, [1], 1.0), (d1, 1, [1], 3.0), (None, None, None, 4.0), (None, None, None, 8.0),
            (d1, None, [2], 5.0), (None, 2, [2], None)]
    df = spark.createDataFrame(data, "d DATE, i INT, a ARRAY<INT>, v DOUBLE")
    for keys in (["d", "i"], ["a"], ["a", "d"]):
        rank = med.median(df, "v", keys, strategy="rank", piece_rows=1, max_buckets=4)
        built = med.median(df, "v", keys, strategy="builtin")
        assert rank.schema == built.schema, (rank.schema, built.schema)
        assert sorted(map(str, rank.collect())) == sorted(map(str, built.collect()))


def test_weighted_rows_equal_expanded_rows(spark):
    counts = [("a", 1.0, 3), ("a", 9.0, 1), ("a", None, 5), ("b", 2.0, 2), ("b", 4.0, 2), ("c", None, 1)]
    w = spark.createDataFrame(counts, "k STRING, v DOUBLE, c BIGINT")
    expanded = spark.createDataFrame([(k, v) for k, v, c in counts for _ in range(c)], "k STRING, v DOUBLE")
    got = {r.k: r.median for r in med.median(w, "v", ["k"], weight="c", piece_rows=1, max_buckets=4).collect()}
    want = {r.k: r.median for r in med.median(expanded, "v", ["k"], strategy="builtin").collect()}
    assert got == want == {"a": 1.0, "b": 3.0, "c": None}
