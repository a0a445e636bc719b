"""The median called by name in SQL."""

import math
import random
import re
import statistics

import pytest
from pyspark.errors import AnalysisException

from medley.functions import registry, table_aggregates as ta

CALL = """SELECT * FROM my_median(
  TABLE(SELECT k, v, count(v) OVER (PARTITION BY k) AS n FROM {t}) PARTITION BY k ORDER BY v{order},
  value => 'v', keys => 'k')"""


@pytest.fixture()
def named(spark):
    ta.register_table_aggregates(spark)
    yield spark
    registry.drop(spark, "my_median", if_exists=True)


def table(spark, name, rows, ddl="k string, v double"):
    spark.createDataFrame(rows, ddl).repartition(3).createOrReplaceTempView(name)


def test_groups_nulls_nan_and_halves(named):
    rows = [("A", x) for x in (3.0, 1.0, 4.0, 1.0, 5.0)] + [("B", x) for x in (10.0, 20.0, 30.0, 40.0, None)]
    rows += [("C", None), (None, 7.0), ("D", math.nan), ("D", 1.0), ("D", 2.0), ("E", 1e308), ("E", 1.7e308)]
    table(named, "exam", rows)
    got = {r.k: (r.median, r.n) for r in named.sql(CALL.format(t="exam", order="")).collect()}
    assert got == {"A": (3.0, 5), "B": (25.0, 4), "C": (None, 0), None: (7.0, 1), "D": (2.0, 3),
                   "E": (0.5e308 + 0.85e308, 2)}


def test_against_statistics(named):
    rng = random.Random(1)
    rows = [(str(rng.randrange(7)), float(rng.randrange(40))) for _ in range(3000)]
    table(named, "many", rows)
    want = {}
    for k, v in rows:
        want.setdefault(k, []).append(v)
    got = {r.k: (r.median, r.n) for r in named.sql(CALL.format(t="many", order="")).collect()}
    assert got == {k: (statistics.median(v), len(v)) for k, v in want.items()}


def test_whole_table_decimals_and_several_keys(named):
    table(named, "sales", [("a", 1, "1.50"), ("a", 1, "2.50"), ("b", 2, "7.00")], "k string, m int, d string")
    named.sql("SELECT k, m, cast(d AS decimal(9,2)) AS d FROM sales").createOrReplaceTempView("sales")
    whole = named.sql("SELECT * FROM my_median(TABLE(SELECT d, count(d) OVER () AS n FROM sales) "
                      "WITH SINGLE PARTITION ORDER BY d, value => 'd')")
    assert whole.columns == ["median", "n"] and [tuple(r) for r in whole.collect()] == [(2.5, 3)]
    by = named.sql("SELECT * FROM my_median(TABLE(SELECT k, m, d, count(d) OVER (PARTITION BY k, m) AS size FROM sales) "
                   "PARTITION BY (k, m) ORDER BY d, value => 'd', keys => 'k, m', size => 'size')")
    assert sorted(tuple(r) for r in by.collect()) == [("a", 1, 2.0, 2), ("b", 2, 7.0, 1)]


def test_an_empty_table_has_no_groups(named):
    table(named, "nothing", [])
    assert named.sql(CALL.format(t="nothing", order="")).count() == 0


@pytest.mark.parametrize("call, part", [
    ("TABLE(SELECT k, v, 1 AS n FROM exam2) PARTITION BY k ORDER BY v, value => 'k'", "numeric"),
    ("TABLE(SELECT k, v FROM exam2) PARTITION BY k ORDER BY v, value => 'v'", "no column 'n'"),
    ("TABLE(SELECT k, v, 1 AS n FROM exam2) PARTITION BY k ORDER BY v, value => 'v', keys => 'x'", "no column 'x'"),
])
def test_refused_before_any_row(named, call, part):
    table(named, "exam2", [("a", 1.0)])
    with pytest.raises(AnalysisException, match=part):
        named.sql(f"SELECT * FROM my_median({call})").schema


def test_wrong_order_and_wrong_counts_fail(named):
    table(named, "exam3", [("a", 1.0), ("a", 2.0), ("a", 3.0)])
    with pytest.raises(Exception, match="sorted"):
        named.sql(CALL.format(t="exam3", order=" DESC")).collect()
    for n in (2, 4):
        with pytest.raises(Exception, match="was told of"):
            named.sql(f"SELECT * FROM my_median(TABLE(SELECT k, v, {n} AS n FROM exam3) PARTITION BY k ORDER BY v, "
                      "value => 'v')").collect()


def test_only_counters_are_kept():
    m, class_row = ta.Median(), dict
    for k in range(100_000):
        m.eval(class_row(v=float(k), n=100_000), "v")
    assert list(m.terminate()) == [(49_999.5, 100_000)]
    assert not any(isinstance(x, (list, dict, set)) for x in vars(m).values())


def test_drop_and_duplicate_rules(spark):
    ta.register_table_aggregate(spark, "middle")
    with pytest.raises(ValueError, match="exists"):
        ta.register_table_aggregate(spark, "middle")
    ta.register_table_aggregate(spark, "middle", replace=True)
    registry.drop(spark, "middle")
    with pytest.raises(AnalysisException):
        registry.drop(spark, "middle")
    registry.drop(spark, "middle", if_exists=True)
    with pytest.raises(AnalysisException):
        spark.sql("SELECT * FROM middle(TABLE(SELECT 1 AS v, 1 AS n) ORDER BY v, value => 'v')").schema


PIECES = """SELECT * FROM my_median(TABLE(cut) PARTITION BY (k, piece) ORDER BY v,
  value => 'v', keys => 'k', weight => 'copies', before => 'before')"""


@pytest.mark.parametrize("piece_rows", [2, 7, 40, 10_000])
def test_pieces_of_a_group_give_what_the_whole_group_gives(named, piece_rows):
    rng = random.Random(piece_rows)
    rows = [(rng.choice("ab"), float(rng.randrange(30))) for _ in range(400)] + [("c", x / 7) for x in range(100)]
    rows += [(None, 7.0), (None, 8.0), ("n", None), ("n", None), ("m", None), ("m", 2.0), ("one", math.nan)]
    rows += [("d", math.nan), ("d", 1.0), ("d", 2.0), ("t", 3.0), ("t", 3.0), ("t", 4.0), ("t", 4.0), ("t", None)]
    table(named, "groups", rows)
    whole = {r.k: (str(r.median), r.n) for r in named.sql(CALL.format(t="groups", order="")).collect()}
    cut = ta.median_pieces(named.table("groups"), "v", ["k"], piece_rows=piece_rows)
    cut.createOrReplaceTempView("cut")
    got = named.sql(PIECES).collect()
    assert len(got) == len(whole) and {r.k: (str(r.median), r.n) for r in got} == whole
    if piece_rows <= 40:                              # no task has to hold the rows of a group
        per = {(r.k, r.piece): r["count"] for r in cut.groupBy("k", "piece").count().collect()}
        assert max(per.values()) <= 4 * piece_rows and sum(k == "c" for k, _p in per) > 1


def test_pieces_of_nothing_and_of_equal_values(named):
    ta.median_pieces(named.createDataFrame([], "k string, v double"), "v", ["k"]).createOrReplaceTempView("cut")
    assert named.sql(PIECES).count() == 0
    same = named.range(50_000).selectExpr("'a' AS k", "1.5D AS v")
    cut = ta.median_pieces(same, "v", ["k"], piece_rows=100)
    assert [r.copies for r in cut.collect()] == [50_000]
    cut.createOrReplaceTempView("cut")
    assert [tuple(r) for r in named.sql(PIECES).collect()] == [("a", 1.5, 50_000)]


def test_median_by_name_does_not_count_or_sort_a_whole_group_in_one_task(spark):
    from medley.plans.queries import QUERIES
    plan = QUERIES["median_by_name"][0](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan and "piece#" in plan and re.search(r"piece#\d+ AS partition_by_2", plan)
