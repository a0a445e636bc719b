"""M19 in order: rows that come late, within the bound and beyond it; A9 without end."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from medley.operators import median as med, metrics as mx
from medley.streaming import median_stream, ordered_report as orr
from medley.streaming.folders import rocksdb_state
from medley.streaming.metrics_stream import samples_stream
from tests.test_intervals import feed, made
from tests.test_metrics import COLS, T0, row


def stream(spark, folder):
    return samples_stream(spark, folder, spark.createDataFrame([], COLS).schema, max_files_per_trigger=1)


def same(a, b):
    assert sorted(map(str, a.select(sorted(a.columns)).collect())) == sorted(map(str, b.select(sorted(b.columns)).collect()))


@pytest.fixture(scope="module")
def rows():
    return made(random.Random(8), ["a", "b", None], 60, span=900)


def arrivals(spark, rows, bound, files, seed):
    """Files of rows, each row arriving up to ``bound`` seconds of event time late."""
    rng = random.Random(seed)
    order = sorted(rows, key=lambda r: r[1] + dt.timedelta(seconds=rng.uniform(0, bound)))
    n = len(order)
    return [spark.createDataFrame(order[k * n // files:(k + 1) * n // files], COLS) for k in range(files)]


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_within_the_bound_gives_the_batch_report(spark, rows, tmp_path, seed):
    feed(spark, str(tmp_path / "in"), arrivals(spark, rows, 590, 7, seed))
    out = orr.run_ordered_report(spark, stream(spark, str(tmp_path / "in")), bound_seconds=600)
    same(out, mx.resource_report(spark.createDataFrame(rows, COLS)))


def test_a_late_row_gets_its_rate_and_mends_the_next(spark, tmp_path):
    def sample(sec, seq, q):
        return row("a", sec, seq, True, q, q, q, 0, q * 10**6, q, 1, q)
    first = [sample(0, 1, 0), sample(10, 3, 200)]
    late = [sample(5, 2, 150), sample(2000, 4, 400)]
    feed(spark, str(tmp_path / "in"), [spark.createDataFrame(x, COLS) for x in (first, late)])
    out = orr.run_ordered_report(spark, stream(spark, str(tmp_path / "in")), bound_seconds=60)
    assert {r.seq: r.db_queries_ps for r in out.collect()} == {1: None, 2: 30, 3: 10, 4: 0}


def test_rows_beyond_the_bound_are_dropped_and_results_come_while_it_runs(spark, tmp_path):
    def sample(sec, seq):
        return row("a", sec, seq, True, seq, seq, seq, 0, seq, seq, 1, seq)
    folder = str(tmp_path / "work")
    feed(spark, str(tmp_path / "in"), [spark.createDataFrame([sample(0, 1), sample(100, 2)], COLS),
                                       spark.createDataFrame([sample(500, 3)], COLS)])
    query = orr.start_ordered_report(spark, stream(spark, str(tmp_path / "in")), folder, 60,
                                     trigger={"processingTime": "1 second"})
    try:
        query.processAllAvailable()
        feed(spark, str(tmp_path / "in"), [spark.createDataFrame([sample(50, 9), sample(900, 4)], COLS)])
        query.processAllAvailable()
        done = spark.read.parquet(f"{folder}/out")
        assert sorted(r.seq for r in done.collect()) == [1, 2, 3]      # 4 waits, 9 came too late
    finally:
        query.stop()
    assert [r.seq for r in orr.waiting_report(spark, folder).collect()] == [4]
    # the same folder goes on, with the last good sample of before the stop
    feed(spark, str(tmp_path / "in"), [spark.createDataFrame([sample(1000, 5), sample(2000, 6)], COLS)])
    query = orr.start_ordered_report(spark, stream(spark, str(tmp_path / "in")), folder, 60, trigger={"availableNow": True})
    query.awaitTermination()
    out = {r.seq: r for r in spark.read.parquet(f"{folder}/out").collect()}
    assert sorted(out) == [1, 2, 3, 4, 5] and out[4].cpu_pct is not None


def test_a_silent_host_is_forgotten(spark, tmp_path):
    def sample(host, sec, seq):
        return row(host, sec, seq, True, seq, seq, seq, 0, seq, seq, 1, seq)
    parts = [[sample("a", 0, 1), sample("b", 0, 2)], [sample("b", 300, 3)], [sample("b", 2000, 4)],
             [sample("b", 4000, 5)], [sample("a", 4100, 6), sample("b", 4200, 7)], [sample("b", 9000, 8)], [sample("b", 9001, 9)]]
    feed(spark, str(tmp_path / "in"), [spark.createDataFrame(p, COLS) for p in parts])
    query = orr.start_ordered_report(spark, stream(spark, str(tmp_path / "in")), str(tmp_path / "w"), 60,
                                     forget_after=1000, trigger={"availableNow": True})
    query.awaitTermination()
    out = {r.seq: r.cpu_pct for r in spark.read.parquet(str(tmp_path / "w/out")).collect()}
    assert out[6] is None                             # a's state was dropped: a first sample
    assert out[3] is not None and out[7] is not None
    with pytest.raises(ValueError):
        orr.ordered_report_stream(stream(spark, str(tmp_path / "in")), 600, 600)


def test_rows_without_a_time_are_left_out(spark, tmp_path):
    rows = [row("a", 0, 1, True, 1, 1, 1, 1, 1, 1, 1, 1), row("a", 5, 2, True, 2, 2, 2, 2, 2, 2, 2, 2)]
    untimed = [(r[0], None, *r[2:]) for r in rows]
    feed(spark, str(tmp_path / "in"), [spark.createDataFrame(rows + untimed, COLS)])
    out = orr.run_ordered_report(spark, stream(spark, str(tmp_path / "in")))
    assert sorted(r.seq for r in out.collect()) == [1, 2]


def test_waiting_rows_never_pass_python_and_a_hot_host_is_split(spark, tmp_path):
    """20,000 rows of one host in one file: all wait, and the report of them is dealt by time."""
    hot = spark.range(20_000).selectExpr("'hot' AS host", "timestampadd(SECOND, id, TIMESTAMP_NTZ '2024-01-01 00:00:00') AS ts",
                                         "id AS seq")
    c = spark.createDataFrame([], COLS).schema
    rest = [F.lit(True).alias(f.name) if f.name == "ok" else F.col("seq").cast(f.dataType).alias(f.name)
            for f in c if f.name not in hot.columns]
    hot = hot.select("*", *rest).select(*c.names)
    hot = hot.withColumn("interval_sec", F.lit(5).cast(c["interval_sec"].dataType)) if "interval_sec" in c.names else hot
    feed(spark, str(tmp_path / "in"), [hot.coalesce(1)])
    out = orr.run_ordered_report(spark, stream(spark, str(tmp_path / "in")))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "TransformWithState" not in plan and "_tb" in plan
    folder = str(tmp_path / "work")
    feed(spark, str(tmp_path / "in2"), [hot.coalesce(1)])
    query = orr.start_ordered_report(spark, stream(spark, str(tmp_path / "in2")), folder, trigger={"availableNow": True})
    query.awaitTermination()
    assert orr.waiting_report(spark, folder).count() == 600
    left = spark.read.parquet(f"{folder}/out").drop("batch").unionByName(orr.waiting_report(spark, folder))
    same(out, mx.resource_report(hot))
    same(left, mx.resource_report(hot))


def test_endless_median_closes_windows_as_the_watermark_passes(spark, tmp_path):
    rng = random.Random(6)
    rows = [("hot" if rng.random() < 0.7 else "cold", T0 + dt.timedelta(seconds=s),
             float(rng.randrange(50)) if rng.random() < 0.9 else None) for s in range(0, 20_000, 9)]
    ddl = "g string, ts timestamp_ntz, v double"
    parts = [rows[k * 500:(k + 1) * 500] for k in range(5)]
    for p in parts:
        rng.shuffle(p)
    folder = str(tmp_path / "work")
    feed(spark, str(tmp_path / "in"), [spark.createDataFrame(p, ddl) for p in parts[:3] if p])
    given = samples_stream(spark, str(tmp_path / "in"), spark.createDataFrame([], ddl).schema)
    query = median_stream.start_windowed_median(spark, given, "v", folder, ["g"], window="1 hour",
                                                watermark="5 minutes", trigger={"processingTime": "1 second"})
    try:
        query.processAllAvailable()
        seen = median_stream.window_medians(spark, folder).count()
        feed(spark, str(tmp_path / "in"), [spark.createDataFrame(p, ddl) for p in parts[3:] if p])
        query.processAllAvailable()
    finally:
        query.stop()
    out = median_stream.window_medians(spark, folder)
    assert 0 < seen < out.count()
    batch = spark.createDataFrame(rows, ddl).withColumn("window_start", F.window("ts", "1 hour").start)
    want = med.median(batch, "v", ["window_start", "g"], strategy="builtin", extra_aggs=[F.count("v").alias("n")])
    closed = want.where(F.col("window_start") < F.lit(T0 + dt.timedelta(hours=5)))
    same(out.select("window_start", "g", "median", "n"), closed.select("window_start", "g", "median", "n"))


def test_state_provider_is_put_back(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    with rocksdb_state(spark):
        assert "RocksDB" in spark.conf.get(key)
    assert spark.conf.get(key, None) == before
