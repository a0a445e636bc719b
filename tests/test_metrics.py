"""Metric-sample operators on a hand-made fixture (F22) with a counter reset,
a failed sample, an idle pair, a gap and a one-row host."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from medley.operators import carry, metrics as mx
from medley.plans import given as G

COLS = ("host STRING, ts TIMESTAMP_NTZ, seq BIGINT, interval_sec INT, ok BOOLEAN, "
        "cpu_user BIGINT, cpu_sys BIGINT, cpu_idle BIGINT, cpu_nice BIGINT, "
        "mem_total_bytes BIGINT, page_size BIGINT, free_pages BIGINT, speculative_pages BIGINT, "
        "disk_bytes_read BIGINT, disk_bytes_written BIGINT, connections BIGINT, questions BIGINT, "
        "load1_raw BIGINT, ram_total_units BIGINT, ram_free_units BIGINT, mem_unit BIGINT")
T0 = dt.datetime(2024, 1, 1)
GIB = 1024 ** 3


def row(host, sec, seq, ok, user, sys_, idle, nice, rd, wr, conn, q):
    good = (lambda v: v if ok else None)
    return (host, T0 + dt.timedelta(seconds=sec), seq, 5, ok, good(user), good(sys_), good(idle),
            good(nice), good(16 * GIB), 16384, good(100_000), good(28_000), good(rd), good(wr),
            good(conn), good(q), 15073, 2043392, 873472, 4096)


@pytest.fixture(scope="module")
def samples(spark):
    rows = [
        row("a", 0, 1, True, 100, 50, 850, 0, 0, 0, 3, 1000),            # baseline
        row("a", 5, 2, True, 130, 60, 910, 0, 51200, 10240, 4, 1075),    # normal
        row("a", 10, 3, True, 130, 60, 910, 0, 51200, 10240, 4, 1075),   # idle pair
        row("a", 15, 4, False, 0, 0, 0, 0, 0, 0, 0, 0),                  # failed read
        row("a", 30, 5, True, 190, 70, 1040, 0, 153600, 20480, 5, 1225),  # gap of 2 intervals
        row("a", 35, 6, True, 10, 5, 20, 0, 1024, 0, 5, 10),             # counter reset
        row("b", 0, 7, True, 1, 1, 1, 1, 1, 1, 1, 1),                    # one-row host
    ]
    return spark.createDataFrame(rows, COLS)


def by_seq(df):
    return {r.seq: r for r in df.collect()}


def test_report_rules(samples):
    rep = by_seq(mx.resource_report(samples))
    assert rep[1].cpu_pct is None and rep[1].disk_read_kbps is None      # baseline (M11)
    assert rep[2].cpu_pct == pytest.approx(100.0 * 40 / 100)              # M1
    assert rep[2].disk_read_kbps == 51200 // 5 // 1024                    # M5 = 10
    assert rep[2].db_queries_ps == 75 // 5                                # M7 = 15
    assert rep[3].cpu_pct == 0.0 and rep[3].disk_read_kbps == 0           # idle pair
    assert (rep[4].cpu_pct, rep[4].disk_read_kbps, rep[4].db_connections,
            rep[4].db_queries_ps) == (0.0, 0, 0, 0)                       # failed read
    # after the failure the last good sample (seq 3, t=10) is the baseline:
    # 20 s elapsed, not the nominal 5 s
    assert rep[5].disk_read_kbps == (153600 - 51200) // 20 // 1024
    assert rep[5].db_queries_ps == (1225 - 1075) // 20
    assert rep[5].cpu_pct == pytest.approx(100.0 * 70 / 200)
    assert (rep[6].cpu_pct, rep[6].disk_read_kbps, rep[6].db_queries_ps) == (0.0, 0, 0)  # reset
    assert rep[7].cpu_pct is None                                         # one-row host
    assert rep[2].mem_total_mb == 16384
    assert rep[2].mem_used_mb == 16384 - (128_000 * 16384) // (1024 * 1024)
    assert rep[2].db_connections == 4


def test_nominal_basis(samples):
    rep = by_seq(mx.disk_rate_kbps(samples, rate_basis="nominal"))
    assert rep[5].disk_read_kbps == (153600 - 51200) // 5 // 1024         # reference arithmetic
    with pytest.raises(ValueError):
        mx.resource_report(samples, rate_basis="wall")


def test_counter_delta_after_reset_restarts(samples, spark):
    extra = samples.union(spark.createDataFrame([row("a", 40, 8, True, 20, 6, 30, 0, 3072, 0, 5, 30)], COLS))
    d = by_seq(mx.counter_deltas(extra, "questions"))
    assert d[6].delta == 0 and d[8].delta == 20                           # restart from 10


def test_baseline_drop_and_gauges(samples):
    kept = {r.seq for r in mx.drop_baseline(mx.resource_report(samples)).collect()}
    assert kept == {2, 3, 4, 5, 6}
    r = mx.load_avg(samples).first()
    assert r.load_avg == 15073 / 65536.0
    ram = mx.ram_mb(samples).first()
    assert (ram.ram_total_mb, ram.ram_free_mb) == (7982, 3412)


def test_interval_param():
    for bad in (0, 3601, 2.5):
        with pytest.raises(ValueError):
            mx.check_interval(bad)
    assert mx.check_interval(5) == 5


def test_device_sums(spark):
    """Two devices; one is read three times in a slot and counts once, with its
    latest good reading."""
    at = lambda sec: T0 + dt.timedelta(seconds=sec)
    rows = [("h", 1, at(0), 1, True, 100, 1), ("h", 1, at(5), 2, True, 105, 2), ("h", 1, at(10), 3, True, 110, 3),
            ("h", 1, at(11), 4, False, None, None), ("h", 2, at(1), 5, True, 20, 2), ("h", 1, at(400), 6, True, 5, 5)]
    df = spark.createDataFrame(rows, "host STRING, device BIGINT, ts TIMESTAMP_NTZ, seq BIGINT, ok BOOLEAN, "
                                     "disk_bytes_read BIGINT, disk_bytes_written BIGINT")
    got = sorted((r.slot, r.devices, r.sum_disk_bytes_read) for r in mx.disk_sum(df).collect())
    assert got == [(T0, 2, 130), (T0 + dt.timedelta(seconds=300), 1, 5)]


def test_snapshot_of_unread_figures_is_zero(samples):
    got = {(r.host, r.Variable_name): r.Value for r in mx.status_snapshot(mx.latest_report(samples)).collect()}
    assert got["b", "my_resource_cpu_pct"] == "0.000000"
    assert got["b", "my_resource_disk_read_kbps"] == "0"
    assert None not in got.values()


@pytest.mark.parametrize("bucket", [60, 3600, 10 ** 7])
def test_two_level_carry_equals_single_window(spark, bucket):
    s = G.metric_samples(spark, "/root/testdata/sf0.001")
    a = carry.with_previous(s, ["questions", "ts"], ["host"], ["ts", "seq"], good=F.col("ok"),
                            time_col="ts", bucket_seconds=bucket)
    b = carry.with_previous(s, ["questions", "ts"], ["host"], ["ts", "seq"], good=F.col("ok"),
                            time_col="ts", bucket_seconds=10 ** 9)
    cols = ["seq", "prev_questions", "prev_ts"]
    assert a.select(*cols).exceptAll(b.select(*cols)).count() == 0
    assert a.count() == b.count() == s.count()


def test_derived_samples_exercise_the_rules(spark):
    rep = mx.resource_report(G.metric_samples(spark, "/root/testdata/sf0.01"))
    s = G.metric_samples(spark, "/root/testdata/sf0.01")
    resets = mx.counter_deltas(s, "disk_bytes_read").where("delta = 0 AND counter IS NOT NULL")
    assert resets.count() > 0                     # counter resets present
    assert s.where("NOT ok").count() > 0          # failed samples present
    assert rep.where("cpu_pct IS NULL").count() == 8   # one baseline per host


@pytest.mark.parametrize("bucket", [60, 3600, 10 ** 7])
def test_latest_report_equals_last_rows_of_full_report(spark, bucket):
    s = G.metric_samples(spark, "/root/testdata/sf0.001")
    full = mx.status_snapshot(mx.resource_report(s))
    latest = mx.status_snapshot(mx.latest_report(s, bucket_seconds=bucket))
    assert full.count() == latest.count() == 8 * 7
    assert full.exceptAll(latest).count() == 0


def test_latest_report_on_fixture(samples):
    rows = {r.host: r for r in mx.latest_report(samples).collect()}
    assert rows["a"].seq == 6 and rows["a"].cpu_pct == 0.0          # reset row is latest
    assert rows["b"].cpu_pct is None                                  # one-row host


def test_auto_time_buckets_split_and_change_nothing(spark, monkeypatch):
    from medley.operators import carry
    s = G.metric_samples(spark, "/root/testdata/sf0.001")
    one = mx.resource_report(s, bucket_seconds=10 ** 9)          # one bucket per host
    monkeypatch.setattr(carry, "BUCKET_ROWS", 40)                   # force many small buckets
    tb = carry.with_time_bucket(s, "ts")
    assert tb.select("_tb").distinct().count() > 10
    biggest = tb.groupBy("_tb").count().agg(F.max("count")).first()[0]
    assert biggest < s.count() / 5                                 # no bucket holds a large share
    auto = mx.resource_report(s)
    assert auto.count() == one.count()
    assert auto.exceptAll(one).count() == 0 and one.exceptAll(auto).count() == 0
    latest = mx.status_snapshot(mx.latest_report(s))
    assert latest.exceptAll(mx.status_snapshot(one)).count() == 0
