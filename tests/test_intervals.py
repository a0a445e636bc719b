"""M18 complete (an interval without samples has a record too) and M17 (a width that
changes), batch and stream, against plain Python; NULL hosts everywhere."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from medley.operators import intervals as iv, metrics as mx
from medley.streaming import metrics_stream as ms
from tests.test_metrics import COLS, GIB, T0, row

US = 1_000_000


def made(rng, hosts, n, span=40_000):
    """Samples at uneven times, with failed reads, resets and long gaps."""
    out, seq = [], 0
    for host in hosts:
        at, q, rd = 0, 0, 0
        for _ in range(n):
            at += rng.choice([5, 5, 60, 300, 900, rng.randrange(span)])
            q = 0 if rng.random() < 0.05 else q + rng.randrange(5000)
            rd += rng.randrange(10**8)
            seq += 1
            out.append(row(host, at, seq, rng.random() > 0.2, q * 3, q, q * 5, 7, rd, rd // 2,
                           rng.randrange(90), q))
    return out


def us_of(ts):
    return round((ts - dt.datetime(1970, 1, 1)).total_seconds() * US)


def recorded(report, settings):
    """{(host, start): record} from report rows; settings: [(from_us, seconds)]."""
    def start(us):
        base, width = [s for s in settings if s[0] <= us or s is settings[0]][-1]
        return us - (us - base) % (width * US), width

    def nxt(begin, width):
        later = [f for f, _ in settings[1:] if begin < f < begin + width * US]
        return start(later[0] if later else begin + width * US)

    hosts = {}
    for r in report:
        hosts.setdefault(r.host, {}).setdefault(start(us_of(r.ts)), []).append(r)
    out = {}
    for host, by in hosts.items():
        at, end, gauge = min(by), max(by), (None, 0)
        while at <= end:
            rows = by.get(at)
            if rows:
                top = [max((x for x in (getattr(r, c) for r in rows) if x is not None), default=None)
                       for c in ("cpu_pct", "mem_used_mb", "db_connections")]
                add = [None if all(x is None for x in v) else sum(x or 0 for x in v) for v in
                       ([getattr(r, c) for r in rows] for c in ("disk_read_kbps", "disk_write_kbps", "db_queries_ps"))]
                out[host, at] = (len(rows), top[0], top[1], add[0], add[1], top[2], add[2])
                good = [r for r in rows if r.mem_used_mb is not None]
                if good:
                    last = max(good, key=lambda r: (r.ts, r.seq))
                    gauge = (last.mem_used_mb, last.db_connections)
            else:
                out[host, at] = (0, 0.0, gauge[0], 0, 0, gauge[1], 0)
            at = nxt(*at)
    return out


def got(df):
    rows = df.collect()
    out = {(r.host, (us_of(r.interval_start), r.interval_sec)):
           (r.samples, r.max_cpu_pct, r.max_mem_used_mb, r.sum_disk_read_kbps, r.sum_disk_write_kbps,
            r.max_db_connections, r.sum_db_queries_ps) for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.fixture(scope="module")
def samples(spark):
    return spark.createDataFrame(made(random.Random(5), ["a", "b", None], 25), COLS).repartition(3)


@pytest.mark.parametrize("seconds", [300, 3600, 7])
def test_every_interval_has_a_record(samples, seconds, monkeypatch):
    monkeypatch.setattr(iv, "RUN", 10)                # gaps of many runs
    report = mx.resource_report(samples)
    assert got(iv.interval_records(report, seconds)) == recorded(report.collect(), [(0, seconds)])


def change(spark, *rows):
    return spark.createDataFrame([(T0 + dt.timedelta(seconds=s), w) for s, w in rows], ms.SETTINGS)


def test_widths_change_with_time(spark, samples):
    report = mx.resource_report(samples)
    rows = [(40_000, 900), (100, 600), (40_100, 60), (60_000, 3600)]
    settings = change(spark, *rows)
    want = recorded(report.collect(), [(0, 300)] + sorted((us_of(T0) + s * US, w) for s, w in rows))
    assert got(iv.interval_records(report, 300, settings)) == want
    assert {w for _, (_, w) in want} >= {600, 900, 60, 3600}


def test_settings_are_checked(spark):
    assert iv.read_settings(change(spark)) == iv.fixed(300)
    twice = iv.read_settings(change(spark, (5, 10), (5, 20)), 60)
    assert [s.seconds for s in twice] == [60, 20]
    with pytest.raises(ValueError):
        iv.read_settings(change(spark, (5, 0)))
    with pytest.raises(ValueError):
        iv.read_settings(change(spark, *[(k, 5) for k in range(iv.MOST_SETTINGS + 1)]))
    nulls = spark.createDataFrame([(None, 5), (T0, None)], ms.SETTINGS)
    assert iv.read_settings(nulls) == iv.fixed(300)


def test_no_rows_one_row_and_rows_without_a_time(spark, samples):
    none = mx.resource_report(samples.limit(0))
    assert iv.interval_records(none).count() == 0
    one = spark.createDataFrame([row("a", 5, 1, False, 0, 0, 0, 0, 0, 0, 0, 0)], COLS)
    (r,) = iv.interval_records(mx.resource_report(one)).collect()
    assert (r.samples, r.max_cpu_pct, r.max_mem_used_mb, r.max_db_connections) == (1, 0.0, None, 0)
    untimed = one.withColumn("ts", F.lit(None).cast("timestamp_ntz"))
    assert iv.interval_records(mx.resource_report(untimed, bucket_seconds=60)).count() == 0


def test_one_gap_of_a_million_intervals(spark):
    two = [row("a", 0, 1, True, 1, 1, 1, 1, 1, 1, 3, 1), row("a", 1_000_000, 2, True, 2, 2, 2, 2, 2, 2, 4, 2)]
    records = iv.interval_records(mx.resource_report(spark.createDataFrame(two, COLS)), 1)
    assert records.count() == 1_000_001
    row_ = records.where("samples = 0").agg(F.min("max_db_connections"), F.max("max_db_connections")).first()
    assert tuple(row_) == (3, 3)


def feed(spark, folder, frames):
    """Each frame one file, in order of arrival."""
    os.makedirs(folder, exist_ok=True)
    for df in frames:
        k = len(os.listdir(folder))
        path = f"{folder}/part-{k}.parquet"
        part = f"{folder}-tmp-{k}"
        df.coalesce(1).write.parquet(part)
        (name,) = [n for n in os.listdir(part) if n.endswith(".parquet")]
        os.rename(f"{part}/{name}", path)
        os.utime(path, (1_700_000_000 + 10 * k, 1_700_000_000 + 10 * k))


def stream(spark, folder):
    return ms.samples_stream(spark, folder, spark.createDataFrame([], COLS).schema, max_files_per_trigger=1)


def by_time(samples, cuts):
    edges = [None, *cuts, None]
    for a, b in zip(edges, edges[1:]):
        part = samples
        if a is not None:
            part = part.where(F.col("ts") >= F.lit(T0 + dt.timedelta(seconds=a)))
        if b is not None:
            part = part.where(F.col("ts") < F.lit(T0 + dt.timedelta(seconds=b)))
        yield part


def test_stream_records_equal_batch(spark, samples, tmp_path):
    feed(spark, str(tmp_path / "in"), by_time(samples, [20_000, 45_000, 70_000]))
    streamed = ms.run_interval_records(spark, stream(spark, str(tmp_path / "in")))
    assert got(streamed) == got(iv.interval_records(mx.resource_report(samples)))


def test_width_changes_while_the_query_runs(spark, samples, tmp_path):
    """The parameter table is written between two micro-batches of one running query."""
    folder, settings = str(tmp_path / "work"), str(tmp_path / "settings")
    early, late = by_time(samples, [50_000])
    feed(spark, str(tmp_path / "in"), [early])
    query = ms.interval_writer(spark, stream(spark, str(tmp_path / "in")), folder, 300, settings) \
        .trigger(processingTime="1 second").start()
    try:
        query.processAllAvailable()
        before = got(ms.stream_records(spark, folder, 300, settings))
        assert {w for _, (_, w) in before} == {300}
        change(spark, (50_000, 900)).write.parquet(settings)
        feed(spark, str(tmp_path / "in"), [late])
        query.processAllAvailable()
    finally:
        query.stop()
    after = got(ms.stream_records(spark, folder, 300, settings))
    report = mx.resource_report(samples)
    assert after == got(iv.interval_records(report, 300, spark.read.schema(ms.SETTINGS).parquet(settings)))
    assert {w for _, (_, w) in after} == {300, 900}


def test_stream_folders_do_not_grow(spark, samples, tmp_path):
    folder = str(tmp_path / "work")
    feed(spark, str(tmp_path / "in"), by_time(samples, [10_000, 30_000, 45_000, 60_000, 70_000]))
    out = ms.run_resource_report(spark, stream(spark, str(tmp_path / "in")), folder=folder)
    assert len(os.listdir(f"{folder}/rows")) == 1 and len(os.listdir(f"{folder}/state")) == 2
    want = mx.resource_report(samples)
    assert sorted(map(str, out.drop("late").collect())) == sorted(map(str, want.collect()))
    # and a later run goes on from there
    more = spark.createDataFrame([row("a", 5_000_000, 9_999, True, 1, 1, 1, 1, 1, 1, 1, 1)], COLS)
    feed(spark, str(tmp_path / "in"), [more])
    again = ms.run_resource_report(spark, stream(spark, str(tmp_path / "in")), folder=folder)
    assert again.count() == want.count() + 1


# ---- NULL hosts ---------------------------------------------------------------

def test_a_null_host_is_a_host(spark):
    rng = random.Random(2)
    rows = made(rng, [None], 400, span=50)
    named = [("x", *r[1:]) for r in rows]
    for bucket in (60, 3600, "auto"):
        a = mx.resource_report(spark.createDataFrame(rows, COLS), bucket_seconds=bucket)
        b = mx.resource_report(spark.createDataFrame(named, COLS), bucket_seconds=bucket)
        assert sorted(map(str, a.drop("host").collect())) == sorted(map(str, b.drop("host").collect()))
        assert a.where("cpu_pct is null").count() == b.where("cpu_pct is null").count() == 1


def test_two_samples_at_one_instant(spark):
    rows = [row("a", 0, 1, True, 1, 1, 1, 1, 1, 1, 1, 1), row("a", 0, 2, True, 5, 5, 5, 5, 5, 5, 5, 5),
            row("a", 5, 3, True, 9, 9, 9, 9, 99999, 9, 9, 50)]
    got = {r.seq: r for r in mx.resource_report(spark.createDataFrame(rows, COLS)).collect()}
    assert got[2].disk_read_kbps is None and got[2].db_queries_ps is None and got[2].cpu_pct == 75.0
    assert got[3].db_queries_ps == 9


@pytest.mark.parametrize("bucket", [30, "auto"])
def test_latest_report_of_null_hosts(spark, bucket):
    rows = made(random.Random(4), [None, "b"], 60, span=50)
    df = spark.createDataFrame(rows, COLS)
    full = mx.resource_report(df).collect()
    want = sorted(str(max((r for r in full if r.host == h), key=lambda r: (r.ts, r.seq))) for h in (None, "b"))
    assert sorted(map(str, mx.latest_report(df, bucket_seconds=bucket).collect())) == want
    snap = mx.status_snapshot(mx.latest_report(df, bucket_seconds=bucket))
    assert snap.where("host is null").count() == len(mx.STATUS_VARIABLES)


def test_gauges_come_from_the_last_good_sample(spark):
    rows = [row("a", 0, 1, True, 1, 1, 1, 1, 1, 1, 30, 1), row("a", 10, 2, False, 0, 0, 0, 0, 0, 0, 0, 0),
            row("a", 1000, 3, True, 2, 2, 2, 2, 2, 2, 5, 2)]
    recs = iv.interval_records(mx.resource_report(spark.createDataFrame(rows, COLS))).orderBy("interval_start").collect()
    assert [r.samples for r in recs] == [2, 0, 0, 1]
    assert {r.max_db_connections for r in recs if not r.samples} == {30}
    assert {r.max_mem_used_mb for r in recs} == {16 * GIB // 1024**2 - (128_000 * 16384) // 1024**2}
