"""Stream vs batch (M19, A9, M18) with rows spread over several micro-batches."""

import os
import tempfile

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from medley.operators import median as med, metrics as mx
from medley.plans import given as G
from medley.streaming import median_stream, metrics_stream as ms


@pytest.fixture(scope="module")
def sample_files(spark):
    """sf0.001 samples written as 4 files in time order; rows inside each file
    are shuffled (out of order within a micro-batch)."""
    sdf = G.metric_samples(spark, "/root/testdata/sf0.001")
    pdf = sdf.toPandas().sort_values(["ts", "seq"])
    for f in sdf.schema.fields:     # keep nullable integers integral
        if f.dataType.typeName() in ("long", "integer"):
            pdf[f.name] = pdf[f.name].astype("Int64" if f.dataType.typeName() == "long" else "Int32")
    d = tempfile.mkdtemp(prefix="medley-stream-")
    n = len(pdf)
    for i in range(4):
        part = pdf.iloc[i * n // 4:(i + 1) * n // 4].sample(frac=1.0, random_state=i)
        path = os.path.join(d, f"part-{i}.parquet")
        _write(part, path)
        os.utime(path, (1_700_000_000 + i * 10, 1_700_000_000 + i * 10))
    return d, pdf


def _write(pdf, path):
    pq.write_table(pa.Table.from_pandas(pdf, preserve_index=False), path, coerce_timestamps="us")


def _stream(spark, folder, schema):
    return ms.samples_stream(spark, folder, schema, max_files_per_trigger=1)


def test_stream_report_equals_batch(spark, sample_files):
    folder, _ = sample_files
    batch_in = spark.read.parquet(folder)
    stream_out = ms.run_to_table(spark, ms.resource_report_stream(_stream(spark, folder, batch_in.schema)),
                                 "test-report")
    assert stream_out.where("late").count() == 0
    stream_out = stream_out.drop("late")
    batch_out = mx.resource_report(batch_in)
    assert stream_out.count() == batch_out.count() == batch_in.count()
    assert stream_out.exceptAll(batch_out).count() == 0
    assert batch_out.exceptAll(stream_out).count() == 0


def test_late_row_is_not_a_reset(spark, sample_files):
    folder, pdf = sample_files
    late_dir = tempfile.mkdtemp(prefix="medley-late-")
    first = pdf.iloc[: len(pdf) // 2]
    host = first.iloc[-1]["host"]
    late_row = first[first["host"] == host].iloc[[0]]   # an old sample arriving later
    p1, p2 = os.path.join(late_dir, "a.parquet"), os.path.join(late_dir, "b.parquet")
    _write(first, p1)
    _write(late_row, p2)
    os.utime(p1, (1_700_000_000, 1_700_000_000))
    os.utime(p2, (1_700_000_100, 1_700_000_100))
    schema = spark.read.parquet(p1).schema
    out = ms.run_to_table(spark, ms.with_previous_good_stream(_stream(spark, late_dir, schema)),
                          "test-late")
    flagged = out.where("late").collect()
    assert len(flagged) == 1 and flagged[0].prev_ts is None
    assert out.count() == len(first) + 1


def test_windowed_median_stream_matches_batch(spark, sample_files):
    folder, _ = sample_files
    schema = spark.read.parquet(folder).schema
    stream = _stream(spark, folder, schema).withColumn("v", F.col("load1_raw").cast("double"))
    m = median_stream.windowed_median(stream, "v", ["host"], window="1 day", watermark="1 minute")
    got = ms.run_to_table(spark, m, "test-median")
    batch = spark.read.parquet(folder).withColumn("v", F.col("load1_raw").cast("double")) \
        .withColumn("window_start", F.window("ts", "1 day").start)
    want = med.median(batch, "v", ["window_start", "host"], strategy="builtin")
    closed = got.select("window_start", "host", "median")
    assert closed.count() > 0
    assert closed.exceptAll(want.select("window_start", "host", "median")).count() == 0


def test_interval_rollup_stream(spark, sample_files):
    folder, pdf = sample_files
    schema = spark.read.parquet(folder).schema
    got = ms.run_to_table(spark, ms.interval_rollup_stream(_stream(spark, folder, schema), 300,
                                                           watermark="1 minute"), "test-rollup")
    batch = spark.read.parquet(folder).groupBy("host", F.window("ts", "300 seconds").start
                                               .alias("interval_start")).count()
    joined = got.join(batch, ["host", "interval_start"])
    assert got.count() > 0
    assert joined.where("samples != count").count() == 0
    assert joined.count() == got.count()


def test_log_sink_and_source_stream(spark, sample_files):
    """S14 / S15 on streams: report lines go to a text sink and come back parsed."""
    from medley.operators import logs
    from medley.session import scratch_path
    from medley.sources.logs import read_log, read_log_stream, write_log_stream
    folder, _ = sample_files
    schema = spark.read.parquet(folder).schema
    lines = logs.resource_lines(ms.resource_report_stream(_stream(spark, folder, schema)))
    out, ckpt = scratch_path(spark, "log-out"), scratch_path(spark, "log-ckpt")
    q = write_log_stream(lines, out, ckpt)
    q.processAllAvailable()
    q.stop()
    parsed, rejects = read_log(spark, out)
    want = logs.resource_lines(mx.resource_report(spark.read.parquet(folder))).select("line")
    assert parsed.select("line").exceptAll(want).count() == 0
    assert want.exceptAll(parsed.select("line")).count() == 0
    assert rejects.count() == 0
    # the folder read back as a stream parses the same lines
    sparsed, _ = read_log_stream(spark, out)
    got = ms.run_to_table(spark, sparsed.select("line", "cpu_pct", "db_queries_ps"), "log-back")
    assert got.count() == parsed.count()


def test_skew_safe_windowed_median_holds_every_window(spark, sample_files):
    """Four files, four micro-batches, in an order that a watermark would call
    late: the result is the batch result, open windows included."""
    folder, _ = sample_files
    shuffled = tempfile.mkdtemp(prefix="medley-order-")
    for i, k in enumerate((3, 0, 2, 1)):
        to = os.path.join(shuffled, f"x{i}.parquet")
        pq.write_table(pq.read_table(os.path.join(folder, f"part-{k}.parquet")), to)
        os.utime(to, (1_700_000_000 + i * 10, 1_700_000_000 + i * 10))
    schema = spark.read.parquet(folder).schema
    stream = _stream(spark, shuffled, schema).withColumn("v", F.col("load1_raw").cast("double"))
    got = median_stream.run_windowed_median(spark, stream, "v", ["host"], window="1 day")
    batch = spark.read.parquet(folder).withColumn("v", F.col("load1_raw").cast("double")) \
        .withColumn("window_start", F.window("ts", "1 day").start)
    want = med.median(batch, "v", ["window_start", "host"], strategy="builtin")
    got = got.select("window_start", "host", "median")
    assert got.count() == want.count()
    assert got.exceptAll(want.select("window_start", "host", "median")).count() == 0


def test_report_by_batches_equals_batch(spark, sample_files):
    folder, _ = sample_files
    batch_in = spark.read.parquet(folder)
    got = ms.run_resource_report(spark, _stream(spark, folder, batch_in.schema))
    want = mx.resource_report(batch_in)
    assert got.where("late").count() == 0
    assert got.drop("late").exceptAll(want).count() == 0 and got.count() == want.count()
    rolled = mx.interval_rollup(got)
    assert rolled.columns == mx.interval_rollup(want).columns
    assert rolled.exceptAll(mx.interval_rollup(want)).count() == 0


def test_rollup_by_batches_has_all_columns_and_open_intervals(spark, sample_files):
    folder, _ = sample_files
    batch_in = spark.read.parquet(folder)
    report = mx.resource_report(batch_in)
    got = ms.run_interval_rollup(spark, _stream(spark, folder, batch_in.schema), 3600)
    want = mx.interval_rollup(report, 3600)
    assert got.dtypes == want.dtypes and got.count() == want.count()
    assert got.exceptAll(want).count() == 0
    # partials of one host and interval merge
    days = report.withColumn("ts", F.date_trunc("month", "ts").cast(report.schema["ts"].dataType))
    want = mx.interval_rollup(days, 3600)
    parts = [mx.interval_rollup(days.where(F.col("seq") % 3 == k), 3600) for k in range(3)]
    parts = parts[0].unionByName(parts[1]).unionByName(parts[2])
    assert parts.count() > want.count()
    assert mx.merge_rollups(parts).exceptAll(want).count() == 0


def test_report_resumes_and_flags_late_rows(spark, sample_files):
    _, pdf = sample_files
    land, keep = tempfile.mkdtemp(prefix="medley-land-"), tempfile.mkdtemp(prefix="medley-keep-")
    half = len(pdf) // 2
    first, second = pdf.iloc[:half], pdf.iloc[half:]
    old = first[first["host"] == first.iloc[-1]["host"]].iloc[[0]]
    _write(first, os.path.join(land, "a.parquet"))
    schema = spark.read.parquet(land).schema
    ms.run_resource_report(spark, _stream(spark, land, schema), folder=keep)
    _write(second, os.path.join(land, "b.parquet"))
    _write(old, os.path.join(land, "c.parquet"))
    os.utime(os.path.join(land, "c.parquet"), (2_000_000_000, 2_000_000_000))
    out = ms.run_resource_report(spark, _stream(spark, land, schema), folder=keep)   # a second run
    assert out.count() == len(pdf) + 1
    late = out.where("late").collect()
    assert len(late) == 1 and late[0].disk_read_kbps in (None, 0)
    want = mx.resource_report(spark.read.parquet(land).dropDuplicates(["seq"]))
    assert out.where("not late").drop("late").exceptAll(want).count() == 0


def test_interval_drives_the_trigger(spark, sample_files):
    folder, _ = sample_files
    schema = spark.read.parquet(folder).schema
    keep = tempfile.mkdtemp(prefix="medley-live-")
    with pytest.raises(ValueError):
        ms.start_resource_report(spark, _stream(spark, folder, schema), keep, interval_seconds=0)
    q = ms.start_resource_report(spark, _stream(spark, folder, schema), keep, interval_seconds=1)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert spark.read.parquet(f"{keep}/out").count() == spark.read.parquet(folder).count()


@pytest.mark.parametrize("key", ["median_streaming", "counter_delta_stream"])
def test_streams_over_a_folder_table(spark, key):
    """``events.parquet`` as a folder of two part files gives what the file gives."""
    from medley.plans.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    folder = tempfile.mkdtemp(prefix="medley-folder-")
    os.makedirs(os.path.join(folder, "events.parquet"))
    events = pq.read_table(f"{sf}/events.parquet")
    events = events.sort_by([("ts", "ascending"), ("event_id", "ascending")])
    for i, part in enumerate((events.slice(0, 400), events.slice(400))):
        to = os.path.join(folder, "events.parquet", f"part-{i}.parquet")
        pq.write_table(part, to)
        os.utime(to, (1_700_000_000 + 10 * i, 1_700_000_000 + 10 * i))
    got, want = QUERIES[key][0](spark, folder), QUERIES[key][0](spark, sf)
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0


def test_stream_over_a_missing_table_fails(spark):
    with pytest.raises(FileNotFoundError):
        G.events_stream(spark, tempfile.mkdtemp())
