
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from medley.errors import ArgumentCountError, ArgumentTypeError
from medley.functions import registry, scalar
from medley.operators import logs, median as med, metrics as mx


def test_g1_g2_constants(spark):
    registry.register_builtins(spark)
    assert spark.sql("SELECT hello_world() AS h").first().h == "Hello World from UDF!"
    t = spark.createDataFrame([(1,), (2,), (3,)], "id INT")
    rows = t.select(scalar.hello_world_alt().alias("h")).collect()
    assert [r.h for r in rows] == ["Hello World Mysql Plugin-UDF"] * 3
    t.createOrReplaceTempView("t")
    assert [r.h for r in spark.sql("SELECT helloworld() AS h FROM t").collect()] == \
        ["Hello World Mysql Plugin-UDF"] * 3


def test_g3_arity_error(spark):
    registry.register_builtins(spark)
    with pytest.raises(AnalysisException, match="WRONG_NUM_ARGS"):
        spark.sql("SELECT helloworld('x')").collect()
    t = spark.createDataFrame([(1,)], "id INT")
    with pytest.raises(ArgumentCountError, match="requires no arguments"):
        registry.call(t, "helloworld", "id")


def test_g4_greet(spark):
    t = spark.createDataFrame([("a1",), ("a2",), ("a3",)], "a STRING")
    got = [r.g for r in t.select(registry.call(t, "greet", "a").alias("g")).collect()]
    assert got == ["Hello World, a1!", "Hello World, a2!", "Hello World, a3!"]


def test_g5_g6_welcome_utf8_null_and_arity(spark):
    registry.register_builtins(spark)
    users = spark.createDataFrame([("Alice",), ("Bob",), ("홍길동",), (None,)], "name STRING")
    got = [r.w for r in users.select(scalar.welcome("name").alias("w")).collect()]
    assert got == ["Welcome Alice, HelloWorld Mysql Plugin", "Welcome Bob, HelloWorld Mysql Plugin",
                   "Welcome 홍길동, HelloWorld Mysql Plugin", None]
    users.createOrReplaceTempView("users")
    sql = [r.w for r in spark.sql("SELECT welcome(name) AS w FROM users").collect()]
    assert sql == got
    with pytest.raises(AnalysisException, match="WRONG_NUM_ARGS"):
        spark.sql("SELECT welcome() FROM users").collect()
    with pytest.raises(AnalysisException, match="WRONG_NUM_ARGS"):
        spark.sql("SELECT welcome(name, name) FROM users").collect()
    long = "x" * 5000   # no length limit
    assert users.select(scalar.welcome(F.lit(long)).alias("w")).first().w.count("x") == 5000


def test_type_check_refuses_non_string(spark):
    t = spark.createDataFrame([(5,)], "n INT")
    with pytest.raises(ArgumentTypeError):
        registry.call(t, "greet", "n")
    # the coerce rule (U9) makes it acceptable
    assert t.select(registry.call(t, "greet", scalar.coerce("n", "STRING")).alias("g")) \
        .first().g == "Hello World, 5!"


@pytest.mark.parametrize("strategy", ["builtin", "rank"])
def test_g7_g11_median_global(spark, strategy):
    t = spark.createDataFrame([(float(x),) for x in (10, 20, 30, 40, 50)], "score DOUBLE")
    assert med.median(t, "score", strategy=strategy).first().median == 30.0
    t2 = t.union(spark.createDataFrame([(35.0,)], "score DOUBLE"))
    assert med.median(t2, "score", strategy=strategy).first().median == 32.5
    empty = t.where(F.col("score") > 9999)
    rows = med.median(empty, "score", strategy=strategy).collect()
    assert len(rows) == 1 and rows[0].median is None


@pytest.mark.parametrize("strategy", ["builtin", "rank"])
def test_g8_g9_g10_median_by_group(spark, strategy):
    f5 = spark.createDataFrame([("A", 3.0), ("A", 1.0), ("A", 4.0), ("A", 1.0), ("A", 5.0),
                                ("B", 10.0), ("B", 20.0), ("B", 30.0)], "department STRING, score DOUBLE")
    got = {r.department: r.median for r in med.median(f5, "score", ["department"], strategy=strategy).collect()}
    assert got == {"A": 3.0, "B": 20.0}
    mixed = med.median(f5, "score", ["department"], strategy=strategy,
                       extra_aggs=[F.count(F.lit(1)).alias("n"), F.avg("score").alias("avg")])
    got = {r.department: (r.n, r.avg, r.median) for r in mixed.collect()}
    assert got == {"A": (5, 2.8, 3.0), "B": (3, 20.0, 20.0)}
    f6 = spark.createDataFrame([("A", 10.0), ("A", 20.0), ("A", 30.0), ("A", 40.0),
                                ("B", 110.0), ("B", 120.0), ("B", 30.0), ("B", 410.0)], "a STRING, b DOUBLE")
    got = {r.a: r.median for r in med.median(f6, "b", ["a"], strategy=strategy).collect()}
    assert got == {"A": 25.0, "B": 115.0}
    assert med.median(f5, "score", strategy=strategy).first().median == 4.5


@pytest.mark.parametrize("values,expected", [([1, 3, 5], 3.0), ([1, 3, 5, 7], 4.0),
                                             ([1, 1, 3, 4, 5, 10], 3.5), ([100, 200], 150.0)])
def test_g12_median_arithmetic(spark, values, expected):
    t = spark.createDataFrame([(v,) for v in values], "x INT")
    assert med.median(t, "x", strategy="rank").first().median == expected
    assert med.median(t, "x", strategy="rank", piece_rows=1).first().median == expected


def test_median_type_gate(spark):
    t = spark.createDataFrame([("1",), ("2",)], "s STRING")
    with pytest.raises(ArgumentTypeError):
        med.median(t, "s")
    d = spark.createDataFrame([(1, True)], "i INT, b BOOLEAN")
    with pytest.raises(ArgumentTypeError):
        med.median(d, "b")
    with pytest.raises(ArgumentCountError):
        med.check_median_input(d, "i", "i")
    dec = spark.createDataFrame([(1,), (2,)], "x INT").select(F.col("x").cast("decimal(10,2)").alias("x"))
    assert med.median(dec, "x").first().median == 1.5


def test_median_nan_sorts_greatest(spark):
    t = spark.createDataFrame([(float("nan"),), (1.0,), (2.0,)], "x DOUBLE")
    assert med.median(t, "x", strategy="rank").first().median == 2.0
    assert med.median(t, "x", strategy="builtin").first().median == 2.0


def test_g14_status_list(spark):
    from datetime import datetime
    rep = spark.createDataFrame(
        [("h1", datetime(2024, 1, 1, 0, 0, 5), 1, 4.2, 7821, 16384, 12, 80, 3, 15),
         ("h1", datetime(2024, 1, 1, 0, 0, 0), 0, 9.9, 1, 1, 1, 1, 1, 1)],
        "host STRING, ts TIMESTAMP_NTZ, seq BIGINT, cpu_pct DOUBLE, mem_used_mb BIGINT, "
        "mem_total_mb BIGINT, disk_read_kbps BIGINT, disk_write_kbps BIGINT, "
        "db_connections BIGINT, db_queries_ps BIGINT")
    snap = mx.status_snapshot(rep).orderBy("Variable_name").collect()
    assert [(r.Variable_name, r.Value) for r in snap] == [
        ("my_resource_cpu_pct", "4.200000"), ("my_resource_db_connections", "3"),
        ("my_resource_db_queries_ps", "15"), ("my_resource_disk_read_kbps", "12"),
        ("my_resource_disk_write_kbps", "80"), ("my_resource_mem_total_mb", "16384"),
        ("my_resource_mem_used_mb", "7821")]
    like = mx.status_like(mx.status_snapshot(rep), "my_resource_d%").count()
    assert like == 4
    line = logs.resource_lines(rep.where("seq = 1")).first().line
    assert line == ("my_resource: CPU=4.2% | MEM=7821/16384MB | DISK_R=12KB/s DISK_W=80KB/s"
                    " | CONN=3 | QPS=15")
    parsed = logs.parse_resource_lines(spark.createDataFrame([("[Note] " + line,)], "line STRING")).first()
    assert (parsed.cpu_pct, parsed.mem_used_mb, parsed.mem_total_mb, parsed.disk_read_kbps,
            parsed.disk_write_kbps, parsed.db_connections, parsed.db_queries_ps) == \
        (4.2, 7821, 16384, 12, 80, 3, 15)


def test_g15_os_log_lines(spark):
    lines = spark.createDataFrame(
        [("[os_logger] CPU Load: 0.23, RAM: 3412/7982 MB",),
         ("[os_logger] CPU Load: 0.18, RAM: 3398/7982 MB",),
         ("garbage line",)], "line STRING")
    parsed, rejects = logs.parse_log(lines)
    got = [(r.kind, r.load_avg, r.ram_free_mb, r.ram_total_mb) for r in parsed.orderBy("line").collect()]
    assert got == [("os", 0.18, 3398, 7982), ("os", 0.23, 3412, 7982)]
    assert [r.line for r in rejects.collect()] == ["garbage line"]
    # formatting: load = raw / 65536, RAM = units * mem_unit / 1024 / 1024
    s = spark.createDataFrame([(15073, 873472, 2043392, 4096)],
                              "load1_raw BIGINT, ram_free_units BIGINT, ram_total_units BIGINT, mem_unit BIGINT")
    s = s.select(F.lit("h").alias("host"), F.lit(None).cast("timestamp_ntz").alias("ts"),
                 F.lit(0).alias("seq"), "*")
    assert logs.os_lines(s).first().line == "[os_logger] CPU Load: 0.23, RAM: 3412/7982 MB"


def test_log_parse_equals_per_field_regex(spark):
    """The one-match-then-split parse equals one regexp_extract per field on
    clean, prefixed, negative, partial and junk lines."""
    from pyspark.sql import functions as F
    from medley.operators import logs
    lines = ["my_resource: CPU=12.5% | MEM=100/2048MB | DISK_R=3KB/s DISK_W=0KB/s | CONN=7 | QPS=42",
             "2024-01-02 03:04:05 [x] my_resource: CPU=0.0% | MEM=-1/5MB | DISK_R=0KB/s DISK_W=-9KB/s | CONN=0 | QPS=-3 tail",
             "my_resource: CPU=12.5% | MEM=100/2048MB",
             "[os_logger] CPU Load: 0.52, RAM: 100/200 MB",
             "junk 1.2.3 - 4", "", None]
    df = spark.createDataFrame([(x,) for x in lines], "line STRING")
    got = logs.parse_resource_lines(df).collect()
    want = df.select("line", *[F.regexp_extract("line", logs.RESOURCE_PATTERN, i + 1).try_cast(t).alias(n)
                               for i, (n, t) in enumerate(logs.RESOURCE_FIELDS)]).collect()
    assert got == want
    assert got[1].mem_used_mb == -1 and got[1].db_queries_ps == -3 and got[2].cpu_pct is None
    got_os = logs.parse_os_lines(df).collect()
    assert got_os[3].load_avg == 0.52 and got_os[3].ram_total_mb == 200 and got_os[0].load_avg is None
