"""Function registry (U10, U12-U15) and column conversions."""

import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from medley.functions import conversions as conv, registry


def test_register_duplicate_replace_drop_list(spark):
    registry.register(spark, "shout", "s STRING", "STRING", "upper(s) || '!'")
    assert registry.exists(spark, "shout")
    assert "shout" in registry.list_registered(spark)
    assert spark.sql("SELECT shout('hi') AS x").first().x == "HI!"
    with pytest.raises(AnalysisException, match="ROUTINE_ALREADY_EXISTS|already exists"):
        registry.register(spark, "shout", "s STRING", "STRING", "s")          # U13
    registry.register(spark, "shout", "s STRING", "STRING", "lower(s)", replace=True)
    assert spark.sql("SELECT shout('HI') AS x").first().x == "hi"
    registry.drop(spark, "shout")                                             # U12
    assert not registry.exists(spark, "shout")
    registry.drop(spark, "shout", if_exists=True)                             # idempotent
    with pytest.raises(AnalysisException):
        registry.drop(spark, "shout")


@pytest.mark.parametrize("cls,body,expected", [
    ("INTEGER", "n * 2", 42), ("REAL", "n / 4", 5.25), ("STRING", "cast(n AS STRING)", "21")])
def test_return_classes(spark, cls, body, expected):
    registry.register(spark, "f_ret", "n INT", cls, body, replace=True)
    assert spark.sql("SELECT f_ret(21) AS x").first().x == expected
    registry.drop(spark, "f_ret")


def test_decimal_return_class(spark):
    registry.register(spark, "f_dec", "n INT", "DECIMAL", "n / 8", replace=True)
    v = spark.sql("SELECT f_dec(1) AS x").first().x
    assert str(v).startswith("0.125")
    registry.drop(spark, "f_dec")


def test_return_contract(spark):
    spec = registry.SPECS["helloworld"]
    assert (spec.maybe_null, spec.constant) == (False, True)
    assert registry.SPECS["welcome"].maybe_null
    registry.register_builtins(spark)
    plan = spark.sql("SELECT helloworld() AS h")._jdf.queryExecution().optimizedPlan().toString()
    assert "Hello World Mysql Plugin-UDF" in plan     # constant-folded, no call left


def test_conversions(spark):
    df = spark.createDataFrame([(-1, -1, -1_500_000), (0, 86_399_999, 0), (19723, 86_400_000, 1)],
                               "d INT, ms BIGINT, s BIGINT")
    rows = df.select(conv.days_to_date("d").alias("a"), conv.millis_to_date("ms").alias("b"),
                     conv.epoch_to_datetime("s", "s").alias("c"),
                     conv.bool_to_int(F.col("d") > 0).alias("e")).collect()
    assert rows[0].a == dt.date(1969, 12, 31) and rows[0].b == dt.date(1969, 12, 31)
    assert rows[1].b == dt.date(1970, 1, 1) and rows[2].b == dt.date(1970, 1, 2)
    assert rows[2].a == dt.date(2024, 1, 1)
    assert rows[0].c == dt.datetime(1969, 12, 14, 15, 20)
    assert [r.e for r in rows] == [0, 0, 1]


@pytest.mark.parametrize("zone", ["America/Los_Angeles", "Asia/Kolkata"])
def test_epoch_arithmetic_is_zone_free(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        vals = ["2024-03-10 02:30:00.123456", "2024-07-01 12:00:00", "1969-12-31 23:59:58.5",
                "1900-01-01 00:00:00"]
        df = spark.createDataFrame([(v,) for v in vals], "s STRING") \
            .select(F.col("s").cast("timestamp_ntz").alias("ts"))
        rows = df.select("ts", conv.ntz_to_micros("ts").alias("us")) \
            .select("ts", "us", conv.micros_to_ntz("us").alias("back")).collect()
        for r in rows:
            assert r.us == (r.ts - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)
            assert r.back == r.ts
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_aggregate_registry(spark):
    from medley.errors import ArgumentCountError, ArgumentTypeError
    t = spark.createDataFrame([("A", 3.0), ("A", 1.0), ("A", 4.0), ("B", 10.0), ("B", 20.0)],
                              "g STRING, x DOUBLE")
    got = {r.g: r.m for r in t.groupBy("g").agg(registry.aggregate(t, "my_median", "x").alias("m")).collect()}
    assert got == {"A": 3.0, "B": 15.0}
    with pytest.raises(ArgumentTypeError):
        registry.aggregate(t, "my_median", "g")
    with pytest.raises(ArgumentCountError):
        registry.aggregate(t, "my_median", "x", "x")
    registry.register_aggregate("total", lambda c: F.sum(c))
    with pytest.raises(ValueError):
        registry.register_aggregate("total", lambda c: F.sum(c))
    assert t.agg(registry.aggregate(t, "total", "x").alias("s")).first().s == 38.0
    registry.drop_aggregate("total")
    registry.drop_aggregate("total", if_exists=True)


def test_null_literal_is_accepted(spark):
    from pyspark.sql import functions as F
    from medley.functions import registry
    df = spark.range(1)
    assert df.select(registry.call(df, "welcome", F.lit(None)).alias("w")).first().w is None


def test_strict_sql_functions_refuse_other_classes(spark):
    registry.register_builtins(spark, strict=True)
    try:
        assert spark.sql("SELECT greet('a') AS g").first().g == "Hello World, a!"
        assert spark.sql("SELECT greet(NULL) AS g, greet(CAST(NULL AS STRING)) AS h").first().asDict() == {
            "g": None, "h": None}
        assert spark.sql("SELECT hello_world() AS g").first().g
        for bad in ("5", "1.5", "true", "DATE '2024-01-01'", "2.5D"):
            with pytest.raises(Exception, match="exactly one string argument"):
                spark.sql(f"SELECT greet({bad}), id FROM range(3)").collect()
        df = spark.createDataFrame([("s", 1), (None, 2)], "a string, b int")
        df.createOrReplaceTempView("strict_args")
        got = {r.g for r in spark.sql("SELECT greet(a) AS g FROM strict_args").collect()}
        assert got == {"Hello World, s!", None}
        with pytest.raises(Exception, match="exactly one string argument"):
            spark.sql("SELECT welcome(b) FROM strict_args").collect()
        # the check of a literal is settled by the optimizer
        plan = spark.sql("SELECT greet(5)")._jdf.queryExecution().optimizedPlan().toString()
        assert "raise_error" in plan and "CASE" not in plan
        plan = spark.sql("SELECT greet('a')")._jdf.queryExecution().optimizedPlan().toString()
        assert "raise_error" not in plan
    finally:
        registry.register_builtins(spark)
    assert spark.sql("SELECT greet(5) AS g").first().g == "Hello World, 5!"


def test_unsigned_widen(spark):
    edges = {8: [0, 1, 127, -128, -1], 16: [0, 32767, -32768, -1], 32: [0, 2**31 - 1, -2**31, -1],
             64: [0, 2**63 - 1, -2**63, -1]}
    kinds = {8: "tinyint", 16: "smallint", 32: "int", 64: "bigint"}
    for bits, values in edges.items():
        df = spark.createDataFrame([(v,) for v in [*values, None]], f"v {kinds[bits]}")
        out = df.select("v", conv.unsigned_widen("v", bits).alias("u"))
        assert out.schema["u"].dataType.simpleString() == conv.WIDER[bits]
        for r in out.collect():
            assert r.u == (None if r.v is None else r.v % 2**bits)
    with pytest.raises(ValueError):
        conv.unsigned_widen("v", 24)
