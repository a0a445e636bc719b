"""Declared-schema Parquet tables: T1-T20 conversions, positional binding
(F21), the sales example (F8 / G13), catalog operations (S6-S13)."""

import datetime as dt
import decimal
import math
import os
import tempfile

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from medley.errors import NoSuchTableError, ReadOnlyTableError
from medley.sources import tables as tb


@pytest.fixture(scope="module")
def tmp():
    return tempfile.mkdtemp(prefix="medley-tables-")


def write(tmp, name, table):
    path = os.path.join(tmp, name)
    pq.write_table(table, path)
    return path


def one_col(tmp, name, arr):
    return write(tmp, f"{name}.parquet", pa.table({"c": arr}))


def values(spark, path, ddl):
    return [r[0] for r in tb.bind_parquet(spark, path, ddl).collect()]


def test_t1_bool_to_tinyint(spark, tmp):
    p = one_col(tmp, "t1", pa.array([True, False, None]))
    assert values(spark, p, "c TINYINT") == [1, 0, None]
    assert values(spark, p, "c INT") == [1, 0, None]
    assert values(spark, p, "c BOOLEAN") == [True, False, None]


@pytest.mark.parametrize("name,typ,vals", [
    ("t2", pa.int8(), [-128, 127]), ("t3", pa.int16(), [-32768, 32767]),
    ("t4", pa.int32(), [-2**31, 2**31 - 1]), ("t5", pa.int64(), [-2**63, 2**63 - 1]),
    ("t6", pa.uint8(), [0, 255]), ("t7", pa.uint16(), [0, 65535]),
    ("t8", pa.uint32(), [0, 2**32 - 1])])
def test_t2_t8_integers(spark, tmp, name, typ, vals):
    p = one_col(tmp, name, pa.array(vals + [None], type=typ))
    assert values(spark, p, "c BIGINT") == vals + [None]


def test_t9_uint64_kept_exact(spark, tmp):
    p = one_col(tmp, "t9", pa.array([0, 2**64 - 1, None], type=pa.uint64()))
    assert values(spark, p, "c DECIMAL(20,0)") == [decimal.Decimal(0), decimal.Decimal(2**64 - 1), None]
    # above 2^63-1 a BIGINT cannot hold it: permissive -> NULL
    assert values(spark, p, "c BIGINT") == [0, None, None]


def test_t10_half_float(spark, tmp):
    vals = np.array([1.0, -2.5, 65504.0, 6.1035156e-05, 5.9604645e-08, 0.0, -0.0,
                     np.inf, -np.inf, np.nan], dtype=np.float16)
    arr = pa.array(list(vals) + [None], type=pa.float16())
    p = one_col(tmp, "t10", arr)
    got = values(spark, p, "c FLOAT")
    for g, v in zip(got[:-1], vals):
        if np.isnan(v):
            assert math.isnan(g)
        else:
            assert g == float(v) and math.copysign(1, g) == math.copysign(1, float(v))
    assert got[-1] is None


def test_t11_t12_floats(spark, tmp):
    p = one_col(tmp, "t11", pa.array([1.5, None], type=pa.float32()))
    assert values(spark, p, "c DOUBLE") == [1.5, None]
    p = one_col(tmp, "t12", pa.array([1e300, None], type=pa.float64()))
    assert values(spark, p, "c DOUBLE") == [1e300, None]


def test_t13_t15_text_and_binary(spark, tmp):
    p = one_col(tmp, "t13", pa.array(["héllo", "홍길동", None], type=pa.string()))
    assert values(spark, p, "c STRING") == ["héllo", "홍길동", None]
    p = one_col(tmp, "t14", pa.array(["x", None], type=pa.large_string()))
    assert values(spark, p, "c STRING") == ["x", None]
    p = one_col(tmp, "t15", pa.array([b"\x00\xff", None], type=pa.binary()))
    assert values(spark, p, "c BINARY") == [bytearray(b"\x00\xff"), None]
    p = one_col(tmp, "t15b", pa.array([b"ab", None], type=pa.large_binary()))
    assert values(spark, p, "c BINARY") == [bytearray(b"ab"), None]


def test_t16_t17_dates(spark, tmp):
    d = [dt.date(1969, 12, 31), dt.date(2024, 2, 29), dt.date(1, 1, 1), None]
    assert values(spark, one_col(tmp, "t16", pa.array(d, type=pa.date32())), "c DATE") == d
    assert values(spark, one_col(tmp, "t17", pa.array(d[:2] + [None], type=pa.date64())),
                  "c DATE") == d[:2] + [None]


def test_t18_timestamps_all_units(spark, tmp):
    ts = [dt.datetime(1969, 12, 31, 23, 59, 58, 500000), dt.datetime(2024, 1, 2, 3, 4, 5, 123456)]
    for unit in ("s", "ms", "us"):
        arr = pa.array([t.replace(microsecond=0) if unit == "s" else
                        t.replace(microsecond=t.microsecond // 1000 * 1000) if unit == "ms" else t
                        for t in ts] + [None], type=pa.timestamp(unit))
        got = values(spark, one_col(tmp, f"t18{unit}", arr), "c TIMESTAMP_NTZ")
        assert got == arr.to_pylist()
    ns = pa.array([-1_500_000_001, 1_704_164_645_123_456_789, None], type=pa.timestamp("ns"))
    got = values(spark, one_col(tmp, "t18ns", ns), "c TIMESTAMP_NTZ")
    assert got == [dt.datetime(1969, 12, 31, 23, 59, 58, 499999),
                   dt.datetime(2024, 1, 2, 3, 4, 5, 123456), None]
    tz = pa.array([dt.datetime(2024, 1, 2, 3, 4, 5, tzinfo=dt.timezone.utc), None],
                  type=pa.timestamp("us", tz="UTC"))
    assert values(spark, one_col(tmp, "t18tz", tz), "c TIMESTAMP_NTZ") == \
        [dt.datetime(2024, 1, 2, 3, 4, 5), None]
    tzns = pa.array([1_000_000_000_123_456_789, None], type=pa.timestamp("ns", tz="UTC"))
    assert values(spark, one_col(tmp, "t18tzns", tzns), "c DATE") == [dt.date(2001, 9, 9), None]


def test_t19_decimals(spark, tmp):
    d = [decimal.Decimal("123.45"), decimal.Decimal("-0.01"), None]
    p = one_col(tmp, "t19", pa.array(d, type=pa.decimal128(10, 2)))
    assert values(spark, p, "c DECIMAL(10,2)") == d
    wide = [decimal.Decimal("1" * 50 + ".123"), decimal.Decimal("-" + "9" * 60 + ".000"),
            decimal.Decimal("0.005"), None]
    p = one_col(tmp, "t19w", pa.array(wide, type=pa.decimal256(70, 3)))
    assert values(spark, p, "c STRING") == ["1" * 50 + ".123", "-" + "9" * 60 + ".000", "0.005", None]


def test_t20_nested_time_and_others(spark, tmp):
    tbl = pa.table({
        "lst": pa.array([[1, 2], None]),
        "st": pa.array([{"a": 1, "b": "x"}, None]),
        "mp": pa.array([[("k", 1)], None], type=pa.map_(pa.string(), pa.int64())),
        "t32": pa.array([3723, None], type=pa.time32("s")),
        "t64": pa.array([3723000001, None], type=pa.time64("us")),
        "dur": pa.array([5, None], type=pa.duration("s")),
        "dic": pa.array(["a", None]).dictionary_encode(),
        "fsb": pa.array([b"ab", None], type=pa.binary(2)),
    })
    p = write(tmp, "t20.parquet", tbl)
    ddl = ("lst STRING, st STRING, mp STRING, t32 STRING, t64 STRING, dur BIGINT, "
           "dic STRING, fsb BINARY")
    rows = tb.bind_parquet(spark, p, ddl).collect()
    # Parquet has no seconds unit: time32[s] is stored (and shown) as milliseconds
    assert tuple(rows[0]) == ('[1,2]', '{"a":1,"b":"x"}', '{"k":1}', "01:02:03.000",
                              "01:02:03.000001", 5, "a", bytearray(b"ab"))
    assert all(v is None for v in rows[1])
    native = tb.bind_parquet(spark, p, "lst ARRAY<BIGINT>").first()
    assert native.lst == [1, 2]


def test_strict_mode_fails_on_bad_cell(spark, tmp):
    p = one_col(tmp, "bad", pa.array(["12", "abc"]))
    assert values(spark, p, "c INT") == [12, None]
    with pytest.raises(Exception):
        tb.bind_parquet(spark, p, "c INT", mode="strict").collect()


def test_f21_positional_cases(spark, tmp):
    p = write(tmp, "pos.parquet", pa.table({"x": [1, 2], "y": ["a", "b"], "z": [1.5, 2.5]}))
    assert [tuple(r) for r in tb.bind_parquet(spark, p, "id INT, name STRING").collect()] == \
        [(1, "a"), (2, "b")]
    assert [tuple(r) for r in tb.bind_parquet(
        spark, p, "id INT, name STRING, score DOUBLE, extra STRING").collect()] == \
        [(1, "a", 1.5, None), (2, "b", 2.5, None)]
    # a folder whose files differ in names and column order: each bound by its own footer
    d = os.path.join(tmp, "mixed")
    os.makedirs(d)
    pq.write_table(pa.table({"a": [1], "b": ["one"]}), os.path.join(d, "f1.parquet"))
    pq.write_table(pa.table({"name": ["two"], "id": [2]}), os.path.join(d, "f2.parquet"))
    pq.write_table(pa.table({"k": [3], "v": ["three"]}), os.path.join(d, "f3.parquet"))
    got = sorted(tuple(r) for r in tb.bind_parquet(spark, d, "first STRING, second STRING").collect())
    assert got == [("1", "one"), ("3", "three"), ("two", "2")]


def test_pruning_and_pushdown_survive_binding(spark):
    df = tb.bind_parquet(spark, "/root/testdata/sf0.01/lineitem.parquet",
                         "ok BIGINT, pk BIGINT, sk BIGINT, ln INT, qty DOUBLE, price DOUBLE")
    plan = df.where(F.col("price") > 1000.0).select("ok")._jdf.queryExecution() \
        .executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_extendedprice), GreaterThan(l_extendedprice,1000.0)]" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double>" in plan


def test_f8_sales_nanosecond_dates(spark, tmp):
    sales = pa.table({
        "order_id": pa.array([1, 2, 3], type=pa.int64()),
        "product": ["Apple", "Banana", "Cherry"],
        "amount": [10.5, 20.0, 15.75],
        "order_date": pa.array(np.array(["2024-01-01", "2024-01-02", "2024-01-03"],
                                        dtype="datetime64[ns]")),
    })
    p = write(tmp, "sales.parquet", sales)
    with pytest.raises(Exception):
        spark.read.parquet(p).collect()      # stock Spark refuses ns timestamps
    ddl = "order_id INT, product VARCHAR(128), amount DOUBLE, order_date DATE"
    tb.create_table(spark, "sales", ddl, path=p, replace=True)
    rows = [tuple(r) for r in spark.sql("SELECT * FROM sales ORDER BY order_id").collect()]
    assert rows == [(1, "Apple", 10.5, dt.date(2024, 1, 1)), (2, "Banana", 20.0, dt.date(2024, 1, 2)),
                    (3, "Cherry", 15.75, dt.date(2024, 1, 3))]
    # inner join on a text key with an ordinary table
    spark.createDataFrame([("Apple", "Fruit"), ("Cherry", "Fruit"), ("Durian", "Exotic")],
                          "name STRING, region STRING").createOrReplaceTempView("categories")
    joined = spark.sql("SELECT s.product, c.region FROM sales s JOIN categories c "
                       "ON s.product = c.name ORDER BY 1").collect()
    assert [tuple(r) for r in joined] == [("Apple", "Fruit"), ("Cherry", "Fruit")]
    # Read-only, the file is unchanged
    before = os.path.getsize(p)
    with pytest.raises(AnalysisException):
        spark.sql("INSERT INTO sales VALUES (4, 'Date', 1.0, DATE'2024-01-04')")
    with pytest.raises(ReadOnlyTableError):
        tb.insert_into(spark, "sales", [])
    assert os.path.getsize(p) == before
    # Open, drop (file kept), re-open by default path
    assert tb.open_table(spark, "sales").count() == 3
    assert tb.drop_table(spark, "sales")
    assert os.path.exists(p)
    assert not spark.catalog.tableExists("sales")
    with pytest.raises(NoSuchTableError):
        tb.open_table(spark, "sales")
    assert tb.open_table(spark, "sales", warehouse=tmp).count() == 3
    with pytest.raises(NoSuchTableError):
        tb.open_table(spark, "missing_table", warehouse=tmp)
    tb.drop_table(spark, "sales", if_exists=True)


def test_corrupt_file(spark, tmp):
    from medley.errors import CorruptTableError
    with open(os.path.join(tmp, "junk.parquet"), "wb") as fh:
        fh.write(b"not a parquet file at all")
    with pytest.raises(CorruptTableError):
        tb.open_table(spark, "junk", warehouse=tmp)


def test_row_position_and_fetch(spark):
    path = "/root/testdata/sf0.001/orders.parquet"
    t = tb.with_row_position(spark, path, spark.read.parquet(path).schema)
    pos = t.select("o_orderkey", "file_path", "row_index")
    raw = spark.read.parquet(path).collect()
    by_index = {r.row_index: r.o_orderkey for r in pos.collect()}
    assert by_index == {i: r.o_orderkey for i, r in enumerate(raw)}
    wanted = spark.createDataFrame([(raw[0] and pos.first().file_path, 3),
                                    (pos.first().file_path, 10 ** 9)], "file_path STRING, row_index BIGINT")
    got = tb.fetch_by_position(t, wanted).collect()
    assert [r.o_orderkey for r in got] == [raw[3].o_orderkey]
    assert tb.table_stats(t) == len(raw)


def test_folder_with_refused_types_and_mixed_footers(spark, tmp):
    """S13 + T18: a folder whose files have nanosecond timestamps (refused by
    Spark's inference) under different names and column orders."""
    d = os.path.join(tmp, "ns_folder")
    os.makedirs(d)
    ns = pa.array([1_704_164_645_123_456_789], type=pa.timestamp("ns"))
    pq.write_table(pa.table({"when": ns, "id": [1]}), os.path.join(d, "a.parquet"))
    pq.write_table(pa.table({"t": pa.array([0], type=pa.timestamp("ns")), "k": [2]}),
                   os.path.join(d, "b.parquet"))
    pq.write_table(pa.table({"t": pa.array([dt.datetime(2000, 1, 1)], type=pa.timestamp("us")),
                             "k": [3]}), os.path.join(d, "c.parquet"))
    got = sorted(tuple(r) for r in tb.bind_parquet(spark, d, "ts TIMESTAMP_NTZ, id BIGINT").collect())
    assert got == [(dt.datetime(1970, 1, 1), 2), (dt.datetime(2000, 1, 1), 3),
                   (dt.datetime(2024, 1, 2, 3, 4, 5, 123456), 1)]
    groups = tb.footer_groups(tb.footers(spark, d))
    assert len(groups) == 3 and sum(len(f) for _, _, f in groups) == 3


def test_single_footer_folder_is_read_whole(spark, tmp):
    """A folder whose files share one footer (nested too) is bound from
    one read of the folder, without a file list."""
    d = os.path.join(tmp, "same_footer")
    os.makedirs(os.path.join(d, "sub"))
    for i, rel in enumerate(["a.parquet", "b.parquet", os.path.join("sub", "c.parquet")]):
        pq.write_table(pa.table({"x": [i, i + 10], "y": ["p", None]}), os.path.join(d, rel))
    with open(os.path.join(d, "notes.txt"), "w") as fh:
        fh.write("not parquet")
    from medley.errors import CorruptTableError
    with pytest.raises(CorruptTableError):           # a file that is no Parquet is never skipped in silence
        tb.bind_parquet(spark, d, "id BIGINT")
    sigs = tb.footer_signatures(tb.footers(spark, d, "*.parquet"))
    assert len(sigs) == 1 and sigs[0][2] == 3
    got = sorted(tuple(r) for r in tb.bind_parquet(spark, d, "id BIGINT, label STRING, extra INT",
                                                   glob="*.parquet").collect())
    assert got == [(0, "p", None), (1, "p", None), (2, "p", None),
                   (10, None, None), (11, None, None), (12, None, None)]


def test_files_of_any_suffix_are_bound(spark, tmp):
    d = os.path.join(tmp, "suffixes")
    os.makedirs(d)
    pq.write_table(pa.table({"x": [1, 2]}), os.path.join(d, "a.parquet"))
    pq.write_table(pa.table({"x": [3, 4]}), os.path.join(d, "b.parq"))
    assert sorted(r.id for r in tb.bind_parquet(spark, d, "id BIGINT").collect()) == [1, 2, 3, 4]


def test_folder_of_nanosecond_files_opens_without_a_schema(spark, tmp):
    d = os.path.join(tmp, "opened.parquet")
    os.makedirs(d)
    for i in range(2):
        pq.write_table(pa.table({"t": pa.array([i * 1_000_000_000], type=pa.timestamp("ns")), "k": [i]}),
                       os.path.join(d, f"part-{i}.parquet"))
    got = sorted(tuple(r) for r in tb.open_table(spark, "opened", warehouse=tmp).collect())
    assert got == [(dt.datetime(1970, 1, 1), 0), (dt.datetime(1970, 1, 1, 0, 0, 1), 1)]


def test_refused_types_inside_nested_columns(spark, tmp):
    import numpy as np
    p = os.path.join(tmp, "nested_refused.parquet")
    ns = pa.timestamp("ns")
    pq.write_table(pa.table({
        "l": pa.array([[1_704_067_200_000_000_000], None], pa.list_(ns)),
        "s": pa.array([{"h": np.float16(1.5), "n": 1}, None], pa.struct([("h", pa.float16()), ("n", pa.int64())])),
    }), p)
    got = tb.bind_parquet(spark, p, "l STRING, s STRING").collect()
    assert got[0].l == '["2024-01-01T00:00:00.000"]' and got[0].s == '{"h":1.5,"n":1}'
    assert got[1].l is None and got[1].s is None


def test_table_outlives_the_session(spark, tmp):
    p = os.path.join(tmp, "kept.parquet")
    pq.write_table(pa.table({"a": [1, 2]}), p)
    tb.create_table(spark, "kept", "x BIGINT", path=p, replace=True)
    other = spark.newSession()
    assert tb.open_table(other, "kept").columns == ["x"]
    assert other.sql("SELECT sum(x) FROM kept").first()[0] == 3
    assert tb.drop_table(spark, "kept")
    with pytest.raises(NoSuchTableError):
        tb.open_table(spark.newSession(), "kept")


# ---- S5: what a permissive binding refuses -------------------------------------

def test_rejects_name_every_cell_and_leave_the_rows(spark, tmp):
    path = write(tmp, "refused.parquet", pa.table({
        "a": pa.array([1, 300, None, -5], pa.int64()), "b": ["7", "x", None, "8.5"],
        "c": pa.array([2**40, 9, None, 12], pa.decimal128(20, 2)),
        "d": pa.array([dt.time(1, 2, 3), None, dt.time(4, 5, 6), None], pa.time64("us")),
        "e": ["kept", "as", "it", None]}))
    ddl = "a TINYINT, b INT, c INT, d INT, e STRING, missing DATE"
    rows, rejects = tb.bind_with_rejects(spark, path, ddl)
    assert [tuple(r) for r in rows.collect()] == [tuple(r) for r in tb.bind_parquet(spark, path, ddl).collect()]
    assert rows.columns == ["a", "b", "c", "d", "e", "missing"]
    got = {(r.row_index, r.column): r.raw for r in rejects.collect()}
    want = {(1, "a"): "300", (1, "b"): "x", (3, "b"): "8.5"}
    assert {k: v for k, v in got.items() if k[1] in "ab"} == want
    assert got[0, "c"] == f"{2**40}.00" and len([k for k in got if k[1] == "c"]) == 1
    assert all(v.count(":") == 2 for k, v in got.items() if k[1] == "d")
    assert not any(k[1] in ("e", "missing") for k in got)
    assert rejects.select("file_path").distinct().count() == 1


def test_rejects_of_a_folder_with_different_footers(spark, tmp):
    folder = os.path.join(tmp, "refused-folder")
    os.makedirs(folder)
    pq.write_table(pa.table({"x": ["1", "no"]}), os.path.join(folder, "a.parquet"))
    pq.write_table(pa.table({"y": pa.array([5, 500], pa.int32())}), os.path.join(folder, "b.parquet"))
    rows, rejects = tb.bind_with_rejects(spark, folder, "v TINYINT")
    assert sorted((r.v is None, r.v or 0) for r in rows.collect()) == [(False, 1), (False, 5), (True, 0), (True, 0)]
    assert sorted((r.raw, r.row_index) for r in rejects.collect()) == [("500", 1), ("no", 1)]


def test_rows_do_not_compute_rejects(spark, tmp):
    path = write(tmp, "pruned.parquet", pa.table({"a": ["1", "x"], "b": ["2", "y"]}))
    rows, rejects = tb.bind_with_rejects(spark, path, "a INT, b INT")
    plan = rows.select("a")._jdf.queryExecution().executedPlan().toString()
    assert "row_index" not in plan and "b#" not in plan
    assert rejects.where("column = 'a'").count() == 1


# ---- S6: permanent views -------------------------------------------------------

def test_a_view_is_found_from_another_session_and_refuses_inserts(spark, tmp):
    path = write(tmp, "viewed.parquet", pa.table({
        "k": pa.array([1, 2, 300], pa.int64()), "odd `name": ["a", "b", "c"], "flag": [True, False, None],
        "at": pa.array([0, 86_400_000_000, None], pa.timestamp("us", tz="UTC"))}))
    ddl = "id TINYINT, name STRING, flag INT, day DATE, extra DOUBLE"
    text = tb.create_view(spark, "v_sales", ddl, path)
    try:
        other = spark.newSession()
        got = sorted(map(tuple, other.sql("SELECT * FROM v_sales").collect()), key=str)
        assert got == sorted(map(tuple, tb.bind_parquet(spark, path, ddl).collect()), key=str)
        assert [f.dataType.simpleString() for f in other.table("v_sales").schema] == [
            "tinyint", "string", "int", "date", "double"]
        for bad in ("INSERT INTO v_sales VALUES (1, 'x', 1, NULL, 1.0)", "INSERT OVERWRITE v_sales SELECT * FROM v_sales"):
            with pytest.raises(AnalysisException):
                other.sql(bad)
        with pytest.raises(AnalysisException):
            tb.create_view(spark, "v_sales", ddl, path)
        assert "TRY_CAST" in text and "TRY_CAST" not in tb.create_view(
            spark, "v_sales", "id BIGINT, name STRING", path, replace=True)
        assert other.sql("SELECT max(id) AS m FROM v_sales").first().m == 300
        plan = other.sql("SELECT name FROM v_sales WHERE id > 1")._jdf.queryExecution().executedPlan().toString()
        assert "GreaterThan(k,1)" in plan and "flag" not in plan.split("ReadSchema")[1]
    finally:
        tb.drop_view(spark, "v_sales")
    with pytest.raises(AnalysisException):
        spark.newSession().sql("SELECT * FROM v_sales")
    tb.drop_view(spark, "v_sales", if_exists=True)
    assert os.path.exists(path)


def test_a_view_over_a_folder_of_two_footers(spark, tmp):
    folder = os.path.join(tmp, "viewed-folder")
    os.makedirs(os.path.join(folder, "deep"))
    for name in ("a.parquet", "deep/c.parquet"):
        pq.write_table(pa.table({"x": pa.array([1, 2], pa.int64())}), os.path.join(folder, name))
    pq.write_table(pa.table({"y": ["3", "z"]}), os.path.join(folder, "b.parquet"))
    tb.create_view(spark, "v_mixed", "v INT", folder, replace=True)
    try:
        got = [r.v for r in spark.newSession().sql("SELECT v FROM v_mixed").collect()]
        assert sorted(got, key=str) == sorted([1, 2, 1, 2, 3, None], key=str)
    finally:
        tb.drop_view(spark, "v_mixed")


def test_a_view_cannot_hold_what_sql_cannot_read(spark, tmp):
    path = write(tmp, "nanos.parquet", pa.table({"t": pa.array([1], pa.timestamp("ns"))}))
    with pytest.raises(ValueError, match="SQL cannot read"):
        tb.create_view(spark, "v_nanos", "t TIMESTAMP_NTZ", path)
    with pytest.raises(NoSuchTableError):
        tb.create_view(spark, "v_none", "t INT", os.path.join(tmp, "nowhere.parquet"))
