"""Registered queries over the given tables, each with its DuckDB oracle.

``QUERIES[key] = (build(spark, sf_dir) -> DataFrame, oracle SQL or None)``.
aggregates are rounded on both sides (summation order differs between engines).
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, functions as F

from medley.functions import conversions as conv
from medley.functions import registry, scalar
from medley.operators import logs, median as med, metrics as mx
from medley.plans import given as G
from medley.plans.given import with_samples

QUERIES: dict[str, tuple] = {}


def query(key: str, sql: str | None):
    def deco(fn):
        QUERIES[key] = (fn, sql)
        return fn
    return deco


def _t(spark, sf, name):
    return G.table(spark, sf, name)


# ----------------------------------------------------------------- flagship

FLAGSHIP_SQL = """
SELECT l_returnflag AS returnflag, l_linestatus AS linestatus,
       sum(l_quantity) AS sum_qty, round(sum(l_extendedprice), 2) AS sum_price,
       count(*) AS count_order, round(median(l_extendedprice), 4) AS median_price
FROM lineitem
WHERE l_shipdate <= TIMESTAMP '2000-12-01 00:00:00'
GROUP BY l_returnflag, l_linestatus"""


@query("flagship_median_summary", FLAGSHIP_SQL)
def flagship(spark, sf):
    """Positional bind of lineitem -> filter -> sum + exact median by flag."""
    li = G.bound(spark, sf, "lineitem", G.LINEITEM_DECLARED)
    li = li.where(F.col("shipdate") <= F.lit("2000-12-01").cast("date"))
    m = med.median(li, "extendedprice", ["returnflag", "linestatus"], strategy="rank",
                   combine_aggs=[("sum_qty", "sum", "quantity"),
                                 ("_sum_price", "sum", "extendedprice"),
                                 ("count_order", "count", "*")])
    return m.select("returnflag", "linestatus", "sum_qty",
                    F.round("_sum_price", 2).alias("sum_price"), "count_order",
                    F.round("median", 4).alias("median_price"))


# ----------------------------------------------------------------- S: tables

@query("parquet_scan", "SELECT * FROM lineitem")
def parquet_scan(spark, sf):
    raw = _t(spark, sf, "lineitem")
    return G.bound(spark, sf, "lineitem", raw.schema)


@query("positional_bind",
       "SELECT n_nationkey AS id, n_name AS label, n_regionkey AS region FROM nation")
def positional_bind(spark, sf):
    return G.bound(spark, sf, "nation", "id INT, label STRING, region INT")


@query("bind_rejects", """
SELECT row_index, 'custkey' AS "column", c_custkey::VARCHAR AS raw
FROM (SELECT *, row_number() OVER () - 1 AS row_index FROM customer) c
WHERE c_custkey IS NOT NULL AND TRY_CAST(c_custkey AS TINYINT) IS NULL
UNION ALL
SELECT row_index, 'name', c_name FROM (SELECT *, row_number() OVER () - 1 AS row_index FROM customer) c
WHERE c_name IS NOT NULL AND TRY_CAST(c_name AS INTEGER) IS NULL
UNION ALL
SELECT row_index, 'segment', c_mktsegment FROM (SELECT *, row_number() OVER () - 1 AS row_index FROM customer) c
WHERE c_mktsegment IS NOT NULL AND TRY_CAST(c_mktsegment AS BOOLEAN) IS NULL""")
def bind_rejects(spark, sf):
    """Every cell of customer that the declared types refuse."""
    from medley.sources.tables import bind_with_rejects
    _rows, rejects = bind_with_rejects(
        spark, G.path(sf, "customer"),
        "custkey TINYINT, name INT, nationkey STRING, acctbal DOUBLE, segment BOOLEAN")
    return rejects.select("row_index", "column", "raw")


@query("permanent_view", """
SELECT o_orderpriority AS priority, count(*) AS n, round(sum(o_totalprice), 2) AS total,
       count(DISTINCT CAST(o_orderdate AS DATE)) AS days
FROM orders GROUP BY o_orderpriority""")
def permanent_view(spark, sf):
    """Orders bound by position as a view of the catalog, queried by name from
    another session than the one that made it."""
    from medley.sources.tables import create_view
    create_view(spark, "medley_orders_view", "orderkey BIGINT, custkey BIGINT, status STRING, "
                "totalprice DOUBLE, orderdate DATE, priority STRING", G.path(sf, "orders"), replace=True)
    return spark.newSession().sql(
        "SELECT priority, count(*) AS n, round(sum(totalprice), 2) AS total, "
        "count(DISTINCT orderdate) AS days FROM medley_orders_view GROUP BY priority")


@query("missing_column_null_fill",
       "SELECT r_regionkey AS id, r_name AS label, CAST(NULL AS VARCHAR) AS extra FROM region")
def missing_column_null_fill(spark, sf):
    return G.bound(spark, sf, "region", "id INT, label STRING, extra STRING")


@query("create_table", """
SELECT o_orderstatus AS status, count(*) AS n, round(sum(o_totalprice), 2) AS total
FROM orders GROUP BY o_orderstatus""")
def create_table(spark, sf):
    """Orders registered under a declared schema (positional, read-only
    view) and queried by name in SQL."""
    from medley.sources.tables import create_table as create
    create(spark, "medley_orders", "orderkey BIGINT, custkey BIGINT, status STRING, "
           "totalprice DOUBLE, orderdate TIMESTAMP_NTZ, priority STRING",
           path=G.path(sf, "orders"), replace=True)
    return spark.sql("SELECT status, count(*) AS n, round(sum(totalprice), 2) AS total "
                     "FROM medley_orders GROUP BY status")


@query("open_table", "SELECT * FROM supplier")
def open_table(spark, sf):
    """An unregistered name resolves to <warehouse>/<name>.parquet with
    the file's own columns."""
    from medley.sources.tables import open_table as open_
    return open_(spark, "supplier", warehouse=sf)


@query("extra_column_prune", "SELECT c_custkey AS custkey, c_name AS name FROM customer")
def extra_column_prune(spark, sf):
    return G.bound(spark, sf, "customer", "custkey BIGINT, name STRING")


@query("type_conform", """
SELECT l_orderkey AS orderkey, l_partkey AS partkey, l_suppkey AS suppkey,
       CAST(l_linenumber AS BIGINT) AS linenumber,
       CAST(trunc(l_quantity) AS INTEGER) AS quantity,
       l_extendedprice AS extendedprice, l_discount AS discount, l_tax AS tax,
       l_returnflag AS returnflag, l_linestatus AS linestatus,
       CAST(l_shipdate AS DATE) AS shipdate
FROM lineitem""")
def type_conform(spark, sf):
    return G.bound(spark, sf, "lineitem",
                   "orderkey BIGINT, partkey BIGINT, suppkey BIGINT, linenumber BIGINT, "
                   "quantity INT, extendedprice DOUBLE, discount DOUBLE, tax DOUBLE, "
                   "returnflag STRING, linestatus STRING, shipdate DATE")


@query("table_stats", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in G.TABLES))
def table_stats(spark, sf):
    parts = [_t(spark, sf, t).agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(t).alias("table_name"), "row_count") for t in G.TABLES]
    return functools.reduce(DataFrame.unionAll, parts)


@query("multi_file_bind", "\nUNION ALL\n".join(
    f"SELECT CAST({c} AS BIGINT) AS id FROM {t}" for t, c in [
        ("region", "r_regionkey"), ("nation", "n_nationkey"), ("customer", "c_custkey"),
        ("supplier", "s_suppkey"), ("part", "p_partkey"), ("orders", "o_orderkey"),
        ("lineitem", "l_orderkey"), ("events", "event_id"), ("documents", "doc_id"),
        ("embeddings", "vec_id"), ("pages", "page_id"), ("benchmark", "item_id"),
        ("labels", "doc_id"), ("conversations", "conv_id")]))
def multi_file_bind(spark, sf):
    """Every Parquet file of the folder, each with its own footer, bound by
    position to one declared column (14 footers, 14 groups, one union)."""
    return G.bound_folder(spark, sf, "id BIGINT")


@query("row_position", "SELECT o_orderkey, row_number() OVER () - 1 AS row_index FROM orders")
def row_position(spark, sf):
    """Stable (file, row) position of every orders row."""
    from medley.sources.tables import with_row_position
    return with_row_position(spark, G.path(sf, "orders"), _t(spark, sf, "orders").schema) \
        .select("o_orderkey", "row_index")


@query("fetch_by_position",
       "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority = '1-URGENT'")
def fetch_by_position(spark, sf):
    """Re-fetch the orders rows whose position was saved for 1-URGENT orders."""
    from medley.sources.tables import fetch_by_position as fetch, with_row_position
    t = with_row_position(spark, G.path(sf, "orders"), _t(spark, sf, "orders").schema)
    saved = t.where(F.col("o_orderpriority") == "1-URGENT").select("file_path", "row_index")
    return fetch(t, saved).select("o_orderkey", "o_orderpriority")


# ----------------------------------------------------------------- R: relational

@query("project_all", "SELECT * FROM orders")
def project_all(spark, sf):
    return _t(spark, sf, "orders").select("*")


@query("project_columns", "SELECT o_orderkey AS order_id, o_totalprice AS total FROM orders")
def project_columns(spark, sf):
    return _t(spark, sf, "orders").select(F.col("o_orderkey").alias("order_id"),
                                          F.col("o_totalprice").alias("total"))


@query("filter_compare", """
SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
WHERE l_extendedprice > 90000.0""")
def filter_compare(spark, sf):
    return (_t(spark, sf, "lineitem").where(F.col("l_extendedprice") > 90000.0)
            .select("l_orderkey", "l_linenumber", "l_extendedprice"))


@query("filter_eq", "SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING'")
def filter_eq(spark, sf):
    return (_t(spark, sf, "customer").where(F.col("c_mktsegment") == "BUILDING")
            .select("c_custkey", "c_name"))


@query("filter_in", """
SELECT o_orderkey, o_orderpriority FROM orders
WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')""")
def filter_in(spark, sf):
    return (_t(spark, sf, "orders").where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
            .select("o_orderkey", "o_orderpriority"))


@query("filter_like", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE '_ot %'")
def filter_like(spark, sf):
    return _t(spark, sf, "part").where(F.col("p_name").like("_ot %")).select("p_partkey", "p_name")


@query("filter_empty", """
SELECT count(*) AS n, sum(l_quantity) AS total_qty FROM lineitem WHERE l_quantity > 9999""")
def filter_empty(spark, sf):
    return (_t(spark, sf, "lineitem").where(F.col("l_quantity") > 9999)
            .agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("total_qty")))


@query("sum_by_group", """
SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty,
       round(sum(l_extendedprice), 2) AS sum_price, count(*) AS n
FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def sum_by_group(spark, sf):
    return (_t(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus")
            .agg(F.sum("l_quantity").alias("sum_qty"),
                 F.round(F.sum("l_extendedprice"), 2).alias("sum_price"),
                 F.count(F.lit(1)).alias("n")))


@query("order_by_desc", """
SELECT p_brand, sum(l_quantity) AS total
FROM lineitem JOIN part ON l_partkey = p_partkey
GROUP BY p_brand ORDER BY total DESC""")
def order_by_desc(spark, sf):
    li = _t(spark, sf, "lineitem").select("l_partkey", "l_quantity")
    # pre-aggregate lineitem per part before the join: the join then sees one
    # row per part instead of one per line
    per_part = li.groupBy("l_partkey").agg(F.sum("l_quantity").alias("q"))
    p = _t(spark, sf, "part").select("p_partkey", "p_brand")
    return (per_part.join(p, per_part.l_partkey == p.p_partkey)
            .groupBy("p_brand").agg(F.sum("q").alias("total"))
            .orderBy(F.desc("total")))


@query("limit", """
SELECT o_orderkey, o_totalprice FROM orders
ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""")
def limit(spark, sf):
    return (_t(spark, sf, "orders").select("o_orderkey", "o_totalprice")
            .orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10))


@query("inner_equi_join", """
SELECT o_orderpriority, l_returnflag, count(*) AS n, sum(l_quantity) AS sum_qty
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
GROUP BY o_orderpriority, l_returnflag""")
def inner_equi_join(spark, sf):
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_returnflag", "l_quantity")
    o = _t(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    # one shuffle per side on the join key; pre-aggregating lineitem per
    # (order, flag) would partition on both columns and force a second shuffle
    return (li.join(o, li.l_orderkey == o.o_orderkey)
            .groupBy("o_orderpriority", "l_returnflag")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("sum_qty")))


@query("join_text_key", """
SELECT c_custkey, c_mktsegment, n_name, r_name
FROM customer JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
JOIN (SELECT DISTINCT r_name AS rn FROM region) x ON r_name = x.rn""")
def join_text_key(spark, sf):
    """R11 with a text key (region name)."""
    c = _t(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    n = _t(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = _t(spark, sf, "region").select("r_regionkey", "r_name")
    names = _t(spark, sf, "region").select(F.col("r_name").alias("rn")).distinct()
    return (c.join(n, c.c_nationkey == n.n_nationkey).join(r, F.col("n_regionkey") == r.r_regionkey)
            .join(names, F.col("r_name") == names.rn)
            .select("c_custkey", "c_mktsegment", "n_name", "r_name"))


@query("mixed_aggregates", """
SELECT l_returnflag, count(*) AS n, round(avg(l_quantity), 6) AS avg_qty,
       round(median(l_extendedprice), 4) AS median_price
FROM lineitem GROUP BY l_returnflag""")
def mixed_aggregates(spark, sf):
    li = _t(spark, sf, "lineitem")
    m = med.median(li, "l_extendedprice", ["l_returnflag"],
                   extra_aggs=[F.count(F.lit(1)).alias("n"), F.avg("l_quantity").alias("_avg")])
    return m.select("l_returnflag", "n", F.round("_avg", 6).alias("avg_qty"),
                    F.round("median", 4).alias("median_price"))


# ----------------------------------------------------------------- U: functions

@query("hello_const", "SELECT r_regionkey, 'Hello World from UDF!' AS hello FROM region")
def hello_const(spark, sf):
    return _t(spark, sf, "region").select("r_regionkey", scalar.hello_world().alias("hello"))


@query("hello_const_alt",
       "SELECT n_nationkey, 'Hello World Mysql Plugin-UDF' AS hello FROM nation")
def hello_const_alt(spark, sf):
    registry.register_builtins(spark)
    return spark.sql(f"SELECT n_nationkey, helloworld() AS hello FROM parquet.`{G.path(sf, 'nation')}`")


@query("hello_const_over_table",
       "SELECT c_custkey, 'Hello World Mysql Plugin-UDF' AS hello FROM customer")
def hello_const_over_table(spark, sf):
    c = _t(spark, sf, "customer")
    return c.select("c_custkey", registry.call(c, "helloworld").alias("hello"))


@query("greet", "SELECT c_custkey, 'Hello World, ' || c_name || '!' AS greeting FROM customer")
def greet(spark, sf):
    c = _t(spark, sf, "customer")
    return c.select("c_custkey", registry.call(c, "greet", "c_name").alias("greeting"))


@query("welcome",
       "SELECT c_custkey, 'Welcome ' || c_name || ', HelloWorld Mysql Plugin' AS welcome FROM customer")
def welcome(spark, sf):
    registry.register_builtins(spark)
    return spark.sql("SELECT c_custkey, welcome(c_name) AS welcome "
                     f"FROM parquet.`{G.path(sf, 'customer')}`")


@query("null_propagation", """
SELECT c_custkey, 'Welcome ' || nullif(c_mktsegment, 'BUILDING') || ', HelloWorld Mysql Plugin' AS welcome
FROM customer""")
def null_propagation(spark, sf):
    c = _t(spark, sf, "customer")
    arg = F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))
    return c.select("c_custkey", registry.call(c, "welcome", arg).alias("welcome"))


@query("type_coerce", """
SELECT c_custkey, 'Hello World, ' || CAST(c_nationkey AS VARCHAR) || '!' AS greeting,
       CAST(c_nationkey AS DOUBLE) AS nation_real
FROM customer""")
def type_coerce(spark, sf):
    c = _t(spark, sf, "customer")
    arg = scalar.coerce("c_nationkey", "STRING")
    return c.select("c_custkey", registry.call(c, "greet", arg).alias("greeting"),
                    scalar.coerce("c_nationkey", "REAL").alias("nation_real"))


# ----------------------------------------------------------------- C: conversions

@query("days_to_date", """
SELECT o_orderkey, DATE '1970-01-01' + CAST(o_orderkey % 40000 - 20000 AS INTEGER) AS d
FROM orders""")
def days_to_date(spark, sf):
    o = _t(spark, sf, "orders")
    return o.select("o_orderkey", conv.days_to_date(F.col("o_orderkey") % 40000 - 20000).alias("d"))


@query("millis_to_date", """
SELECT o_orderkey,
       DATE '1970-01-01' + CAST(floor((o_orderkey % 40000 - 20000) * 43200001 / 86400000) AS INTEGER) AS d
FROM orders""")
def millis_to_date(spark, sf):
    o = _t(spark, sf, "orders")
    ms = (F.col("o_orderkey") % 40000 - 20000) * 43200001
    return o.select("o_orderkey", conv.millis_to_date(ms).alias("d"))


_NS = "((event_id % 100000) * 86413000000007 - 400000000000000000)"
_NS_FLOOR_US = f"(({_NS} - ((({_NS}) % 1000) + 1000) % 1000) // 1000)"


@query("epoch_to_datetime", f"""
SELECT event_id,
       make_timestamp(((event_id % 100000) * 86413 - 500000000) * 1000000) AS from_s,
       make_timestamp(((event_id % 100000) * 86413007 - 500000000000) * 1000) AS from_ms,
       make_timestamp((event_id % 100000) * 86413000007 - 500000000000000) AS from_us,
       make_timestamp({_NS_FLOOR_US}) AS from_ns
FROM events""")
def epoch_to_datetime(spark, sf):
    e = _t(spark, sf, "events")
    i = F.col("event_id") % 100000
    return e.select(
        "event_id",
        conv.epoch_to_datetime(i * 86413 - 500000000, "s").alias("from_s"),
        conv.epoch_to_datetime(i * 86413007 - 500000000000, "ms").alias("from_ms"),
        conv.epoch_to_datetime(i * 86413000007 - 500000000000000, "us").alias("from_us"),
        conv.epoch_to_datetime(i * 86413000000007 - 400000000000000000, "ns").alias("from_ns"))


@query("bool_to_int", """
SELECT l_orderkey, l_linenumber, CAST(l_returnflag = 'A' AS TINYINT) AS is_a FROM lineitem""")
def bool_to_int(spark, sf):
    li = _t(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     conv.bool_to_int(F.col("l_returnflag") == "A").alias("is_a"))


# 16-bit patterns spread over every class (zero, subnormal, normal, inf, NaN)
_HALF_BITS = "(l_orderkey * 7919 + l_linenumber * 104729) % 65536"


@query("half_to_float", f"""
SELECT l_orderkey, l_linenumber, bits,
  CAST(CASE WHEN e = 31 THEN
              CASE WHEN m = 0 THEN (CASE WHEN sgn = 1 THEN '-inf' ELSE 'inf' END)::DOUBLE
                   ELSE 'nan'::DOUBLE END
            ELSE (CASE WHEN sgn = 1 THEN -1.0 ELSE 1.0 END) *
                 (CASE WHEN e = 0 THEN m * pow(2.0, -24)
                       ELSE pow(2.0, e - 15) * (1.0 + m / 1024.0) END) END AS FLOAT) AS value
FROM (SELECT l_orderkey, l_linenumber, bits, bits // 32768 AS sgn,
             (bits // 1024) % 32 AS e, bits % 1024 AS m
      FROM (SELECT l_orderkey, l_linenumber, {_HALF_BITS} AS bits FROM lineitem) b) f""")
def half_to_float(spark, sf):
    """C6 over 2-byte little-endian half floats built from lineitem keys."""
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber",
                                          F.expr(_HALF_BITS).alias("bits"))
    le = F.shiftleft(F.col("bits").bitwiseAND(255), 8).bitwiseOR(F.shiftright("bits", 8))
    raw = F.unhex(F.lpad(F.hex(le), 4, "0"))
    return li.select("l_orderkey", "l_linenumber", "bits", conv.half_to_float(raw).alias("value"))


def wide_decimal_bytes() -> F.Column:
    """24-byte big-endian two's complement integers from lineitem keys:
    orderkey * 2^128 + partkey * 2^64 + suppkey, negated (one's complement,
    i.e. -x - 1) on odd line numbers."""
    def word(c):
        return F.when(F.col("l_linenumber") % 2 == 1, F.bitwise_not(F.col(c))).otherwise(F.col(c))

    hx = F.concat(*[F.lpad(F.hex(word(c)), 16, "0") for c in ("l_orderkey", "l_partkey", "l_suppkey")])
    return F.unhex(hx)


# The value is orderkey * 2^128 + partkey * 2^64 + suppkey, in two limbs of 10^18:
# 2^128 = 340282366920938463463 * 10^18 + 374607431768211456 and
# 2^64 = 18 * 10^18 + 446744073709551616. Odd lines hold -value - 1.
@query("wide_decimal_text", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN neg THEN '-' ELSE '' END || substr(digits, 1, length(digits) - 2) || '.' || right(digits, 2) AS text
FROM (SELECT *, CASE WHEN length(raw) < 3 THEN lpad(raw, 3, '0') ELSE raw END AS digits
      FROM (SELECT *, CASE WHEN hi2 > 0 THEN hi2::VARCHAR || lpad(lo2::VARCHAR, 18, '0') ELSE lo2::VARCHAR END AS raw
            FROM (SELECT *, hi + lo // 1000000000000000000::HUGEINT AS hi2, lo % 1000000000000000000::HUGEINT AS lo2
                  FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_linenumber % 2 = 1 AS neg,
                               l_orderkey::HUGEINT * 340282366920938463463::HUGEINT + l_partkey::HUGEINT * 18 AS hi,
                               l_orderkey::HUGEINT * 374607431768211456::HUGEINT
                               + l_partkey::HUGEINT * 446744073709551616::HUGEINT + l_suppkey::HUGEINT
                               + CASE WHEN l_linenumber % 2 = 1 THEN 1 ELSE 0 END AS lo
                        FROM lineitem) a) b) c) d""")
def wide_decimal_text(spark, sf):
    """DECIMAL(58, 2) held as 24 bytes -> exact text."""
    li = _t(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                     conv.wide_decimal_text(wide_decimal_bytes(), 2).alias("text"))


# The values that an unsigned column holds, past every sign bit; Spark gets them as
# the signed integers of the same bits.
_UNSIGNED = "(l_orderkey * 7919 + l_partkey * 31 + l_linenumber * 40503)"


@query("unsigned_widen", f"""
SELECT l_orderkey, l_linenumber, CAST(v % 256 AS SMALLINT) AS u8, CAST(v % 65536 AS INTEGER) AS u16,
       (v * 65537) % 4294967296 AS u32,
       (CASE WHEN v % 2 = 0 THEN v::HUGEINT ELSE 18446744073709551616::HUGEINT - v END)::VARCHAR AS u64
FROM (SELECT l_orderkey, l_linenumber, {_UNSIGNED} AS v FROM lineitem) x""")
def unsigned_widen(spark, sf):
    """Stored two's complement of 8, 16, 32 and 64 bits read as unsigned."""
    def stored(value: str, bits: int, kind: str):
        half = 1 << (bits - 1)
        return F.expr(f"cast(pmod({value} + {half}, {2 * half}) - {half} AS {kind})")

    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.expr(_UNSIGNED).alias("v"))
    held = li.select("l_orderkey", "l_linenumber", stored("v", 8, "tinyint").alias("b8"),
                     stored("v", 16, "smallint").alias("b16"), stored("v * 65537", 32, "int").alias("b32"),
                     F.expr("if(v % 2 = 0, v, -v)").alias("b64"))
    return held.select("l_orderkey", "l_linenumber",
                       *[conv.unsigned_widen(f"b{n}", n).alias(f"u{n}") for n in (8, 16, 32)],
                       conv.unsigned_widen("b64", 64).cast("string").alias("u64"))


@query("nested_to_text", """
SELECT c_custkey,
  to_json({'c_custkey': c_custkey, 'c_name': c_name, 'c_nationkey': c_nationkey,
           'c_mktsegment': c_mktsegment, 'keys': [c_custkey, c_nationkey]})::VARCHAR AS doc
FROM customer""")
def nested_to_text(spark, sf):
    """A struct holding an array, as JSON text."""
    c = _t(spark, sf, "customer")
    nested = F.struct("c_custkey", "c_name", "c_nationkey", "c_mktsegment",
                      F.array(F.col("c_custkey"), F.col("c_nationkey").cast("bigint")).alias("keys"))
    return c.select("c_custkey", conv.nested_to_text(nested).alias("doc"))


# ----------------------------------------------------------------- A: median

@query("median_global", "SELECT round(median(l_extendedprice), 4) AS median FROM lineitem")
def median_global(spark, sf):
    m = med.median(_t(spark, sf, "lineitem"), "l_extendedprice")
    return m.select(F.round("median", 4).alias("median"))


@query("median_by_group", """
SELECT l_returnflag, round(median(l_extendedprice), 4) AS median FROM lineitem GROUP BY l_returnflag""")
def median_by_group(spark, sf):
    m = med.median(_t(spark, sf, "lineitem"), "l_extendedprice", ["l_returnflag"])
    return m.select("l_returnflag", F.round("median", 4).alias("median"))


@query("median_mixed", """
SELECT event_type, count(*) AS n, round(avg(value), 6) AS avg_value,
       round(median(value), 4) AS median_value, max(value) AS max_value
FROM events GROUP BY event_type""")
def median_mixed(spark, sf):
    m = med.median(_t(spark, sf, "events"), "value", ["event_type"], strategy="rank",
                   combine_aggs=[("n", "count", "*"), ("_avg", "avg", "value"),
                                 ("max_value", "max", "value")])
    return m.select("event_type", "n", F.round("_avg", 6).alias("avg_value"),
                    F.round("median", 4).alias("median_value"), "max_value")


@query("median_empty", """
SELECT round(median(l_extendedprice), 4) AS median FROM lineitem WHERE l_quantity > 9999""")
def median_empty(spark, sf):
    li = _t(spark, sf, "lineitem").where(F.col("l_quantity") > 9999)
    return med.median(li, "l_extendedprice", strategy="rank").select(
        F.round("median", 4).alias("median"))


@query("median_nulls", """
SELECT event_type, round(median(CASE WHEN event_type = 'error' OR value > 400 THEN NULL ELSE value END), 4) AS median
FROM events GROUP BY event_type""")
def median_nulls(spark, sf):
    e = _t(spark, sf, "events")
    e = e.withColumn("v", F.when((F.col("event_type") == "error") | (F.col("value") > 400), None)
                     .otherwise(F.col("value")))
    return med.median(e, "v", ["event_type"], strategy="rank").select(
        "event_type", F.round("median", 4).alias("median"))


@query("median_distributed", "SELECT round(median(l_extendedprice), 4) AS median FROM lineitem")
def median_distributed(spark, sf):
    m = med.median_distributed(_t(spark, sf, "lineitem"), "l_extendedprice")
    return m.select(F.round("median", 4).alias("median"))


@query("median_rank_by_group", """
SELECT user_id, round(median(value), 4) AS median FROM events GROUP BY user_id""")
def median_rank_by_group(spark, sf):
    m = med.median_by_group(_t(spark, sf, "events"), "value", ["user_id"])
    return m.select("user_id", F.round("median", 4).alias("median"))


_TIES = """CASE WHEN l_orderkey % 7 = 0 THEN cast('NaN' AS DOUBLE) WHEN l_orderkey % 5 = 0 THEN NULL
            ELSE l_quantity END"""


@query("median_ties", f"""
SELECT l_linestatus, l_linenumber, median(v) AS median, count(v) AS n, count(*) AS rows
FROM (SELECT l_linestatus, l_linenumber, {_TIES} AS v FROM lineitem) t GROUP BY 1, 2""")
def median_ties(spark, sf):
    """A6 on heavy ties (50 values), NaN in a seventh and NULL in a fifth of the rows."""
    li = _t(spark, sf, "lineitem").select("l_linestatus", "l_linenumber", F.expr(_TIES).alias("v"))
    return med.median(li, "v", ["l_linestatus", "l_linenumber"], strategy="rank",
                      combine_aggs=[("n", "count", "v"), ("rows", "count", "*")])


@query("median_by_name", """
SELECT l_returnflag, l_linestatus, round(median(l_extendedprice), 4) AS median, count(l_extendedprice) AS n
FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def median_by_name(spark, sf):
    """The median called in SQL by its registered name, a group dealt as sorted
    pieces of bounded size."""
    from medley.functions.table_aggregates import median_pieces, register_table_aggregates
    register_table_aggregates(spark)
    pieces = median_pieces(_t(spark, sf, "lineitem"), "l_extendedprice", ["l_returnflag", "l_linestatus"])
    pieces.createOrReplaceTempView("medley_lineitem_pieces")
    return spark.sql("""
        SELECT l_returnflag, l_linestatus, round(median, 4) AS median, n
        FROM my_median(TABLE(medley_lineitem_pieces)
                         PARTITION BY (l_returnflag, l_linestatus, piece) ORDER BY l_extendedprice,
                       value => 'l_extendedprice', keys => 'l_returnflag, l_linestatus',
                       weight => 'copies', before => 'before')""")


@query("median_integer_by_group", """
SELECT p_brand, median(p_size) AS median FROM part GROUP BY p_brand""")
def median_integer_by_group(spark, sf):
    return med.median_by_group(_t(spark, sf, "part"), "p_size", ["p_brand"])


# ----------------------------------------------------------------- M: metrics

def _samples(spark, sf):
    return G.metric_samples(spark, sf)


def _report(spark, sf, basis="elapsed"):
    return mx.resource_report(_samples(spark, sf), rate_basis=basis)


@query("cpu_pct", with_samples("SELECT host, ts, seq, cpu_pct FROM report", report=True))
def cpu_pct(spark, sf):
    return mx.cpu_pct(_samples(spark, sf))


def _device_sums_sql(*cols):
    """Each device's latest good reading of a slot, summed over the host's devices."""
    sums = ", ".join(f"CAST(sum({c}) AS BIGINT) AS sum_{c}" for c in cols)
    return with_samples(f"""
SELECT host, slot, count(*) AS devices, {sums}
FROM (SELECT *, make_timestamp((epoch_us(ts) // 300000000) * 300000000) AS slot FROM samples WHERE ok
      QUALIFY row_number() OVER (PARTITION BY host, slot, device ORDER BY ts DESC, seq DESC) = 1) latest
GROUP BY 1, 2""")


@query("cpu_ticks_sum", _device_sums_sql("cpu_user", "cpu_sys", "cpu_idle", "cpu_nice"))
def cpu_ticks_sum(spark, sf):
    return mx.cpu_ticks_sum(_samples(spark, sf))


@query("mem_used_mb", with_samples("""
SELECT host, ts, seq,
       mem_total_bytes // 1048576 - ((free_pages + speculative_pages) * page_size) // 1048576 AS mem_used_mb,
       mem_total_bytes // 1048576 AS mem_total_mb
FROM samples"""))
def mem_used_mb(spark, sf):
    return mx.mem_used_mb(_samples(spark, sf))


@query("disk_sum", _device_sums_sql("disk_bytes_read", "disk_bytes_written"))
def disk_sum(spark, sf):
    return mx.disk_sum(_samples(spark, sf))


@query("disk_rate_kbps", with_samples(
    "SELECT host, ts, seq, disk_read_kbps, disk_write_kbps FROM report", report=True))
def disk_rate_kbps(spark, sf):
    return mx.disk_rate_kbps(_samples(spark, sf))


@query("disk_rate_kbps_nominal", with_samples("""
SELECT host, ts, seq,
  CASE WHEN NOT ok THEN 0 WHEN prev_ts IS NULL THEN NULL ELSE (d_read // interval_sec) // 1024 END AS disk_read_kbps,
  CASE WHEN NOT ok THEN 0 WHEN prev_ts IS NULL THEN NULL ELSE (d_written // interval_sec) // 1024 END AS disk_write_kbps
FROM deltas""", report=True))
def disk_rate_kbps_nominal(spark, sf):
    return mx.disk_rate_kbps(_samples(spark, sf), rate_basis="nominal")


@query("counter_reset_guard", with_samples("""
SELECT host, ts, seq, questions AS counter,
  CASE WHEN NOT ok THEN 0 WHEN prev_ts IS NULL THEN NULL ELSE d_questions END AS delta
FROM deltas""", report=True))
def counter_reset_guard(spark, sf):
    return mx.counter_deltas(_samples(spark, sf), "questions")


@query("queries_per_sec", with_samples(
    "SELECT host, ts, seq, db_queries_ps FROM report", report=True))
def queries_per_sec(spark, sf):
    return mx.queries_per_sec(_samples(spark, sf))


@query("connections_gauge", with_samples("""
SELECT host, ts, seq, CAST(CASE WHEN ok THEN coalesce(connections, 0) ELSE 0 END AS BIGINT) AS db_connections
FROM samples"""))
def connections_gauge(spark, sf):
    return mx.connections_gauge(_samples(spark, sf))


@query("load_avg", with_samples(
    "SELECT host, ts, seq, load1_raw / CAST(65536.0 AS DOUBLE) AS load_avg FROM samples"))
def load_avg(spark, sf):
    return mx.load_avg(_samples(spark, sf))


@query("ram_mb", with_samples("""
SELECT host, ts, seq, ((ram_total_units * mem_unit) // 1024) // 1024 AS ram_total_mb,
       ((ram_free_units * mem_unit) // 1024) // 1024 AS ram_free_mb
FROM samples"""))
def ram_mb(spark, sf):
    return mx.ram_mb(_samples(spark, sf))


_SNAPSHOT_SQL = """
, latest AS (SELECT * FROM report QUALIFY row_number() OVER (PARTITION BY host ORDER BY ts DESC, seq DESC) = 1)
, snapshot AS (
  SELECT host, 'my_resource_cpu_pct' AS Variable_name, printf('%.6f', round(coalesce(cpu_pct, 0), 6)) AS Value FROM latest
""" + "".join(f"  UNION ALL SELECT host, 'my_resource_{c}', CAST(coalesce({c}, 0) AS VARCHAR) FROM latest\n"
              for c in ("mem_used_mb", "mem_total_mb", "disk_read_kbps", "disk_write_kbps",
                        "db_connections", "db_queries_ps")) + ")"


def _with_snapshot(sql: str) -> str:
    base = with_samples("", report=True)
    return base + _SNAPSHOT_SQL + "\n" + sql


@query("status_snapshot", _with_snapshot(
    "SELECT host, Variable_name, Value FROM snapshot ORDER BY host, Variable_name"))
def status_snapshot(spark, sf):
    return mx.status_snapshot(mx.latest_report(_samples(spark, sf))).orderBy("host", "Variable_name")


@query("status_like", _with_snapshot(
    "SELECT host, Variable_name, Value FROM snapshot WHERE Variable_name LIKE 'my_resource_d%'"))
def status_like(spark, sf):
    return mx.status_like(mx.status_snapshot(mx.latest_report(_samples(spark, sf))), "my_resource_d%")


_RES_FMT = ("'my_resource: CPU=%.1f%% | MEM=%d/%dMB | DISK_R=%dKB/s DISK_W=%dKB/s"
            " | CONN=%d | QPS=%d'")
_RES_LINE_SQL = (f"printf({_RES_FMT}, round(coalesce(cpu_pct, 0.0), 1), coalesce(mem_used_mb, 0), "
                 "coalesce(mem_total_mb, 0), coalesce(disk_read_kbps, 0), "
                 "coalesce(disk_write_kbps, 0), coalesce(db_connections, 0), "
                 "coalesce(db_queries_ps, 0))")


@query("log_line_resource", with_samples(
    f"SELECT host, ts, seq, {_RES_LINE_SQL} AS line FROM report", report=True))
def log_line_resource(spark, sf):
    return logs.resource_lines(_report(spark, sf))


@query("log_line_os", with_samples("""
SELECT host, ts, seq,
  printf('[os_logger] CPU Load: %.2f, RAM: %d/%d MB', round(load1_raw / CAST(65536.0 AS DOUBLE), 2),
         ((ram_free_units * mem_unit) // 1024) // 1024, ((ram_total_units * mem_unit) // 1024) // 1024) AS line
FROM samples"""))
def log_line_os(spark, sf):
    return logs.os_lines(_samples(spark, sf))


_PAT = logs.RESOURCE_PATTERN


@query("log_parse", with_samples(f"""
SELECT host, ts, seq, line,
  TRY_CAST(regexp_extract(line, '{_PAT}', 1) AS DOUBLE) AS cpu_pct,
  TRY_CAST(regexp_extract(line, '{_PAT}', 2) AS BIGINT) AS mem_used_mb,
  TRY_CAST(regexp_extract(line, '{_PAT}', 3) AS BIGINT) AS mem_total_mb,
  TRY_CAST(regexp_extract(line, '{_PAT}', 4) AS BIGINT) AS disk_read_kbps,
  TRY_CAST(regexp_extract(line, '{_PAT}', 5) AS BIGINT) AS disk_write_kbps,
  TRY_CAST(regexp_extract(line, '{_PAT}', 6) AS BIGINT) AS db_connections,
  TRY_CAST(regexp_extract(line, '{_PAT}', 7) AS BIGINT) AS db_queries_ps
FROM (SELECT host, ts, seq, {_RES_LINE_SQL} AS line FROM report) l""", report=True))
def log_parse(spark, sf):
    return logs.parse_resource_lines(logs.resource_lines(_report(spark, sf)))


@query("log_roundtrip", with_samples(f"""
SELECT line,
  TRY_CAST(regexp_extract(line, '{_PAT}', 1) AS DOUBLE) AS cpu_pct,
  TRY_CAST(regexp_extract(line, '{_PAT}', 2) AS BIGINT) AS mem_used_mb,
  TRY_CAST(regexp_extract(line, '{_PAT}', 3) AS BIGINT) AS mem_total_mb,
  TRY_CAST(regexp_extract(line, '{_PAT}', 4) AS BIGINT) AS disk_read_kbps,
  TRY_CAST(regexp_extract(line, '{_PAT}', 5) AS BIGINT) AS disk_write_kbps,
  TRY_CAST(regexp_extract(line, '{_PAT}', 6) AS BIGINT) AS db_connections,
  TRY_CAST(regexp_extract(line, '{_PAT}', 7) AS BIGINT) AS db_queries_ps
FROM (SELECT {_RES_LINE_SQL} AS line FROM report) l""", report=True))
def log_roundtrip(spark, sf):
    """S14 + S15: resource lines written as a text log to the shared folder,
    read back and parsed."""
    from medley.session import scratch_path
    from medley.sources.logs import read_log, write_log
    folder = scratch_path(spark, "resource-log")
    write_log(logs.resource_lines(_report(spark, sf)), folder, mode="overwrite")
    parsed, _rejects = read_log(spark, folder)
    return parsed.select("line", *[n for n, _ in logs.RESOURCE_FIELDS])


@query("first_sample_baseline", with_samples(
    "SELECT * FROM report WHERE disk_read_kbps IS NOT NULL", report=True))
def first_sample_baseline(spark, sf):
    """Samples that have a rate of their own (baseline rows dropped)."""
    return mx.drop_baseline(_report(spark, sf))


@query("interval_rollup", with_samples("""
SELECT host, make_timestamp((epoch_us(ts) // 300000000) * 300000000) AS interval_start,
       count(*) AS samples, max(cpu_pct) AS max_cpu_pct, max(mem_used_mb) AS max_mem_used_mb,
       CAST(sum(disk_read_kbps) AS BIGINT) AS sum_disk_read_kbps, CAST(sum(disk_write_kbps) AS BIGINT) AS sum_disk_write_kbps,
       max(db_connections) AS max_db_connections, CAST(sum(db_queries_ps) AS BIGINT) AS sum_db_queries_ps
FROM report GROUP BY 1, 2""", report=True))
def interval_rollup(spark, sf):
    return mx.interval_rollup(_report(spark, sf))


# one row per host and interval between the host's first and last; {grid}: their starts
_RECORDS_SQL = """
, rolled AS (
  SELECT host, {start} AS interval_start, count(*) AS samples, max(cpu_pct) AS max_cpu_pct,
         max(mem_used_mb) AS max_mem_used_mb, sum(disk_read_kbps) AS r, sum(disk_write_kbps) AS w,
         max(db_connections) AS max_db_connections, sum(db_queries_ps) AS q,
         arg_max({{'m': mem_used_mb, 'c': db_connections}}, {{'t': ts, 's': seq}})
           FILTER (WHERE mem_used_mb IS NOT NULL) AS gauge
  FROM report GROUP BY 1, 2),
grid AS ({grid})
SELECT host, interval_start, {width} AS interval_sec, coalesce(samples, 0) AS samples,
  CASE WHEN samples IS NULL THEN 0.0::DOUBLE ELSE max_cpu_pct END AS max_cpu_pct,
  CASE WHEN samples IS NULL THEN known.m ELSE max_mem_used_mb END AS max_mem_used_mb,
  CAST(CASE WHEN samples IS NULL THEN 0 ELSE r END AS BIGINT) AS sum_disk_read_kbps,
  CAST(CASE WHEN samples IS NULL THEN 0 ELSE w END AS BIGINT) AS sum_disk_write_kbps,
  CASE WHEN samples IS NULL THEN coalesce(known.c, 0) ELSE max_db_connections END AS max_db_connections,
  CAST(CASE WHEN samples IS NULL THEN 0 ELSE q END AS BIGINT) AS sum_db_queries_ps
FROM (SELECT *, last_value(gauge IGNORE NULLS) OVER (PARTITION BY host ORDER BY interval_start
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS known
      FROM grid LEFT JOIN rolled USING (host, interval_start)) x"""


def _records_sql(start: str, grid: str, width: str) -> str:
    return with_samples(_RECORDS_SQL.format(start=start, grid=grid, width=width), report=True)


@query("interval_records", _records_sql(
    "make_timestamp((epoch_us(ts) // 300000000) * 300000000)",
    "SELECT host, unnest(generate_series(min(interval_start), max(interval_start), INTERVAL 300 SECOND)) "
    "AS interval_start FROM rolled GROUP BY host", "300"))
def interval_records(spark, sf):
    """A record for every interval, those without samples included."""
    from medley.operators.intervals import interval_records as records
    return records(_report(spark, sf))


# 100 seconds into the middle day the width changes from 300 to 900 seconds
_CHANGE = "(SELECT date_trunc('day', min(ts) + (max(ts) - min(ts)) / 2) + INTERVAL 100 SECOND FROM events)"


@query("interval_change", _records_sql(
    f"""CASE WHEN ts < {_CHANGE} THEN make_timestamp((epoch_us(ts) // 300000000) * 300000000)
        ELSE make_timestamp(epoch_us({_CHANGE}) + ((epoch_us(ts) - epoch_us({_CHANGE})) // 900000000) * 900000000) END""",
    f"""SELECT host, unnest(generate_series(min(interval_start), least(max(interval_start),
               {_CHANGE} - INTERVAL 1 MICROSECOND), INTERVAL 300 SECOND)) AS interval_start
        FROM rolled GROUP BY host HAVING min(interval_start) < {_CHANGE}
        UNION ALL
        SELECT host, unnest(generate_series(greatest(min(interval_start), {_CHANGE}), max(interval_start),
               INTERVAL 900 SECOND)) FROM rolled GROUP BY host""",
    f"CASE WHEN interval_start < {_CHANGE} THEN 300 ELSE 900 END"))
def interval_change(spark, sf):
    """M17 on a stream: one query, two widths, told by a parameter table."""
    from medley.session import scratch_path
    from medley.streaming import metrics_stream as ms
    settings = scratch_path(spark, "interval-settings")
    first, last = (conv.ntz_to_micros(f("ts")) for f in (F.min, F.max))
    middle = F.floor((first + last) / 2).cast("bigint")
    day = middle - F.pmod(middle, F.lit(86_400_000_000))
    (_t(spark, sf, "events").agg(conv.micros_to_ntz(day + 100_000_000).alias("effective_from"))
     .withColumn("interval_sec", F.lit(900)).write.parquet(settings))
    return ms.run_interval_records(spark, G.samples_from_events(G.events_stream(spark, sf)), 300, settings)


@query("resource_report", with_samples("SELECT * FROM report", report=True))
def resource_report(spark, sf):
    return _report(spark, sf)


# ----------------------------------------------------------------- streaming

@query("counter_delta_stream", with_samples("SELECT *, false AS late FROM report", report=True))
def counter_delta_stream(spark, sf):
    """The resource report of a stream, micro-batch by micro-batch, with each
    host's last readings as state; equal to the batch report."""
    from medley.streaming import metrics_stream as ms
    return ms.run_resource_report(spark, G.samples_from_events(G.events_stream(spark, sf)))


@query("interval_rollup_stream", QUERIES["interval_rollup"][1])
def interval_rollup_stream(spark, sf):
    """M18 on a stream, partial aggregates of each micro-batch merged: the same
    columns as the batch rollup."""
    from medley.streaming import metrics_stream as ms
    return ms.run_interval_rollup(spark, G.samples_from_events(G.events_stream(spark, sf)))


@query("interval_records_stream", QUERIES["interval_records"][1])
def interval_records_stream(spark, sf):
    """M18 on a stream, complete: partial records of each micro-batch, merged, and the
    intervals between them that had no samples."""
    from medley.streaming import metrics_stream as ms
    return ms.run_interval_records(spark, G.samples_from_events(G.events_stream(spark, sf)))


@query("counter_delta_ordered", QUERIES["resource_report"][1])
def counter_delta_ordered(spark, sf):
    """The report of a stream whose rows wait until the watermark has passed
    them and leave in order; equal to the batch report."""
    from medley.streaming import ordered_report
    return ordered_report.run_ordered_report(spark, G.samples_from_events(G.events_stream(spark, sf)))


@query("median_closing", """
SELECT * FROM (
  SELECT time_bucket(INTERVAL '1 day', ts) AS window_start,
         time_bucket(INTERVAL '1 day', ts) + INTERVAL '1 day' AS window_end,
         event_type, round(median(value), 4) AS median, count(value) AS n
  FROM events GROUP BY 1, 2, 3) w
WHERE window_end <= (SELECT make_timestamp(epoch_ms(max(ts)) * 1000) FROM events) - INTERVAL '10 minutes'""")
def median_closing(spark, sf):
    """A9 as on an endless stream: the windows that the watermark has closed."""
    from medley.session import scratch_path
    from medley.streaming import median_stream
    folder = scratch_path(spark, "median-closing")
    query_ = median_stream.start_windowed_median(
        spark, G.events_stream(spark, sf), "value", folder, ["event_type"], window="1 day",
        watermark="10 minutes", trigger={"availableNow": True})
    query_.awaitTermination()
    return median_stream.window_medians(spark, folder).withColumn("median", F.round("median", 4))


@query("median_streaming", """
SELECT time_bucket(INTERVAL '1 day', ts) AS window_start,
       time_bucket(INTERVAL '1 day', ts) + INTERVAL '1 day' AS window_end,
       event_type, round(median(value), 4) AS median, count(value) AS n
FROM events
GROUP BY 1, 2, 3""")
def median_streaming(spark, sf):
    """Exact median per event type and day over the events stream, every
    window of the bounded run included."""
    from medley.streaming import median_stream
    out = median_stream.run_windowed_median(spark, G.events_stream(spark, sf), "value",
                                            ["event_type"], window="1 day", name="median-stream")
    return out.select("window_start", "window_end", "event_type",
                      F.round("median", 4).alias("median"), "n")


__all__ = ["QUERIES", "FLAGSHIP_SQL", "flagship"]
