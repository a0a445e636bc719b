"""Secret scanning with an incremental ledger of blobs.

A blob is a text named by its SHA-256. The ledger keeps, under one folder, the
(blob, rule, version) pairs that were scanned and the findings. A scan hashes
every historical version (row), anti-joins the ledger, reads each unseen blob
once, runs only the rules it has not met, appends findings and then pairs, and
finally joins the findings to every path that holds the blob.

Everything is built-in column functions: a rule's matches come from
``regexp_extract_all`` and the gaps between them from ``split`` with the same
pattern, so positions are running sums of lengths.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from medley.llm.common import sent_if_small, text_of, written
from medley.session import scratch_path


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose ``group`` has ``least`` characters or more."""
    kind: str
    pattern: str
    group: int
    least: int
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# The three base rules, in the order of their kinds.
BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
                   r"""([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]{16,}", 0, 16),
)
# Added by this library: key file headers and signed web tokens.
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----", 0, 1),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1),
)
RULES = BASE_RULES + MORE_RULES

PAIRS = T.StructType([T.StructField("digest", T.StringType()), T.StructField("rule", T.StringType())])
FINDINGS = T.StructType([
    T.StructField("digest", T.StringType()), T.StructField("rule", T.StringType()),
    T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])


class Ledger:
    """Scanned (blob, rule@version) pairs and findings under one shared folder."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark = spark
        self.path = (path or scratch_path(spark, "secret-ledger")).rstrip("/")

    def _read(self, name: str, schema: T.StructType) -> DataFrame:
        p = f"{self.path}/{name}"
        jvm = self.spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(p)
        fs = at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(at):
            return self.spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name)
                                                for f in schema])
        return self.spark.read.schema(schema).parquet(p)

    def pairs(self) -> DataFrame:
        return self._read("pairs", PAIRS)

    def findings(self) -> DataFrame:
        """Distinct: a batch that failed between its two writes is scanned again."""
        return self._read("findings", FINDINGS).distinct()

    def append(self, findings: DataFrame, pairs: DataFrame) -> None:
        """Findings first; the pairs are what marks a blob as done."""
        findings.write.mode("append").parquet(f"{self.path}/findings")
        pairs.write.mode("append").parquet(f"{self.path}/pairs")


def _hits(rule: Rule):
    """array<struct<rule, i, gap, len, ok>> of the rule's matches in ``text``."""
    text, pattern = F.col("text"), F.lit(rule.pattern)
    match = F.regexp_extract_all(text, pattern, F.lit(0))
    kept = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else match
    gaps = F.split(text, rule.pattern, -1)
    rows = F.transform(
        F.arrays_zip(match.alias("m"), kept.alias("k"), gaps.alias("g")),
        lambda x, i: F.struct(F.lit(rule.key).alias("rule"), i.alias("i"),
                              F.length(x["g"]).cast("long").alias("gap"),
                              F.length(x["m"]).cast("long").alias("len"),
                              (F.length(x["k"]) >= rule.least).alias("ok")))
    none = F.array().cast("array<struct<rule:string,i:int,gap:bigint,len:bigint,ok:boolean>>")
    todo = F.array_contains("unseen", rule.key) & text.rlike(rule.pattern)
    return F.when(todo, F.filter(rows, lambda r: r["len"].isNotNull())).otherwise(none)


def scan(docs: DataFrame, ledger: Ledger, rules=RULES, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """(digest, rule, start, end) of all blobs of ``docs``, scanning only the
    (blob, rule version) pairs the ledger lacks and recording them there.

    Positions are code points, end exclusive. NULL text is the empty blob;
    NULL or repeated ids are fine (an id only names which row to read)."""
    blobs = docs.select(F.coalesce(docs[id_col].cast("string"), F.lit("\0")).alias("row"),
                        text_of(docs, text_col).alias("text"))
    blobs = blobs.withColumn("digest", F.sha2("text", 256))
    keys = [r.key for r in rules]
    seen = (ledger.pairs().groupBy("digest").agg(F.collect_set("rule").alias("seen")))
    unseen = (blobs.groupBy("digest").agg(F.min("row").alias("row"))
              .join(seen, "digest", "left")
              .withColumn("unseen", F.array_except(
                  F.array(*[F.lit(k) for k in keys]),
                  F.coalesce("seen", F.array().cast("array<string>"))))
              .filter(F.size("unseen") > 0).select("digest", "row", "unseen"))
    todo = blobs.join(unseen.hint("shuffle_hash"), ["digest", "row"])
    hits = todo.select("digest", F.explode(F.concat(*[_hits(r) for r in rules])).alias("h"))
    along = Window.partitionBy("digest", "rule").orderBy("i")
    found = (hits.select("digest", "h.*").distinct()
             .withColumn("end", F.sum(F.col("gap") + F.col("len")).over(along))
             .filter("ok").select("digest", "rule", (F.col("end") - F.col("len")).alias("start"), "end"))
    ledger.append(found, unseen.select("digest", F.explode("unseen").alias("rule")))
    return ledger.findings().filter(F.col("rule").isin(keys))


def spans_by_path(docs: DataFrame, findings: DataFrame, rules=RULES, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """Findings joined back to every row: ``doc_id``, ``digest`` and ``spans``, an
    array of (start, rank, kind, end) by start, then kind as listed."""
    rank = F.create_map(*[F.lit(v) for i, r in enumerate(rules) for v in (r.key, i)])
    per_blob = (findings.select("digest", F.struct(
        "start", rank[F.col("rule")].alias("rank"),
        F.substring_index("rule", "@", 1).alias("kind"), "end").alias("s"))
        .groupBy("digest").agg(F.array_sort(F.collect_list("s")).alias("spans")))
    # read back, so that the join shuffles both sides and a blob on many paths can be split
    per_blob = written(docs.sparkSession, per_blob, "blob-findings")
    paths = docs.select(docs[id_col].alias("doc_id"),
                        F.sha2(text_of(docs, text_col), 256).alias("digest"))
    empty = F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint>>")
    return (paths.join(per_blob, "digest", "left")
            .select("doc_id", "digest", F.coalesce("spans", empty).alias("spans")))


def _joined(spans):
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def secret_report(docs: DataFrame, ledger: Ledger | None = None, rules=RULES,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans for every row."""
    ledger = ledger or Ledger(docs.sparkSession)
    rows = spans_by_path(docs, scan(docs, ledger, rules, id_col, text_col), rules, id_col, text_col)
    base = F.filter("spans", lambda s: s["kind"].isin([r.kind for r in BASE_RULES]))

    def n(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return rows.select("doc_id", *[n(r.kind) for r in BASE_RULES],
                       F.sha2(_joined(base), 256).alias("base_sha256"),
                       _joined(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, rules=RULES, mark: str = "[SECRET]", ledger: Ledger | None = None,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with each finding replaced by ``mark``, all columns and rows kept
    (``n_chars``, if there, follows the new text). Texts without findings stay
    as they are, NULL ones too. Overlapping findings become one mark."""
    ledger = ledger or Ledger(docs.sparkSession)
    found = scan(docs, ledger, rules, id_col, text_col)
    per_blob = written(docs.sparkSession, found.groupBy(F.col("digest").alias("_digest")).agg(
        F.array_sort(F.collect_set(F.struct("start", "end"))).alias("_spans")), "blob-findings")
    # few blobs hold a secret: while their spans are small, documents stay where they are
    hit = (docs.withColumn("_digest", F.sha2(text_of(docs, text_col), 256))
           .join(sent_if_small(per_blob), "_digest", "left"))
    text = F.col(text_col)
    # walk the spans in order, keeping the text between the furthest end so far and each start
    zero = F.lit(0).cast("long")
    walked = F.aggregate(
        "_spans", F.struct(zero.alias("at"), F.array().cast("array<string>").alias("out")),
        lambda s, x: F.when(x["start"] >= s["at"], F.struct(
            x["end"].alias("at"),
            F.concat(s["out"], F.array(text.substr((s["at"] + 1).cast("int"),
                                                   (x["start"] - s["at"]).cast("int")),
                                       F.lit(mark))).alias("out")))
        .otherwise(F.struct(F.greatest(s["at"], x["end"]).alias("at"), s["out"].alias("out"))),
        lambda s: F.concat(F.array_join(s["out"], ""), text.substr((s["at"] + 1).cast("int"),
                                                                   F.length(text))))
    out = hit.withColumn(text_col, F.when(F.col("_spans").isNotNull(), walked).otherwise(text))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(
            F.col("_spans").isNotNull(), F.length(text_col).cast(docs.schema["n_chars"].dataType))
            .otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


__all__ = ["Rule", "BASE_RULES", "MORE_RULES", "RULES", "Ledger", "scan", "spans_by_path",
           "secret_report", "redact"]
