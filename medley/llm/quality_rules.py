"""Quality classifier: a sparse ensemble of conjunctive rules.

1. Text statistics are column expressions over the whole text.
2. Trees grown on labelled rows give rules: each path from a root to a node is a
   conjunction of comparisons of statistics.
3. A logistic regression with an L1 penalty over the rules' 0/1 values leaves
   weights on a few of them.
4. The rules with weight become one Spark column expression, so scoring is a
   projection over the statistics, at any size.

Training reads at most about ``sample`` labelled rows, chosen by a hash of the
id; scoring covers every row.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from medley.llm.common import fold_of, text_of, written

SAMPLE = 20_000
SPACE = r"[\x20\x09-\x0D]+"


def _share(pattern_out: str):
    """Share of the text's characters left after removing ``pattern_out``."""
    return lambda t: F.length(F.regexp_replace(t, pattern_out, "")) / F.greatest(F.length(t), F.lit(1))


# name -> expression over the columns ``t`` (text), ``w`` (words), ``l`` (lines)
STATISTICS = {
    "log_chars": lambda: F.log1p(F.length("t")),
    "word_chars": lambda: (F.length(F.regexp_replace("t", SPACE, ""))
                           / F.greatest(F.size("w"), F.lit(1))),
    "distinct_words": lambda: F.size(F.array_distinct("w")) / F.greatest(F.size("w"), F.lit(1)),
    "repeated_next": lambda: (F.size(F.filter(
        F.arrays_zip(F.col("w").alias("a"), F.slice("w", F.lit(2), F.greatest(
            F.size("w"), F.lit(1))).alias("b")), lambda x: x["a"] == x["b"]))
        / F.greatest(F.size("w"), F.lit(1))),
    "upper": lambda: _share(r"[^\p{Lu}]+")(F.col("t")),
    "symbols": lambda: _share(r"[^#$%&*@~^<>{}\\=+_/\[\]]+")(F.col("t")),
    "bars": lambda: _share(r"[^|]+")(F.col("t")),
    "cries": lambda: _share(r"[^!?]+")(F.col("t")),
    "stops": lambda: _share(r"[^.,;:]+")(F.col("t")),
    "digits": lambda: _share(r"[^0-9]+")(F.col("t")),
    "line_words": lambda: F.size("w") / F.greatest(F.size("l"), F.lit(1)),
    "distinct_lines": lambda: F.size(F.array_distinct("l")) / F.greatest(F.size("l"), F.lit(1)),
    "spaces": lambda: _share(r"[^\x20\x09-\x0D]+")(F.col("t")),
}
NAMES = list(STATISTICS)


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and one double per statistic; an empty text gives zeros (and NULL
    counts as empty)."""
    rows = docs.select(docs[id_col].alias("doc_id"), text_of(docs, text_col).alias("t"))
    rows = rows.withColumn("w", F.filter(F.split("t", SPACE), lambda x: x != ""))
    rows = rows.withColumn("l", F.filter(F.split("t", r"\n"), lambda x: x != ""))
    return rows.select("doc_id", *[f().cast("double").alias(n) for n, f in STATISTICS.items()])


@dataclass(frozen=True)
class Rule:
    """All of ``low < statistic <= high`` hold."""
    bounds: tuple[tuple[int, float, float], ...]

    def column(self) -> Column:
        test = F.lit(True)
        for at, low, high in self.bounds:
            if low > float("-inf"):
                test = test & (F.col(NAMES[at]) > low)
            if high < float("inf"):
                test = test & (F.col(NAMES[at]) <= high)
        return test

    def text(self) -> str:
        return " and ".join(f"{low:.6g} < {NAMES[at]} <= {high:.6g}" for at, low, high in self.bounds)


LINE = re.compile(r"^( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)")


def paths(tree_text: str) -> set[Rule]:
    """The rules of one tree, read from its printed form: one for every node
    but the root."""
    rules: set[Rule] = set()
    stack: list[tuple[int, int, str, float]] = []
    for line in tree_text.splitlines():
        m = LINE.match(line)
        if not m:
            continue
        depth = len(m[1])
        while stack and stack[-1][0] >= depth:
            stack.pop()
        stack.append((depth, int(m[2]), m[3], float(m[4])))
        bounds: dict[int, list[float]] = {}
        for _, at, op, value in stack:
            b = bounds.setdefault(at, [float("-inf"), float("inf")])
            b[0 if op == ">" else 1] = max(b[0], value) if op == ">" else min(b[1], value)
        rules.add(Rule(tuple((at, *b) for at, b in sorted(bounds.items()))))
    return rules


@dataclass(frozen=True)
class Ensemble:
    intercept: float
    weighted: tuple[tuple[float, Rule], ...]

    def score(self) -> Column:
        """Probability of label 1 as one column expression."""
        margin = F.lit(self.intercept)
        for weight, rule in self.weighted:
            margin = margin + F.when(rule.column(), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def training_sample(docs: DataFrame, labels: DataFrame, label_col: str, sample: int,
                    id_col: str, text_col: str) -> DataFrame:
    """(doc_id, y, statistics) of about ``sample`` labelled rows outside the
    held-out fold, chosen by a hash of the id. Only their statistics are made."""
    y = labels[label_col].cast("double")
    labelled = (labels.select(labels["doc_id"].alias("_id"), y.alias("y")).filter("y in (0, 1)")
                .filter(fold_of(F.col("_id")) != 0))
    share = min(1.0, sample / max(1, labelled.count()))
    chosen = labelled.filter(F.pmod(F.xxhash64("_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    rows = rows.join(F.broadcast(chosen), rows["doc_id"] == chosen["_id"])   # about ``sample`` ids
    rows = rows.select(F.struct("doc_id", "y").alias("row"), "text")
    return statistics(rows, "row", "text").select("doc_id.doc_id", "doc_id.y", *NAMES)


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", sample: int = SAMPLE,
        trees: int = 12, depth: int = 4, penalty: float = 1e-3, id_col: str = "doc_id",
        text_col: str = "text") -> Ensemble:
    """Train on rows with a 0/1 label outside the held-out fold.

    Without labelled rows every score is 1 (nothing to reject by); with one
    label only, scores are constant. Repeated label rows weigh as repeats."""
    rows = written(docs.sparkSession, training_sample(docs, labels, label_col, sample, id_col, text_col),
                   "quality-sample").coalesce(4)
    seen = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(seen) < 2:
        return Ensemble(-40.0 if set(seen) == {0.0} else 40.0, ())
    vector = rows.select("y", *NAMES, array_to_vector(F.array(*NAMES)).alias("x")).cache()
    forest = RandomForestClassifier(labelCol="y", featuresCol="x", numTrees=trees, maxDepth=depth,
                                    maxBins=32, seed=11, featureSubsetStrategy="0.5",
                                    minInstancesPerNode=5).fit(vector)
    rules = sorted(set().union(*(paths(t.toDebugString) for t in forest.trees)), key=Rule.text)
    if not rules:
        return Ensemble(40.0 if seen.get(1.0, 0) >= seen.get(0.0, 0) else -40.0, ())
    fired = vector.select("y", array_to_vector(F.array(
        *[r.column().cast("double") for r in rules])).alias("r")).cache()
    lasso = LogisticRegression(labelCol="y", featuresCol="r", elasticNetParam=1.0, regParam=penalty,
                               standardization=False, maxIter=60).fit(fired)
    vector.unpersist()
    fired.unpersist()
    weights = lasso.coefficients.toArray().tolist()
    return Ensemble(float(lasso.intercept),
                    tuple((w, r) for w, r in zip(weights, rules) if abs(w) > 1e-9))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, label_col: str = "quality",
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted for every row; neither labels nor other
    columns than the text enter a score. Empty table: no rows."""
    score = fit(docs, labels, label_col, id_col=id_col, text_col=text_col).score()
    return (statistics(docs, id_col, text_col)
            .select("doc_id", (fold_of(F.col("doc_id")) == 0).alias("held_out"), score.alias("score"))
            .withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0)))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, label_col: str = "quality",
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, columns unchanged."""
    score = fit(docs, labels, label_col, id_col=id_col, text_col=text_col).score()
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"),
                       docs[text_col].alias("text"))
    return statistics(rows, "row", "text").filter(score >= threshold).select("doc_id.*")


__all__ = ["STATISTICS", "statistics", "Rule", "Ensemble", "paths", "fit", "classify", "keep_good"]
