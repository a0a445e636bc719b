"""Hard negatives by Fagin's threshold algorithm.

Anchors meet the candidate rows in blocks: groups of at most ``ANCHORS`` anchors
with blocks of about ``BLOCK`` rows, as co-groups of one shuffle, so that neither a
label nor a vector that many rows share gathers in one task. Inside a block every
dimension has its list of candidates sorted by that component. An anchor reads each
list from the end its own component's sign asks for (sorted access), scores each row
when first met (random access, exact integers), and keeps the best ``k`` rows of each
score window. The threshold, the score of a row made of the last component read in
each list, bounds all rows not met; reading stops once it is strictly below each
window's k-th score or its lower end (strictly, as ties go by id). The few rows a
block gives for a window are merged by score and id.

Positives are the search among the anchor's own label; they name the score windows
of the second search, among the other labels.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from medley.llm.common import written

BLOCK = 8192            # candidate rows whose sorted lists are held at once
ANCHORS = 2048          # anchors that meet a block in one group
FIRST = 32              # rows read of each list in the first round
LARGEST = 1 << 22       # scaled components are held within this


def integer_vectors(rows: DataFrame, scale: int = 256, id_col: str = "vec_id",
                    vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(uid, vec_id, label, q): components as floor(scale * x), x as double.

    Rows with a NULL id, label or vector, or a NULL or non-finite component, are
    left out. ``uid`` tells repeated rows apart."""
    vec = rows[vec_col].cast("array<double>")
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    limit = float(LARGEST)
    return (rows.select(F.monotonically_increasing_id().alias("uid"),
                        rows[id_col].cast("long").alias("vec_id"),
                        rows[label_col].cast("long").alias("label"), vec.alias("v"), bad.alias("bad"))
            .filter("vec_id is not null and label is not null and v is not null and not bad")
            .select("uid", "vec_id", "label", F.transform("v", lambda x: F.floor(F.greatest(
                F.least(x * scale, F.lit(limit)), F.lit(-limit))).cast("int")).alias("q")))


def matrix(lists: pa.ChunkedArray) -> np.ndarray:
    """Rows of int64; shorter vectors are filled up with zeros."""
    column = lists.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], lists.type)
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    wide = int(sizes.max(initial=0))
    if len(sizes) and (sizes == wide).all():
        return flat.reshape(len(sizes), wide)
    out = np.zeros((len(sizes), wide), np.int64)
    out[np.arange(wide) < sizes[:, None]] = flat
    return out


class Lists:
    """A block of candidates with the sorted list of each dimension."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray):
        self.ids = ids
        self.n, self.d = vectors.shape
        up = np.argsort(vectors, axis=0, kind="stable").T.astype(np.int32)
        values = np.take_along_axis(vectors.T, up, axis=1)
        # [sign]: 0 reads from the largest component down, 1 from the smallest up
        self.order = np.stack([up[:, ::-1], up])
        self.values = np.stack([values[:, ::-1], values])
        self.most = int(np.abs(vectors).max(initial=0))
        self.raw = vectors
        self.typed: dict = {}

    def _scored(self, anchor: np.ndarray):
        """(vectors, anchor) in the cheapest type that is exact for this anchor."""
        bound = self.most * int(np.abs(anchor).sum())
        kind = np.float32 if bound < 2**24 else np.float64 if bound < 2**53 else np.int64
        if kind not in self.typed:
            self.typed[kind] = self.raw.astype(kind)
        return self.typed[kind], anchor.astype(kind)

    def search(self, anchor: np.ndarray, allowed: np.ndarray, windows, k: int):
        """For each (low, high) of ``windows`` the rows of score low..high that come
        first by (score descending, id), ``k`` at most, as (positions, scores)."""
        anchor = np.pad(anchor, (0, max(0, self.d - len(anchor))))[:self.d]
        dims = np.flatnonzero(anchor)
        signs = (anchor[dims] < 0).astype(np.intp)
        weights = anchor[dims]
        vectors, typed = self._scored(anchor)
        best = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in windows]
        unseen = allowed.copy()
        at, upto = 0, FIRST
        while True:
            # without a component to read by, every row ties: all are met at once
            upto = min(upto, self.n) if len(dims) else self.n
            met = np.zeros(self.n, bool)
            if len(dims):
                met[self.order[signs, dims, at:upto].ravel()] = True
            else:
                met[:] = True
            new = np.flatnonzero(met & unseen)
            unseen[new] = False
            scores = (vectors[new] @ typed).astype(np.int64)
            limit = int(weights @ self.values[signs, dims, upto - 1]) if len(dims) and self.n else 0
            done = upto >= self.n
            open_windows = False
            for w, (low, high) in enumerate(windows):
                kept, kept_scores = best[w]
                floor = low if len(kept) < k else max(low, int(kept_scores[-1]))
                take = np.flatnonzero((scores >= floor) & (scores <= high))
                if len(take):
                    kept = np.concatenate([kept, new[take]])
                    kept_scores = np.concatenate([kept_scores, scores[take]])
                    first = np.lexsort((self.ids[kept], -kept_scores))[:k]
                    best[w] = kept, kept_scores = kept[first], kept_scores[first]
                kth = int(kept_scores[-1]) if len(kept) == k else low
                open_windows |= limit >= max(kth, low)
            if done or not open_windows:
                return best
            at, upto = upto, upto + max(FIRST, upto // 2)


MET = "uid long, slot int, vec_id long, score long"


def _meet(anchors: DataFrame, rows: DataFrame, keys: list[str], k: int, same_label: bool) -> DataFrame:
    """Co-groups of anchors and candidates, searched block by block."""

    def block(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if left.num_rows and right.num_rows:
            lists = Lists(matrix(right.column("q")), right.column("vec_id").to_numpy())
            uids, labels = right.column("uid").to_numpy(), right.column("label").to_numpy()
            found = zip(left.column("uid").to_pylist(), left.column("label").to_pylist(),
                        matrix(left.column("q")), left.column("windows").to_pylist())
            for uid, label, vector, windows in found:
                allowed = uids != uid if same_label else labels != label
                best = lists.search(vector, allowed, [(x["low"], x["high"]) for x in windows], k)
                for x, (places, scores) in zip(windows, best):
                    out += [(uid, x["slot"], int(i), int(s)) for i, s in zip(lists.ids[places], scores)]
        cols = list(zip(*out)) if out else [()] * 4
        return pa.table([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(),
                                                               pa.int64()))],
                        names=["uid", "slot", "vec_id", "score"])

    # both sides come from one table: new names keep their columns apart
    left, right = anchors.toDF(*anchors.columns), rows.toDF(*rows.columns)
    met = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(block, MET)
    order = Window.partitionBy("uid", "slot").orderBy(F.desc("score"), "vec_id")
    return met.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _dealt(df: DataFrame, own: str, parts, other: str, times) -> DataFrame:
    """Rows in ``parts`` parts by their uid, each present for all ``times`` of the other side."""
    return (df.withColumn(own, F.pmod(F.xxhash64("uid"), parts))
            .withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), times - 1))))


def positives(rows: DataFrame, anchors: DataFrame, k: int = 5) -> DataFrame:
    """(uid, rank, vec_id, score): each anchor's ``k`` best other rows of its label
    (all, if fewer), by score and then smaller id.

    A label's rows are cut into blocks of about ``BLOCK`` by their uid, however many
    rows it has; its anchors likewise."""
    sizes = (rows.groupBy("label").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
             .join(anchors.groupBy("label").agg(F.ceil(F.count("*") / ANCHORS).alias("groups")), "label"))
    low, high = -2**62, 2**62
    left = anchors.join(sizes, "label").withColumn("windows", F.array(F.struct(
        F.lit(0).alias("slot"), F.lit(low).alias("low"), F.lit(high).alias("high"))))
    left = _dealt(left, "g", F.col("groups"), "b", F.col("blocks"))
    right = _dealt(rows.join(sizes, "label"), "b", F.col("blocks"), "g", F.col("groups"))
    return (_meet(left, right, ["label", "g", "b"], k, True)
            .select("uid", "rank", "vec_id", "score"))


def mine(rows: DataFrame, every: int = 50, n_positives: int = 5, n_negatives: int = 3,
         low_percent: int = 50, high_percent: int = 95, scale: int = 256, id_col: str = "vec_id",
         vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are rows whose id is divisible by ``every``. For each of an anchor's
    first ``n_positives`` rows of its label: the first ``n_negatives`` rows of other
    labels whose score is from low to high percent of the positive's. A positive of
    negative score has no window. Vectors of unlike length are compared as if filled
    up with zeros; scaled components beyond 2^22 are held there, so that scores of up
    to 1024 dimensions, times 100, fit a long. Repeated rows are rows of their own: as anchors,
    positives and negatives each. An empty table, or one without anchors, gives no rows."""
    spark = rows.sparkSession
    vectors = written(spark, integer_vectors(rows, scale, id_col, vec_col, label_col), "vectors")
    anchors = vectors.filter(F.col("vec_id") % every == 0)
    found = written(spark, positives(vectors, anchors, n_positives), "positives")

    windows = (found.filter("score >= 0")
               .withColumn("low", F.expr(f"(score * {low_percent} + 99) div 100"))
               .withColumn("high", F.expr(f"(score * {high_percent}) div 100"))
               .groupBy("uid").agg(F.collect_list(F.struct(
                   F.col("rank").alias("slot"), "low", "high")).alias("windows")))
    total, n_anchors = vectors.count(), anchors.count()
    blocks, groups = (F.lit(max(1, -(-n // size))).cast("long")
                      for n, size in ((total, BLOCK), (n_anchors, ANCHORS)))
    left = _dealt(anchors.join(windows, "uid"), "g", groups, "b", blocks)
    right = _dealt(vectors, "b", blocks, "g", groups)
    negatives = _meet(left, right, ["g", "b"], n_negatives, False)
    ids = anchors.select("uid", F.col("vec_id").alias("anchor_id"))
    named = (found.join(ids, "uid")
             .select("uid", F.col("rank").alias("slot"), "anchor_id", F.col("vec_id").alias("positive_id"),
                     F.col("score").alias("positive_score")))
    return (negatives.join(named, ["uid", "slot"])
            .select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"),
                    "positive_score", F.col("score").alias("negative_score")))


def noisy_labels(rows: DataFrame, divisor: int = 7, labels: int = 10, id_col: str = "vec_id",
                 label_col: str = "label") -> DataFrame:
    """``rows`` with the label of each id divisible by ``divisor`` moved on by one."""
    moved = F.col(id_col) % divisor == 0
    return rows.withColumn(label_col, F.when(moved, (F.col(label_col).cast("long") + 1) % labels)
                           .otherwise(F.col(label_col)))


__all__ = ["Lists", "integer_vectors", "positives", "mine", "noisy_labels"]
