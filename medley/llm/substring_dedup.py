"""Exact substring dedup: words inside repeated 35-word windows are removed.

1. Anchors. Every window of ``WINDOW`` words is owned by one of its
   ``SHINGLE``-word shingles, the one of least hash (leftmost on ties), so equal
   windows are owned by equal anchors. Consecutive windows with one owner form a
   span. Spans whose anchor occurs once in the corpus hold no repeated window.
   If all spans of an anchor are alike, all their windows repeat.
2. Reference shards. The distinct spans of each other anchor form a shard, with
   how often each occurs. A suffix automaton of the shard knows each substring's
   number of occurrences; spans streamed through it get the match statistics of
   every window: its state, hence its count. As a window occurrence lies in
   exactly one span, these counts are the corpus counts.
   The automata go to the spans by anchor in a shuffle rather than by broadcast:
   all of them together grow with the corpus, a shard does not. A shard of more
   than ``SHARD`` distinct spans (a common passage in ever new surroundings) is
   counted by window instead, so that no task holds a hot anchor's spans.
3. Each text gets its spans' verdicts and drops the covered words.

Texts move once to meet their spans, those with undecided spans once more.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from medley.llm.common import text_of, written
from medley.llm.word_hashes import MIX, mixed, powers, word_hashes

WINDOW = 35
SHINGLE = 8
SHARD = 512
POS_BITS = 21
CHUNK = 1 << 19         # words handled at once
ROWS = 512              # texts handled at once
REMEMBERED = 50_000     # texts with references that a task remembers
P1, P2 = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


def codes(text: str) -> np.ndarray:
    """A 64-bit hash per word."""
    return word_hashes(pa.array([text], pa.string()))[0]


def range_hashes(c: np.ndarray, start: np.ndarray, end: np.ndarray, p: int) -> np.ndarray:
    """Hash of c[start:end] for many ranges, from one prefix sum."""
    up, back = powers(len(c) + 1, p), powers(len(c) + 1, pow(p, -1, 2**64))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mixed(c) * up[:-1])])
    return mixed((sums[end] - sums[start]) * back[start] + (end - start).astype(np.uint64))


def spans(c: np.ndarray, owner: np.ndarray, window: int = WINDOW, shingle: int = SHINGLE):
    """Spans of concatenated texts (``owner``: text of each word): first window,
    number of windows, anchor, digest of the span's words."""
    n = len(c) - window + 1
    if n <= 0:
        e = np.empty(0, np.int64)
        return e, e, e.astype(np.uint64), e.astype(np.uint64)
    with np.errstate(over="ignore"):
        m = len(c) - shingle + 1
        h = np.zeros(m, np.uint64)
        for j in range(shingle):
            h = h * MIX + c[j:j + m]
        h = mixed(h)
        low = np.uint64((1 << POS_BITS) - 1)
        least = (h & ~low) | np.arange(m, dtype=np.uint64)
        width, want = 1, window - shingle + 1
        while 2 * width <= want:                     # minima over 2, 4, 8, ... shingles
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < want:
            least = np.minimum(least[:len(least) - (want - width)], least[want - width:])
        at = (least & low).astype(np.int64)[:n]
        valid = owner[:n] == owner[window - 1:]
        new = np.ones(n, bool)
        new[1:] = (at[1:] != at[:-1]) | ~valid[:-1]
        first = np.flatnonzero(new & valid)
        last = np.flatnonzero(valid & np.concatenate([new[1:] | ~valid[1:], [True]]))
        digest = range_hashes(c, first, last + window, P2)
        digest = mixed(digest + (at[first] - first).astype(np.uint64))
    return first, last - first + 1, h[at[first]], digest


SPANS = "k1 long, k2 long, a int, w int, anchor long, digest long"


def _span_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows(keys, words, counts, base):
        """Spans of a few whole texts, or of one piece of a text from word ``base``."""
        owner = np.repeat(np.arange(len(counts)), counts)
        starts = np.concatenate([[0], np.cumsum(counts)])
        first, w, anchor, digest = spans(words, owner)
        o = owner[first] if len(first) else first
        return pa.RecordBatch.from_arrays([
            pa.array(keys[0][o]), pa.array(keys[1][o]),
            pa.array((first - starts[o] + base).astype(np.int32)), pa.array(w.astype(np.int32)),
            pa.array(anchor.view(np.int64)), pa.array(digest.view(np.int64))],
            names=["k1", "k2", "a", "w", "anchor", "digest"])

    for whole in batches:
        for at in range(0, whole.num_rows, ROWS):
            batch = whole.slice(at, ROWS)
            words, counts = word_hashes(batch.column(2))
            keys = [np.array(batch.column(k)) for k in (0, 1)]
            ends = np.cumsum(counts)
            i = 0
            while i < len(counts):
                lo = int(ends[i] - counts[i])
                j = max(i + 1, int(np.searchsorted(ends, lo + CHUNK, side="right")))
                own = [k[i:j] for k in keys]
                if j == i + 1 and counts[i] > CHUNK:  # a text of many pieces, which overlap
                    for p in range(0, int(counts[i]) - WINDOW + 1, CHUNK):
                        piece = words[lo + p:min(lo + p + CHUNK + WINDOW - 1, int(ends[i]))]
                        yield rows(own, piece, np.array([len(piece)]), p)
                else:
                    yield rows(own, words[lo:int(ends[j - 1])], counts[i:j], 0)
                i = j


class SuffixAutomaton:
    """Suffix automaton of several sequences with occurrence counts."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length, self.count = [-1], [0], [0]

    def _state(self, length, link, arcs, count) -> int:
        self.next.append(arcs)
        self.link.append(link)
        self.length.append(length)
        self.count.append(count)
        return len(self.next) - 1

    def _split(self, p: int, q: int, symbol) -> int:
        """A copy of q for the shorter substrings that end in it by ``symbol``."""
        nxt = self.next
        copy = self._state(self.length[p] + 1, self.link[q], dict(nxt[q]), 0)
        while p >= 0 and nxt[p].get(symbol) == q:
            nxt[p][symbol] = copy
            p = self.link[p]
        self.link[q] = copy
        return copy

    def add(self, sequence, times: int) -> None:
        nxt, link, length = self.next, self.link, self.length
        last = 0
        for symbol in sequence:
            q = nxt[last].get(symbol)
            if q is not None:                        # known already: step, splitting if need be
                last = q if length[q] == length[last] + 1 else self._split(last, q, symbol)
            else:
                new = self._state(length[last] + 1, 0, {}, 0)
                p = last
                while p >= 0 and symbol not in nxt[p]:
                    nxt[p][symbol] = new
                    p = link[p]
                if p >= 0:
                    q = nxt[p][symbol]
                    link[new] = q if length[q] == length[p] + 1 else self._split(p, q, symbol)
                last = new
            self.count[last] += times

    def finish(self) -> None:
        """Sum counts along suffix links, longest first."""
        for s in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            if self.link[s] > 0:
                self.count[self.link[s]] += self.count[s]

    def windows(self, sequence, width: int) -> list[int]:
        """Occurrences of each window of ``sequence`` (0 where it does not occur)."""
        nxt, link, length = self.next, self.link, self.length
        state, matched, out = 0, 0, []
        for k, symbol in enumerate(sequence):
            while state and symbol not in nxt[state]:
                state = link[state]
                matched = length[state]
            if symbol in nxt[state]:
                state, matched = nxt[state][symbol], matched + 1
            while state and length[link[state]] >= width:
                state = link[state]
                matched = length[state]
            if k >= width - 1:
                out.append(self.count[state] if matched >= width else 0)
        return out


VERDICTS = "anchor long, digest long, bits binary"


def _verdicts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one anchor after another -> which windows of each span repeat."""
    def judged(group):
        automaton = SuffixAutomaton()
        sequences = [np.frombuffer(raw, np.uint64).tolist() for _, raw in group.values()]
        for s, (times, _) in zip(sequences, group.values()):
            automaton.add(s, times)
        automaton.finish()
        return [(digest, np.packbits([x > 1 for x in automaton.windows(s, WINDOW)]).tobytes())
                for s, digest in zip(sequences, group)]

    anchor, group, out = None, {}, []

    def flush():
        batch = pa.RecordBatch.from_arrays(
            [pa.array([x[k] for x in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.binary()))],
            names=["anchor", "digest", "bits"])
        out.clear()
        return batch

    for batch in batches:
        for key, digest, times, raw in zip(*(col.to_pylist() for col in batch.columns)):
            if key != anchor:
                out += [(anchor, *x) for x in judged(group)]
                anchor, group = key, {}
                if len(out) > 10_000:
                    yield flush()
            group[digest] = times, raw
    out += [(anchor, *x) for x in judged(group)]
    yield flush()


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of hot anchors -> one row a window, with a 128-bit digest."""
    with np.errstate(over="ignore"):
        for batch in batches:
            for anchor, digest, times, raw in zip(*(col.to_pylist() for col in batch.columns)):
                c = np.frombuffer(raw, np.uint64)
                n = len(c) - WINDOW + 1
                s = np.arange(n)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(n, anchor)), pa.array(np.full(n, digest)),
                    pa.array(np.full(n, times)), pa.array(s.astype(np.int32)),
                    pa.array(range_hashes(c, s, s + WINDOW, P1).view(np.int64)),
                    pa.array(range_hashes(c, s, s + WINDOW, P2).view(np.int64))],
                    names=["anchor", "digest", "n", "i", "h1", "h2"])


def kept(text: str, found: list[tuple[int, int, bytes | None]]):
    """(n_words, n_removed, SHA-256 of the kept words, kept text); ``found``: spans
    as (first window, windows, bits of repeated windows or None for all)."""
    words = text.encode().split()
    edge = np.zeros(len(words) + 1, np.int64)
    for a, w, bits in found:
        hit = np.arange(w) if bits is None else np.flatnonzero(
            np.unpackbits(np.frombuffer(bits, np.uint8), count=w))
        np.add.at(edge, a + hit, 1)
        np.add.at(edge, a + hit + WINDOW, -1)
    keep = np.cumsum(edge)[:-1] == 0
    left = b" ".join(words) if keep.all() else b" ".join(
        w for w, k in zip(words, keep.tolist()) if k)
    return len(words), int(len(words) - keep.sum()), hashlib.sha256(left).hexdigest(), left


SPAN = "struct<a:int,w:int,anchor:bigint,digest:bigint,mixed:boolean,n:bigint>"
MET = ("kind int, doc_id long, k1 long, k2 long, n_words long, n_removed long, kept_sha256 string, "
       f"text string, found array<{SPAN}>, anchor long, digest long, n long, codes binary")
RESULT, PENDING, REFERENCE = 0, 1, 2
SPAN_ARROW = pa.list_(pa.struct([("a", pa.int32()), ("w", pa.int32()), ("anchor", pa.int64()),
                                 ("digest", pa.int64()), ("mixed", pa.bool_()), ("n", pa.int64())]))
MET_ARROW = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(),
             pa.string(), SPAN_ARROW, pa.int64(), pa.int64(), pa.int64(), pa.binary())


def _meet(keep_text: bool):
    """Texts with their spans -> results, undecided texts, reference spans."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in MET.replace(f"array<{SPAN}>", "x").split(", ")]
        told = set()                  # texts whose references are out: rows alike give them once
        for whole in batches:
            if len(told) > REMEMBERED:
                told.clear()          # a reference that comes twice only costs time
            for at in range(0, whole.num_rows, 256):
                rows = []
                for doc_id, k1, k2, text, found in zip(*(
                        c.to_pylist() for c in whole.slice(at, 256).columns)):
                    found = found or []
                    if any(x["n"] for x in found) and (k1, k2) not in told:
                        told.add((k1, k2))
                        c = codes(text)
                        rows += [(REFERENCE, None, None, None, None, None, None, None, None, x["anchor"],
                                  x["digest"], x["n"], c[x["a"]:x["a"] + x["w"] + WINDOW - 1].tobytes())
                                 for x in found if x["n"]]
                    own = [x for x in found if not x["n"]]
                    if any(x["mixed"] for x in own):
                        rows.append((PENDING, doc_id, k1, k2, None, None, None, text, own) + (None,) * 4)
                    else:
                        n, gone, sha, left = kept(text, [(x["a"], x["w"], None) for x in own])
                        rows.append((RESULT, doc_id, k1, k2, n, gone, sha,
                                     left.decode() if keep_text else None, None) + (None,) * 4)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(list(zip(*rows)) if rows else [()] * 13, MET_ARROW)],
                    names=names)
    return run


OUT = "doc_id long, n_words long, n_removed long, kept_sha256 string, text string"


def _settle(keep_text: bool):
    """Undecided texts with their spans and verdicts -> results."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text, own, told in zip(*(c.to_pylist() for c in batch.columns)):
                bits = {(x["anchor"], x["digest"]): x["bits"] for x in told or []}
                found = [(x["a"], x["w"], bits[x["anchor"], x["digest"]] if x["mixed"] else None)
                         for x in own]
                n, gone, sha, left = kept(text, found)
                rows.append((doc_id, n, gone, sha, left.decode() if keep_text else None))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(list(zip(*rows)) if rows else [()] * 5,
                 (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()))],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "text"])
    return run


def dedup(docs: DataFrame, keep_text: bool = False, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (and, with ``keep_text``, the kept
    words as ``text``) for every row.

    NULL, empty and short texts lose nothing. Rows alike in id and text are
    separate occurrences, so their windows repeat. Empty table: no rows."""
    spark = docs.sparkSession
    text = text_of(docs, text_col)
    texts = docs.select(docs[id_col].cast("long").alias("doc_id"), text.alias("text"),
                        F.xxhash64(docs[id_col], text).alias("k1"),
                        F.xxhash64(text, F.lit("second"), docs[id_col]).alias("k2"))
    all_spans = written(spark, texts.select("k1", "k2", "text").mapInArrow(_span_rows, SPANS), "spans")
    # read back, so that the join shuffles both sides and a hot anchor can be split
    repeated = written(spark, all_spans.groupBy("anchor")
                       .agg(F.count("*").alias("n"), F.min("digest").alias("lo"), F.max("digest").alias("hi"))
                       .filter("n > 1").select("anchor", (F.col("lo") != F.col("hi")).alias("mixed")),
                       "repeated-anchors")
    found = written(spark, all_spans.join(repeated, "anchor"), "repeated-spans")
    kinds = (found.filter("mixed").groupBy("anchor", "digest")
             .agg(F.count("*").alias("n"), F.min(F.struct("k1", "k2", "a", "w")).alias("at")))
    no = F.lit(None).cast("long")
    items = (found.select("k1", "k2", "a", "w", "anchor", "digest", "mixed", no.alias("n"))
             .unionByName(kinds.select("at.k1", "at.k2", "at.a", "at.w", "anchor", "digest",
                                       F.lit(True).alias("mixed"), "n")))
    # a set: rows alike in id and text have the same spans, which then count once
    per_text = items.groupBy("k1", "k2").agg(F.collect_set(
        F.struct("a", "w", "anchor", "digest", "mixed", "n")).alias("found"))
    met = (texts.join(per_text.hint("shuffle_hash"), ["k1", "k2"], "left")
           .select("doc_id", "k1", "k2", "text", "found").mapInArrow(_meet(keep_text), MET))
    met = written(spark, met, "met-texts")

    references = met.filter(F.col("kind") == REFERENCE).select("anchor", "digest", "n", "codes")
    size = written(spark, references.groupBy("anchor").agg((F.count("*") > SHARD).alias("hot")), "shard-sizes")
    references = references.join(size, "anchor")
    cold = references.filter(~F.col("hot")).drop("hot")
    told = (cold.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_verdicts, VERDICTS)
            .filter("anchor is not null"))
    single = written(spark, references.filter("hot").drop("hot").mapInArrow(
        _windows, "anchor long, digest long, n long, i int, h1 long, h2 long"), "hot-windows")
    twice = single.groupBy("anchor", "h1", "h2").agg(F.sum("n").alias("times"))
    flags = (single.join(twice, ["anchor", "h1", "h2"])
             .groupBy("anchor", "digest").agg(F.array_sort(F.collect_list(
                 F.struct("i", (F.col("times") > 1).alias("hit")))).alias("f")))
    hot = flags.mapInArrow(_packed, VERDICTS)
    told = written(spark, told.unionByName(hot), "span-verdicts")

    pending = met.filter(F.col("kind") == PENDING)
    verdicts = (pending.select("k1", "k2", F.explode("found").alias("s")).filter("s.mixed")
                .select("k1", "k2", "s.anchor", "s.digest").distinct()
                .join(told, ["anchor", "digest"])
                .groupBy("k1", "k2").agg(F.collect_list(F.struct("anchor", "digest", "bits")).alias("told")))
    settled = (pending.select("doc_id", "k1", "k2", "text", "found")
               .join(verdicts.hint("shuffle_hash"), ["k1", "k2"], "left")
               .select("doc_id", "text", "found", "told").mapInArrow(_settle(keep_text), OUT))
    done = met.filter(F.col("kind") == RESULT).select("doc_id", "n_words", "n_removed", "kept_sha256", "text")
    out = done.unionByName(settled)
    return out if keep_text else out.drop("text")


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bits = [np.packbits([x["hit"] for x in f]).tobytes() for f in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(bits, pa.binary())],
                                         names=["anchor", "digest", "bits"])


__all__ = ["dedup", "SuffixAutomaton", "spans", "kept", "codes"]
