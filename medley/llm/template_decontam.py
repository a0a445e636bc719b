"""Benchmark decontamination by canonical templates.

Words lose case and outer punctuation; operators (+ - * / = and the like) are words.
Windows of documents and benchmark items meet in a hash join, in three ways.

* By words: runs of ``width`` words, or a shorter item as a whole. All words are the
  same, whatever they are; such a window counts always, so a copy is found without
  exception.
* By template: numbers, names (capitalised inside a sentence) and units (after a
  number) become typed placeholders. A window grows from each word until it has
  ``width`` words and ``least`` literal ones among them, so text full of numbers has
  windows as well, only longer ones; it ends at the same word in the document and
  in the item, as both see the same literals.
* An item with no such window (too few literal words altogether) is one template
  window of its own length, if it has ``SHORT`` literal words.

A template window counts if, in its (document, item, alignment), each value of the
item stands for one value of the document; a value that stands for several drops the
changed windows that hold it, not the alignment. Different values of the item may
become the same one.

Before the join, documents test their windows against bitmaps of the
benchmark's window hashes, one for each way and length. Their size is fixed between
8 KB and 16 MB whatever the size of the benchmark; a fuller bitmap lets more windows
reach the exact join and never loses one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from medley.llm.common import WORD, text_of, text_slices, written
from medley.llm.word_hashes import mixed, powers

WIDTH = 8
LITERALS = 5            # literal words a template window grows to
SHORT = 4               # literal words an item needs that is one template window
MAX_WORDS = 100_000     # remembered words per worker,
LONGEST = 64            # each of so many characters at most
WORDS, GROWN, WHOLE = 0, 1, 2          # the three ways
NUM, NAME, UNIT = (np.uint64(x) for x in (11, 13, 17))
# Units that may follow a number.
UNITS = frozenset("""mm cm m km in ft mi mg g kg t lb oz ml l s sec secs ms min mins h hr hrs hours
minutes seconds days weeks months years percent % usd eur gbp dollars euros pounds kb mb gb tb hz khz
mhz ghz w kw mw kwh v a c f k degrees""".split())
EDGE = re.compile(r"^[^\w%$€£+-]+|[^\w%]+$")
NUMBER = re.compile(r"^[+\-$€£]?\d[\d.,:/]*%?$")
OPERATOR = re.compile(r"^[+\-*/=<>^%×÷±≤≥≠·|&~]+$")
CAP, STOP, ISNUM, ISUNIT, NOTHING = 1, 2, 4, 8, 16
BASE = 0xA0761D6478BD642F
INVERSE = pow(BASE, -1, 2**64)
MIX = np.uint64(0x9E3779B97F4A7C15)


class _Words(dict):
    """word -> row of the property tables."""

    def __init__(self):
        self.codes, self.flags, self.forms = [], [], []

    def __missing__(self, word: str) -> int:
        import xxhash
        core = word if OPERATOR.match(word) else EDGE.sub("", word)
        low = core.lower()
        flag = 0
        if not core:
            flag |= NOTHING
        elif NUMBER.match(core):
            flag |= ISNUM
        elif core[0].isupper() and core[1:].islower():
            flag |= CAP
        if low in UNITS:
            flag |= ISUNIT
        if word[-1] in ".!?:" or word.rstrip("\"')]»”")[-1:] in (".", "!", "?"):
            flag |= STOP
        row = len(self.codes)
        if len(word) <= LONGEST:
            self[word] = row
        self.codes.append(xxhash.xxh3_64_intdigest(low) | 32)     # never a placeholder
        self.flags.append(flag)
        self.forms.append(low)
        return row


_WORDS: list = []


def template_words(texts: list[str]):
    """The kept words of a batch of texts, one text after the other: text number,
    word rows and placeholder kinds, and the word table."""
    if not _WORDS or len(_WORDS[0].codes) > MAX_WORDS:
        _WORDS[:] = [_Words()]
    words = _WORDS[0]
    rows, owner = [], []
    for text in texts:
        found = list(map(words.__getitem__, WORD.findall(text)))
        rows.append(np.array(found, np.int64))
        owner.append(len(found))
    rows = np.concatenate(rows) if rows else np.empty(0, np.int64)
    owner = np.repeat(np.arange(len(texts)), owner)
    flags = np.array(words.flags, np.uint8)[rows]
    some = (flags & NOTHING) == 0
    rows, owner, flags = rows[some], owner[some], flags[some]
    first = np.ones(len(rows), bool)
    first[1:] = owner[1:] != owner[:-1]
    after_stop, after_num = first.copy(), np.zeros(len(rows), bool)
    after_stop[1:] |= (flags[:-1] & STOP) != 0
    after_num[1:] = ((flags[:-1] & ISNUM) != 0) & ~first[1:]
    kind = np.zeros(len(rows), np.uint8)
    kind[((flags & CAP) != 0) & ~after_stop] = 2
    kind[((flags & ISUNIT) != 0) & after_num] = 3
    kind[(flags & ISNUM) != 0] = 1
    return owner, rows, kind, words


class _Windows:
    """The windows of a batch of texts: hashes read off prefix sums."""

    def __init__(self, texts: list[str]):
        self.owner, self.rows, self.kind, self.words = template_words(texts)
        codes = np.array(self.words.codes, np.uint64)[self.rows]
        symbols = np.array([0, NUM, NAME, UNIT], np.uint64)[self.kind]
        symbols[self.kind == 0] = codes[self.kind == 0]
        self.literal = np.concatenate([[0], np.cumsum(self.kind == 0)])
        self.starts = np.searchsorted(self.owner, np.arange(len(texts)))
        self.length = np.bincount(self.owner, minlength=len(texts))
        self.ends = (self.starts + self.length)[self.owner]        # of each word's text
        n = len(self.rows)
        self.sums = []
        with np.errstate(over="ignore"):
            for source in (codes, symbols):
                sums = np.zeros(n + 1, np.uint64)
                np.cumsum(source * powers(n, BASE), out=sums[1:])
                self.sums.append(sums)

    def hashes(self, at: np.ndarray, size, typed: bool) -> np.ndarray:
        """Hashes of the ``size`` words from each place in ``at``."""
        sums = self.sums[typed]
        size = np.broadcast_to(np.asarray(size, np.int64), at.shape)
        with np.errstate(over="ignore"):
            h = (sums[at + size] - sums[at]) * powers(len(sums), INVERSE)[at]
            return mixed(h + size.astype(np.uint64) * MIX)

    def fixed(self, w: int) -> np.ndarray:
        """Places of the windows of ``w`` words."""
        at = np.arange(max(0, len(self.rows) - w + 1))
        return at[at + w <= self.ends[:len(at)]]

    def literals(self, at: np.ndarray, size) -> np.ndarray:
        return self.literal[at + size] - self.literal[at]

    def grown(self, width: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, sizes) of the template windows with a placeholder."""
        at = np.arange(len(self.rows))
        # the word that makes the literals ``least``, and the width at least
        upto = np.searchsorted(self.literal, self.literal[:-1] + least)
        size = np.maximum(upto - at, width)
        ok = at + size <= self.ends
        at, size = at[ok], size[ok]
        some = self.literals(at, size) < size
        return at[some], size[some]

    def slots(self, at: int, size: int) -> list[str]:
        """Placeholder values of a window: kind and value, in order."""
        kind, forms = self.kind, self.words.forms
        return [f"{kind[k]}{forms[self.rows[k]]}" for k in range(at, at + size) if kind[k]]

    def batch(self, keys, at, size, h, way: int, slots: list) -> pa.RecordBatch:
        size = np.broadcast_to(np.asarray(size, np.int32), at.shape)
        return pa.RecordBatch.from_arrays([
            pa.array(keys[self.owner[at]], pa.int64()), pa.array(np.full(len(at), way, np.int8)),
            pa.array(size.astype(np.int32)), pa.array(h.view(np.int64)),
            pa.array((at - self.starts[self.owner[at]]).astype(np.int32)),
            pa.array(slots, pa.list_(pa.string()))], names=["key", "way", "w", "h", "pos", "slots"])


WINDOWS = "key long, way byte, w int, h long, pos int, slots array<string>"


def _item_windows(width: int, least: int):
    """Arrow mapper from (key, item text) to its windows of all three ways."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, 1):
            keys, texts = np.array(batch.column(0)), batch.column(1).to_pylist()
            win = _Windows(texts)
            for w in sorted({min(width, int(n)) for n in win.length if n}):
                at = win.fixed(w)
                at = at[(win.length[win.owner[at]] == w) | (w == width)]
                yield win.batch(keys, at, w, win.hashes(at, w, False), WORDS, [win.slots(k, w) for k in at])
            at, size = win.grown(width, least)
            yield win.batch(keys, at, size, win.hashes(at, size, True), GROWN,
                            [win.slots(k, n) for k, n in zip(at, size)])
            # texts without any such window, all literal ones aside
            has = np.bincount(win.owner[at], minlength=len(texts)) > 0
            at = win.starts[~has & (win.length > 0)]
            size = win.length[win.owner[at]]
            inside = win.literals(at, size)
            some = (inside >= SHORT) & (inside < size)
            at, size = at[some], size[some]
            yield win.batch(keys, at, size, win.hashes(at, size, True), WHOLE,
                            [win.slots(k, n) for k, n in zip(at, size)])
    return run


def _document_windows(width: int, least: int, bitmaps: dict[tuple[int, int], np.ndarray]):
    """Arrow mapper from (key, text) to the windows that pass their bitmap; those by
    words without slots. ``bitmaps``: by (way, length), length 0 for grown windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, 1):
            keys, texts = np.array(batch.column(0)), batch.column(1).to_pylist()
            win = _Windows(texts)
            for (way, w), bits in bitmaps.items():
                at, size = (win.grown(width, least) if way == GROWN else (win.fixed(w), w))
                if way == WHOLE:
                    inside = win.literals(at, w)
                    at = at[(inside >= SHORT) & (inside < w)]
                h = win.hashes(at, size, way != WORDS)
                slot = h & np.uint64(len(bits) * 64 - 1)
                hit = np.flatnonzero((bits[(slot >> np.uint64(6)).astype(np.int64)]
                                      >> (slot & np.uint64(63))) & np.uint64(1))
                size = np.broadcast_to(np.asarray(size), at.shape)[hit]
                at = at[hit]
                slots = ([None] * len(at) if way == WORDS
                         else [win.slots(k, n) for k, n in zip(at, size)])
                yield win.batch(keys, at, size, h[hit], way, slots)
    return run


def _consistent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow mapper from alignments to the positions of their windows that count."""
    for batch in batches:
        out = []
        for run in batch.to_pylist():
            values: dict[str, set] = {}
            for win in run["windows"]:
                for i, d in zip(win["item_slots"], win["slots"]):
                    values.setdefault(i, set()).add(d)
            kept = [win for win in run["windows"] if win["item_slots"] == win["slots"]
                    or all(len(values[i]) == 1 for i in win["item_slots"])]
            if kept:
                out.append({"key": run["key"], "item": run["item"],
                            "positions": sorted({win["pos"] for win in kept}),
                            "last": max(win["pos"] + win["w"] - 1 for win in kept)})
        yield pa.RecordBatch.from_pylist(out, schema=pa.schema([
            ("key", pa.int64()), ("item", pa.int64()), ("positions", pa.list_(pa.int32())),
            ("last", pa.int32())]))


RUNS = "key long, item long, positions array<int>, last int"


def _bitmap(windows: DataFrame) -> np.ndarray:
    """Bitmap of the window hashes: a power of two between 2^16 and 2^27 bits."""
    n = windows.count()
    size = 1 << min(27, max(16, (16 * n - 1).bit_length() if n else 16))
    bit = F.col("h").bitwiseAND(F.lit(size - 1))
    rows = (windows.select(F.shiftright(bit, 6).alias("w"), bit.bitwiseAND(F.lit(63)).alias("b"))
            .groupBy("w").agg(F.bit_or(F.expr("shiftleft(1L, cast(b as int))")).alias("v")).toPandas())
    bits = np.zeros(size // 64, np.uint64)          # at most 2^21 rows reach the driver
    bits[rows["w"].to_numpy(np.int64)] = rows["v"].to_numpy(np.int64).view(np.uint64)
    return bits


def text_key(id_col, text):
    """What tells rows apart: id and text."""
    return F.xxhash64(id_col, text)


def _alignments(docs: DataFrame, benchmark: DataFrame, width: int, least: int,
                id_col: str, text_col: str, item_col: str) -> DataFrame:
    """(key, item_id, positions, last): where the document's windows begin that count,
    and the last word they hold, by alignment of a document with an item. Items are
    aligned once per distinct text."""
    spark = docs.sparkSession
    named = benchmark.select(benchmark[item_col].cast("long").alias("item_id"),
                             text_of(benchmark, "text").alias("text")).withColumn("item", F.xxhash64("text"))
    items = named.select(F.col("item").alias("key"), "text").distinct()
    bench = items.mapInArrow(_item_windows(width, least), WINDOWS)
    # every holder of a window: all items, all positions
    bench = written(spark, bench.select("way", "w", "h", F.col("slots").alias("item_slots"),
                                        F.col("key").alias("item"), F.col("pos").alias("item_pos")),
                    "benchmark-windows")
    text = text_of(docs, text_col)
    texts = docs.select(text_key(docs[id_col], text).alias("key"), text.alias("text"))
    length = F.when(F.col("way") == GROWN, 0).otherwise(F.col("w"))
    # lengths of whole items only: those below ``width``, and those of the third way
    ways = sorted((r["way"], r["n"]) for r in bench.select("way", length.alias("n")).distinct().collect())
    if not ways:
        return spark.createDataFrame([], "key long, item_id long, positions array<int>, last int")
    bits = spark.sparkContext.broadcast({
        (way, n): _bitmap(bench.filter((F.col("way") == way) & (length == n))) for way, n in ways}).value
    met = texts.mapInArrow(_document_windows(width, least, bits), WINDOWS).join(bench, ["way", "w", "h"])
    slots = F.coalesce("slots", "item_slots")
    groups = met.filter(F.size(slots) == F.size("item_slots")).select(
        "key", "item", (F.col("pos") - F.col("item_pos")).alias("shift"),
        F.struct("pos", "w", "item_slots", slots.alias("slots")).alias("window"))
    runs = groups.groupBy("key", "item", "shift").agg(F.collect_set("window").alias("windows"))
    names = named.select("item", "item_id").distinct()
    return runs.mapInArrow(_consistent, RUNS).join(names, "item").select("key", "item_id", "positions", "last")


def matches(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, least: int = LITERALS,
            id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """(key, item_id, first_word, last_word, n_windows) of alignments with windows that count;
    ``key`` is ``text_key`` of the document.

    Items shorter than ``width`` words match as a whole, down to one word; a
    benchmark whose shortest items say nothing is to be filtered by the caller.
    A window that several items share, or that an item repeats, counts for each of
    them in its own alignment; a place where windows of several ways begin is one.
    NULL or empty texts hold nothing, nor does an empty benchmark; rows alike in id
    and text have one ``key``. A very long text is handled whole, in one task."""
    return _alignments(docs, benchmark, width, least, id_col, text_col, item_col).select(
        "key", "item_id", F.array_min("positions").alias("first_word"),
        F.col("last").alias("last_word"),
        F.size("positions").cast("long").alias("n_windows"))


def report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           width: int = WIDTH, least: int = LITERALS, item_col: str = "item_id") -> DataFrame:
    """doc_id, contaminated, n_windows, items (ids, ascending) for every row.

    ``n_windows`` adds up, for each of the items, the document's words where windows
    begin that count. A NULL or empty text holds none; repeated rows are rows of
    their own with the same result; an empty table gives no rows."""
    found = _alignments(docs, benchmark, width, least, id_col, text_col, item_col)
    found = found.groupBy("key", "item_id").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("positions")))).cast("long").alias("n_windows"))
    per = found.groupBy("key").agg(F.sum("n_windows").alias("n_windows"),
                                   F.array_sort(F.collect_set("item_id")).alias("items"))
    rows = docs.select(docs[id_col].alias("doc_id"),
                       text_key(docs[id_col], text_of(docs, text_col)).alias("key"))
    return rows.join(per, "key", "left").select(
        "doc_id", F.col("items").isNotNull().alias("contaminated"),
        F.coalesce("n_windows", F.lit(0).cast("long")).alias("n_windows"),
        F.coalesce("items", F.array().cast("array<bigint>")).alias("items"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                      text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the rows that hold a benchmark window; columns unchanged. Rows
    without a text stay, repeated rows go or stay together.

    The keys found are written first: their real size tells the planner whether they
    can be sent to the documents, which then stay where they are."""
    found = matches(docs, benchmark, id_col=id_col, text_col=text_col, **options)
    found = written(docs.sparkSession, found.select(F.col("key").alias("_key")).distinct(), "contaminated-keys")
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    return (docs.select(row, text_key(docs[id_col], text_of(docs, text_col)).alias("_key"))
            .join(found, "_key", "left_anti").select("row.*"))


__all__ = ["matches", "report", "drop_contaminated", "template_words", "text_key"]
