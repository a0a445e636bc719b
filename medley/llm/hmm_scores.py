"""Text scores under a hidden Markov language model.

Tokens are lower-cased (A-Z) words and one end token per text. The ``symbols``
most frequent training words are symbols of their own; all other words share a
class by their last letters, and a word's probability within its class is its
smoothed training count. So the latent model has a fixed alphabet while the
counts behind it cover the whole training vocabulary:

    P(word | state) = B[state, symbol]                              own symbol
    P(word | state) = B[state, class] * (c + 1/2) / (Nc + (Vc + 1)/2)   otherwise

where unknown words together count as one more type of their class.

1. Word counts: one distributed count over all training texts.
2. Texts become symbol sequences, written once. The ``lookup`` most frequent
   words' counts travel with the task (a bounded table); rarer words of a text
   are joined with the count table by word.
3. Baum-Welch: every iteration runs forward-backward over all training texts, cut
   into runs of ``RUN`` tokens; expected counts are summed per task, then across
   partitions per symbol. Only the fixed-size parameters reach the driver.
4. The scaled forward recursion gives each whole text's exact likelihood.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from medley.llm.common import fold_of, text_of, written

STATES = 8
SYMBOLS = 16_384        # words with an own symbol
CLASSES = 512           # classes of the other words
LOOKUP = 262_144        # words whose counts every task carries
LONGEST = 64            # bytes; longer words are never carried
ITERATIONS = 4
RUN = 256               # tokens of a training run
END = b""               # the end token; no word is empty
FLUSH = 300_000


def words_of(text: str) -> list[bytes]:
    """Lower-cased A-Z words; bytes.split cuts at exactly x20 and x09-x0D."""
    return text.encode().lower().split()


def class_of(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % CLASSES


def count_words(train: DataFrame) -> DataFrame:
    """(word, class, c) of the column ``text``, the end token among them."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush():
            keys = list(seen)
            batch = pa.RecordBatch.from_arrays([
                pa.array(keys, pa.binary()), pa.array([class_of(w) for w in keys], pa.int32()),
                pa.array(list(seen.values()), pa.int64())], names=["word", "class", "c"])
            seen.clear()
            return batch

        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen.update(words_of(text))
                seen[END] += 1
                if len(seen) > FLUSH:
                    yield flush()
        yield flush()

    return (train.select("text").mapInArrow(count, "word binary, class int, c long")
            .groupBy("word", "class").agg(F.sum("c").alias("c")))


class Lexicon:
    """Bounded tables every task carries: counts and ranks of frequent words,
    class totals, corpus totals."""

    def __init__(self, words: list[bytes], counts: list[int], class_n, class_v, n: int, v: int,
                 symbols: int):
        self.words, self.counts, self.symbols = words, counts, symbols
        self.class_n, self.class_v, self.n, self.v = class_n, class_v, n, v

    @property
    def size(self) -> int:
        return self.symbols + CLASSES

    def table(self) -> dict[bytes, tuple]:
        """word -> (symbol, base term, class term, 1 if known)."""
        base = np.log10(self.n + 0.5 * (self.v + 1))
        inner = np.log10(self.class_n + 0.5 * (self.class_v + 1))
        out = {}
        for rank, (word, c) in enumerate(zip(self.words, self.counts)):
            own = rank < self.symbols
            k = class_of(word)
            log_c = float(np.log10(c + 0.5))
            out[word] = (rank if own else self.symbols + k, log_c - base,
                         0.0 if own else log_c - inner[k])
        return out


def lexicon(vocabulary: DataFrame, symbols: int, lookup: int) -> Lexicon:
    totals = vocabulary.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    # the least count class from which on at most ``lookup`` words are left, so that
    # no task sorts more than the words that are wanted
    short = (vocabulary.filter(F.octet_length("word") <= LONGEST)
             .withColumn("level", F.floor(F.log2("c") * 16)))
    left, level = lookup, None
    for r in sorted(short.groupBy("level").agg(F.count("*").alias("n")).collect(), key=lambda r: -r["level"]):
        if r["n"] > left:
            break
        left, level = left - r["n"], r["level"]
    top = short.filter(F.col("level") >= (level if level is not None else 1 << 20)).select("word", "c").toArrow()
    ranked = sorted(zip(top.column(1).to_pylist(), top.column(0).to_pylist()), key=lambda x: (-x[0], x[1]))
    words, counts = [bytes(w) for _, w in ranked], [c for c, _ in ranked]
    symbols = min(symbols, max(1, len(words)))
    per_class = vocabulary.groupBy("class").agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()
    class_n, class_v = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in per_class:
        class_n[r["class"]], class_v[r["class"]] = r["n"], r["v"]
    for word, c in zip(words[:symbols], counts):    # own symbols are not in a class
        class_n[class_of(word)] -= c
        class_v[class_of(word)] -= 1
    return Lexicon(words, counts, class_n, class_v, totals["n"] or 0, totals["v"], symbols)


ENCODED = ("part int, row long, doc_id long, held_out boolean, n_tokens long, n_known long, "
           "base double, inner double, symbols binary, rare array<struct<word:binary,n:int>>")


def encode(rows: DataFrame, carried) -> DataFrame:
    """Texts as symbol sequences (uint16), with the score terms that need no
    join and the words whose counts must be joined."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, row = TaskContext.get().partitionId(), 0
        lex: Lexicon = carried.value
        table = lex.table()
        base = -float(np.log10(lex.n + 0.5 * (lex.v + 1)))
        inner = -np.log10(lex.class_n + 0.5 * (lex.class_v + 1))
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                out = []
                for doc_id, held, text in zip(*(c.to_pylist() for c in batch.columns)):
                    words = words_of(text)
                    words.append(END)
                    entries = list(map(table.get, words))
                    rare: Counter = Counter()
                    b = m = 0.0
                    if None in entries:
                        for k, e in enumerate(entries):
                            if e is None:
                                word = words[k]
                                rare[word] += 1
                                c = class_of(word)
                                entries[k] = (lex.symbols + c, base, inner[c])
                    sym, bases, inners = zip(*entries)
                    b, m = sum(bases), sum(inners)
                    out.append((part, row, doc_id, held, len(words), len(words) - sum(rare.values()),
                                b, float(m), np.array(sym, np.uint16).tobytes(),
                                [{"word": w, "n": n} for w, n in rare.items()]))
                    row += 1
                cols = list(zip(*out)) if out else [()] * 10
                types = (pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(),
                         pa.float64(), pa.float64(), pa.binary(),
                         pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int32())])))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, types)],
                    names=[x.split()[0] for x in ENCODED.split(", ")])

    return rows.mapInArrow(run, ENCODED)


class Model:
    """start[K], move[K, K], emit[size, K]; all rows positive."""

    def __init__(self, start, move, emit):
        self.start, self.move, self.emit = start, move, emit

    @classmethod
    def initial(cls, unigram, states: int) -> Model:
        rng = np.random.default_rng(5)
        emit = unigram[:, None] * np.exp(0.5 * rng.standard_normal((len(unigram), states)))
        move = np.full((states, states), 0.1 / max(1, states - 1))
        np.fill_diagonal(move, 0.9 if states > 1 else 1.0)
        return cls(np.full(states, 1 / states), move, emit / emit.sum(0))

    def within(self):
        """Distribution over states well inside a text."""
        p = self.start
        for _ in range(64):
            p = p @ self.move
        return p / p.sum()


def expected(model: Model, runs: list[np.ndarray], firsts: list[bool]):
    """Expected counts of a batch of runs of at most RUN symbols: (start, move,
    emit by symbol)."""
    order = sorted(range(len(runs)), key=lambda k: -len(runs[k]))
    lengths = np.array([len(runs[k]) for k in order])
    flat = np.concatenate([runs[k] for k in order]).astype(np.int64)
    at = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    first = np.array([firsts[k] for k in order])
    steps, states = int(lengths[0]), len(model.start)
    active = [int(np.searchsorted(-lengths, -t)) for t in range(steps)]   # lengths > t
    begin = np.where(first[:, None], model.start, model.within())
    alphas, emits, scales = [], [], []
    a = None
    for t in range(steps):
        n = active[t]
        e = model.emit[flat[at[:n] + t]]
        a = (begin if t == 0 else a[:n] @ model.move) * e
        c = a.sum(1, keepdims=True)
        a = a / c
        alphas.append(a)
        emits.append(e)
        scales.append(c)
    start, move = np.zeros(states), np.zeros((states, states))
    gammas = np.empty((len(flat), states))
    beta = np.ones((active[-1], states))
    for t in range(steps - 1, -1, -1):
        n = active[t]
        if beta.shape[0] < n:
            beta = np.concatenate([beta, np.ones((n - beta.shape[0], states))])
        g = alphas[t] * beta
        gammas[at[:n] + t] = g / g.sum(1, keepdims=True)
        if t:
            back = emits[t] * beta / scales[t]
            move += alphas[t - 1][:n].T @ back
            beta = back @ model.move.T
    move *= model.move
    start += gammas[at[first]].sum(0)
    return start, move, flat, gammas


def runs_of(symbols: bytes) -> list[np.ndarray]:
    s = np.frombuffer(symbols, np.uint16)
    return [s[k:k + RUN] for k in range(0, len(s), RUN)]


def e_step(encoded: DataFrame, carried, size: int, states: int) -> DataFrame:
    """(symbol, k0..): expected counts summed over partitions. Symbol ``size`` is
    the start distribution, ``size + 1 + i`` the moves out of state i."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = carried.value
        total = np.zeros((size + 1 + states, states))

        def add(runs, firsts):
            start, move, flat, gammas = expected(model, runs, firsts)
            total[size] += start
            total[size + 1:] += move
            for k in range(states):
                total[:size, k] += np.bincount(flat, gammas[:, k], size)

        for batch in batches:
            runs, firsts, n = [], [], 0
            for symbols in batch.column(0).to_pylist():
                for k, r in enumerate(runs_of(symbols)):
                    runs.append(r)
                    firsts.append(k == 0)
                    n += len(r)
                    if n > 150_000:
                        add(runs, firsts)
                        runs, firsts, n = [], [], 0
            if runs:
                add(runs, firsts)
        seen = np.flatnonzero(total.any(1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen.astype(np.int32))] + [pa.array(total[seen, k]) for k in range(states)],
            names=["symbol"] + [f"k{k}" for k in range(states)])

    names = [f"k{k}" for k in range(states)]
    return (encoded.select("symbols").mapInArrow(run, "symbol int, " + ", ".join(f"{k} double" for k in names))
            .groupBy("symbol").agg(*[F.sum(k).alias(k) for k in names]))


def m_step(counts: np.ndarray, unigram: np.ndarray, size: int) -> Model:
    """New parameters; the unigram keeps every emission positive."""
    emit = counts[:size] + 20.0 * unigram[:, None]
    start = counts[size] + 1.0
    move = counts[size + 1:] + 1.0
    return Model(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))


def log_likelihood(model: Model, sequences: list[np.ndarray]) -> np.ndarray:
    """log10 likelihood of whole sequences (each of one symbol or more) by the
    scaled forward recursion, all sequences one step at a time."""
    order = sorted(range(len(sequences)), key=lambda k: -len(sequences[k]))
    lengths = np.array([len(sequences[k]) for k in order])
    flat = np.concatenate([sequences[k] for k in order])
    at = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    result = np.zeros(len(order))
    a = np.broadcast_to(model.start, (len(order), len(model.start)))
    active = np.searchsorted(-lengths, -np.arange(lengths[0]))
    for t, n in enumerate(active.tolist()):
        a = (a if t == 0 else a[:n] @ model.move) * model.emit[flat[at[:n] + t]]
        c = a.sum(1)
        a /= c[:, None]
        result[:n] += np.log10(c)
    out = np.empty(len(order))
    out[order] = result
    return out


def forward(encoded: DataFrame, carried) -> DataFrame:
    """(part, row, latent): log10 likelihood of each text's symbols."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = carried.value
        keys, sequences, n = [], [], 0

        def done():
            scores = log_likelihood(model, sequences)
            parts, rows = zip(*keys)
            return pa.RecordBatch.from_arrays(
                [pa.array(parts, pa.int32()), pa.array(rows, pa.int64()), pa.array(scores)],
                names=["part", "row", "latent"])

        for batch in batches:
            for part, row, symbols in zip(*(c.to_pylist() for c in batch.columns)):
                s = np.frombuffer(symbols, np.uint16)
                keys.append((part, row))
                sequences.append(s)
                n += len(s)
                if n > 4_000_000:
                    yield done()
                    keys, sequences, n = [], [], 0
        if keys:
            yield done()

    return encoded.select("part", "row", "symbols").mapInArrow(run, "part int, row long, latent double")


def score(docs: DataFrame, states: int = STATES, symbols: int = SYMBOLS, lookup: int = LOOKUP,
          iterations: int = ITERATIONS, held_fold: int = 1, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for
    every row. NULL or empty text: the end token alone. Repeated rows are scored
    and, outside the held-out fold, counted as often as they occur. Without
    training rows the base score is 0 and the model uniform."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"),
                       (fold_of(docs[id_col]) == held_fold).alias("held_out"),
                       text_of(docs, text_col).alias("text"))
    vocabulary = written(spark, count_words(rows.filter(~F.col("held_out"))), "lm-words")
    lex = lexicon(vocabulary, symbols, lookup)
    encoded = written(spark, encode(rows, sc.broadcast(lex)), "lm-symbols")

    unigram = np.full(lex.size, 0.5)
    unigram[:min(lex.symbols, len(lex.counts))] += lex.counts[:lex.symbols]
    unigram[lex.symbols:] += lex.class_n
    unigram /= unigram.sum()
    model = Model.initial(unigram, states)
    train = encoded.filter(~F.col("held_out"))
    for _ in range(iterations):
        found = e_step(train, sc.broadcast(model), lex.size, states).toPandas()
        counts = np.zeros((lex.size + 1 + states, states))
        counts[found["symbol"].to_numpy()] = found.drop(columns="symbol").to_numpy()
        model = m_step(counts, unigram, lex.size)

    rare = (encoded.select("part", "row", F.explode("rare").alias("r"))
            .select("part", "row", F.col("r.word").alias("word"), F.col("r.n").alias("n"))
            .join(vocabulary.select("word", "c"), "word", "left")
            .groupBy("part", "row").agg(
                F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("rare"),
                F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("rare_known")))
    latent = forward(encoded, sc.broadcast(model))
    text = encoded.select("part", "row", "doc_id", "held_out", "n_tokens", "n_known", "base", "inner")
    none = F.lit(0.0)
    return (text.join(latent, ["part", "row"]).join(rare, ["part", "row"], "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(lex.n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare", none)).alias("base_score"),
        (F.col("latent") + F.col("inner") + F.coalesce("rare", none)).alias("score")))


__all__ = ["score", "Model", "Lexicon", "expected", "log_likelihood", "m_step", "words_of", "class_of"]
