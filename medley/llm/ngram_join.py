"""Near-duplicate components by an n-gram Jaccard join.

A text's set holds the hashes of its distinct five-word shingles. Texts link
when the Jaccard similarity of their sets reaches ``num / den``; the result is
the connected components of the links.

Signatures. With a similarity of t, a set of n tokens may miss at most
n - ceil(t n) tokens in any partner, and at most n - ceil(2 t / (1 + t) n) in one
that is not smaller. All tokens have one global order: rare ones
by hash, then frequent ones by rising count. Frequent tokens fall into
``SUBCLASSES`` classes. Of a set's tokens in that order, a prefix is taken and
extended until (rare tokens) + sum over classes of (tokens - 1) exceeds the
number of tokens that may be missing; the part of it that answers the second,
smaller number is the short prefix. A rare token of the prefix is a signature
by itself, two frequent tokens of one class are one together; two similar sets
then share a signature that lies in the short prefix of the smaller one, because
the missing tokens cannot break all of them.
Sets too small for the extension use single tokens in a key space of their own.

Components without all pairs. Sets that are equal are one node from the start.
Each signature's members are verified against one member, the pivot, so the work
is linear in the signatures. While a signature still joins several components,
further rounds use other pivots, ``ROUNDS`` at most and as long as one settles a
share of ``SETTLED`` of the pairs between components; what remains are
the pairs between different components of one signature, and all of those are
held against exact bounds (sizes, short prefixes, parities of token buckets) and,
where a link stays possible, verified. So no link between components is missed, and pairs inside a component,
which cannot change it, are never listed.

Only outlines of the candidate sets (sketches, parities) are written. Whole sets
are made again from the texts, for the pairs that their outlines leave possible.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from medley.llm.common import sent_if_small, text_of, written
from medley.llm.word_hashes import MIX, mixed, word_hashes

NUM, DEN = 75, 100
NGRAM = 5
FREQUENT = 8            # counted occurrences from which a token is frequent, at least; and
PER_TOKENS = 4_000_000  # one for each so many tokens of the corpus, so that the share of tokens
                        # that are frequent, and with it the signatures of a text, stays alike
MOST_FREQUENT = 1 << 18  # frequent tokens carried by every task
SUBCLASSES = 16
SMALL, SMALLEST = 31, 23  # sets below SMALL use single tokens too, below SMALLEST only those; see sizes()
BLOCK = 4_000_000       # tokens counted together before counting across tasks
ROWS = 512              # texts handled at once
ROUNDS = 4
SETTLED = 0.1           # share of the pairs between components a round settles, else it is the last
GROUP = 4096            # sets of a signature that are handled as one array
PACK = 5                # bytes kept of a token hash when sets are compared
MEMBERS = 1024          # members compared to one copy of a pivot


def _rolled(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words."""
    m = max(0, len(words) - n + 1)
    with np.errstate(over="ignore"):
        h = np.full(m, n, np.uint64)
        for j in range(n):
            h = (h ^ words[j:j + m]) * MIX
            h ^= h >> np.uint64(32)
    return h


def shingles(texts: pa.Array, n: int = NGRAM) -> list[np.ndarray]:
    """Each text's sorted distinct shingle hashes; fewer than ``n`` words give the
    whole sequence as one, no words an empty set."""
    words, counts = word_hashes(texts, lower=True)
    rolled, at, out = _rolled(words, n), 0, []
    for k in counts.tolist():
        h = rolled[at:at + k - n + 1] if k >= n else _rolled(words[at:at + k], k) if k else rolled[:0]
        at += k
        if len(h) > 1:
            h = np.sort(h)
            h = h[np.concatenate([[True], h[1:] != h[:-1]])]
        out.append(h)
    return out


def set_id(tokens: np.ndarray) -> int:
    """64-bit digest that stands for the set."""
    import xxhash
    return int(np.uint64(xxhash.xxh3_64_intdigest(tokens.tobytes())).view(np.int64))


FIRST = "doc_id long, row_key long, size long, cid long, token long, n long"


def _first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per text (doc_id, set size, set id), and counts of tokens that occur
    twice or more in a block. A token of count f over b blocks is seen in some
    block twice once f > b, so every frequent one is found."""
    def counted():
        tokens = np.concatenate(block)
        block.clear()
        tokens.sort()                                # in place: a block is held once
        again = np.flatnonzero(tokens[1:] == tokens[:-1])
        first = np.ones(len(again), bool)
        first[1:] = again[1:] != again[:-1] + 1
        edge = np.flatnonzero(first)
        n = np.diff(np.append(edge, len(again))) + 1
        return batch_of([], tokens[again[edge]].view(np.int64).tolist(), n.tolist())

    def batch_of(rows, tokens, n):
        blank, none = [None] * len(rows), [None] * len(tokens)
        fields = list(zip(*rows)) if rows else [()] * 4
        cols = [list(f) + none for f in fields] + [blank + tokens, blank + n]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                          names=[x.split()[0] for x in FIRST.split(", ")])

    block, n, seen = [], 0, set()
    for whole in batches:
        for at in range(0, whole.num_rows, ROWS):
            batch = whole.slice(at, ROWS)
            rows = []
            for doc_id, key, tokens in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                           shingles(batch.column(2))):
                cid = set_id(tokens)
                rows.append((doc_id, key, len(tokens), cid))
                if len(tokens) and cid not in seen:   # a copy does not make tokens frequent
                    seen.add(cid)
                    block.append(tokens)
                    n += len(tokens)
            yield batch_of(rows, [], [])
            if n > BLOCK:
                yield counted()
                n, seen = 0, set()
    if block:
        yield counted()


class Frequent:
    """The frequent tokens, sorted, with their place in the order of counts."""

    def __init__(self, tokens: np.ndarray, counts: np.ndarray):
        order = np.argsort(tokens)
        self.tokens = tokens[order]
        by_count = np.lexsort((tokens, counts))
        rank = np.empty(len(tokens), np.int64)
        rank[by_count] = np.arange(len(tokens))
        self.rank = rank[order]

    def place(self, tokens: np.ndarray) -> np.ndarray:
        """Rank of each token among the frequent ones, -1 for rare ones."""
        if not len(self.tokens):
            return np.full(len(tokens), -1)
        at = np.minimum(np.searchsorted(self.tokens, tokens), len(self.tokens) - 1)
        return np.where(self.tokens[at] == tokens, self.rank[at], -1)


def sizes(num: int, den: int) -> tuple[int, int]:
    """SMALL and SMALLEST of a threshold. From SMALLEST on, a set has more tokens
    than may be missing by SUBCLASSES at least, so token pairs suffice; no set
    below it links with one of SMALL tokens."""
    smallest = max(SMALLEST, SUBCLASSES * den // num + 1)
    return max(SMALL, (smallest - 1) * den // num + 1), smallest


def signatures(tokens: np.ndarray, frequent: Frequent, num: int = NUM,
               den: int = DEN) -> tuple[np.ndarray, np.ndarray]:
    """Signature hashes of a sorted token set, and which lie in its short prefix."""
    n = len(tokens)
    if n < 1 or n < 2 and 2 * num > den:             # its only partners are equal sets
        return np.empty(0, np.uint64), np.empty(0, bool)
    small, smallest = sizes(num, den)
    missing = n - -(-n * num // den)
    fewer = n - -(-2 * n * num // (den + num))
    with np.errstate(over="ignore"):
        out, short = [], []

        def add(keys, space, inside):
            out.append(_key(keys, np.uint64(space)))
            short.append(inside)

        if n < small:                                # plain prefix in hash order
            add(tokens[:missing + 1], 3, np.arange(missing + 1) <= fewer)
        if n >= smallest:
            rank = frequent.place(tokens)
            rare = tokens[rank < 0][:missing + 1]    # already in hash order
            add(rare, 1, np.arange(len(rare)) <= fewer)
            if len(rare) <= missing:
                often = tokens[rank >= 0][np.argsort(rank[rank >= 0], kind="stable")]
                kind = (often % np.uint64(SUBCLASSES)).astype(np.int64)
                seen = np.zeros(SUBCLASSES, bool)
                gain, cut, near = len(rare), 0, 0
                for k in kind.tolist():
                    near += gain <= fewer            # tokens of the short prefix
                    cut += 1
                    gain += bool(seen[k])
                    seen[k] = True
                    if gain > missing:
                        break
                inside = np.arange(cut) < near
                for k in range(SUBCLASSES):
                    t = np.flatnonzero(kind[:cut] == k)
                    t = t[np.argsort(often[t])]
                    i, j = np.triu_indices(len(t), 1)
                    add(often[t[i]] * MIX + often[t[j]], 2, inside[t[i]] & inside[t[j]])
    return np.concatenate(out), np.concatenate(short)


def _key(x: np.ndarray, space: np.uint64) -> np.ndarray:
    x = (x ^ (space * np.uint64(0xA0761D6478BD642F))) * np.uint64(0xE7037ED1A0B428DB)
    return x ^ (x >> np.uint64(32))


def _signature_rows(carried, num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, seen = carried.value, set()
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                sigs, flags, cids, sizes, counts = [], [], [], [], []
                for tokens in shingles(whole.column(0).slice(at, ROWS)):
                    cid = set_id(tokens)
                    if cid in seen:                  # copies are one node
                        continue
                    if len(seen) > 500_000:
                        seen.clear()
                    seen.add(cid)
                    s, short = signatures(tokens, frequent, num, den)
                    sigs.append(s)
                    flags.append(short)
                    cids.append(cid)
                    sizes.append(len(tokens))
                    counts.append(len(s))
                sig = np.concatenate(sigs) if sigs else np.empty(0, np.uint64)
                yield pa.RecordBatch.from_arrays([
                    pa.array(sig.view(np.int64)), pa.array(np.repeat(np.array(cids, np.int64), counts)),
                    pa.array(np.repeat(np.array(sizes, np.int32), counts)),
                    pa.array(np.concatenate(flags) if flags else np.empty(0, bool))],
                    names=["sig", "cid", "size", "short"])
    return run


ROLES = "sig long, cid long, size int, short boolean"
SHARED = "grp long, whole boolean, cids array<bigint>, sizes array<int>, shorts array<boolean>"


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by signature and set -> the sets of each signature that has two
    or more and is in some short prefix, as arrays of at most ``GROUP`` sets. ``grp`` names the group: where
    it is one array, by its sets, so that signatures of the same sets are alike;
    a larger group by its signature, in several arrays. Holds a batch and an
    array."""
    def grouped(sig, cid, size, short, ended):
        """Cut into arrays; returns the batch and what may go on."""
        new = np.ones(len(sig), bool)
        new[1:] = (sig[1:] != sig[:-1]) | (cid[1:] != cid[:-1])
        sig, cid, size, short = sig[new], cid[new], size[new], short[new]
        shorts = np.concatenate([[0], np.cumsum(short)])
        edge = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]])) if len(sig) else np.empty(0, int)
        first, last = edge, np.concatenate([edge[1:], [len(sig)]])
        keep = len(sig)
        if not ended and len(edge):
            keep = edge[-1]
            first, last = first[:-1], last[:-1]
        rows = []
        for a, b in zip(first.tolist(), last.tolist()):
            more = int(sig[a]) == going[0]
            if not more and (b - a < 2 or shorts[a] == shorts[b]):
                continue
            for k in range(a, b, GROUP):
                rows.append((sig[a], not more and b - a <= GROUP, k, min(b, k + GROUP)))
        rest = [x[keep:] for x in (sig, cid, size, short)]
        while len(rest[0]) > GROUP:                   # a large group is passed on as it comes
            going[0] = int(rest[0][0])
            rows.append((rest[0][0], False, keep, keep + GROUP))
            keep += GROUP
            rest = [x[GROUP:] for x in rest]
        mix = mixed(cid.view(np.uint64) ^ short.astype(np.uint64))
        names = [int(mixed(np.array([mix[a:b].sum() + np.uint64(b - a)], np.uint64)).view(np.int64)[0])
                 if whole else int(s) for s, whole, a, b in rows]
        lengths = np.array([b - a for _, _, a, b in rows], np.int32)
        offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
        pick = np.concatenate([np.arange(a, b) for _, _, a, b in rows]) if rows else np.empty(0, int)
        return pa.RecordBatch.from_arrays([
            pa.array(names, pa.int64()), pa.array([w for _, w, _, _ in rows], pa.bool_()),
            pa.ListArray.from_arrays(offsets, pa.array(cid[pick])),
            pa.ListArray.from_arrays(offsets, pa.array(size[pick])),
            pa.ListArray.from_arrays(offsets, pa.array(short[pick]))],
            names=["grp", "whole", "cids", "sizes", "shorts"]), rest

    going = [None]                                   # signature of a group partly passed on
    rest = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, bool)]
    with np.errstate(over="ignore"):
        for batch in batches:
            cols = [np.concatenate([r, np.array(c, r.dtype)]) for r, c in zip(rest, batch.columns)]
            out, rest = grouped(*cols, False)
            yield out
        yield grouped(*rest, True)[0]


def packed(tokens: np.ndarray) -> bytes:
    """The low ``PACK`` bytes of each hash, sorted by them."""
    low = np.sort(tokens & np.uint64((1 << 8 * PACK) - 1))
    return low.view(np.uint8).reshape(-1, 8)[:, :PACK].tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    wide = np.zeros((len(raw) // PACK, 8), np.uint8)
    wide[:, :PACK] = np.frombuffer(raw, np.uint8).reshape(-1, PACK)
    return wide.reshape(-1).view(np.uint64)


def sketch(tokens: np.ndarray) -> bytes:
    """Tokens per bucket, about four a bucket; 255 stands for any larger number."""
    m = 16
    while 4 * m < len(tokens):
        m *= 2
    counts = np.bincount((tokens & np.uint64(m - 1)).astype(np.int64), minlength=m)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def most_shared(a: bytes, b: bytes) -> int:
    """An upper bound of the tokens two sets share, from their sketches."""
    x, y = (np.frombuffer(s, np.uint8).astype(np.int64) for s in (a, b))
    x[x == 255] = y[y == 255] = 1 << 40
    m = min(len(x), len(y))
    return int(np.minimum(x.reshape(-1, m).sum(0), y.reshape(-1, m).sum(0)).sum())


def parity(tokens: np.ndarray) -> bytes:
    """Whether the number of tokens in each of 512 buckets is odd. Each token that
    only one of two sets holds changes one bit, so the sets differ in at least as
    many tokens as their parities differ in bits."""
    counts = np.bincount((tokens >> np.uint64(40) & np.uint64(511)).astype(np.int64), minlength=512)
    return np.packbits(counts & 1).tobytes()


OUTLINES = "cid long, size int, sketch binary, parity binary"
SETS = "cid long, tokens binary"
MADE = {"size": (len, pa.int32()), "sketch": (sketch, pa.binary()), "parity": (parity, pa.binary()),
        "tokens": (packed, pa.binary())}


def _set_rows(keys: np.ndarray, bits: np.ndarray, schema: str):
    """(row_key, text) whose key and set id pass the bitmaps -> the set's id and what
    else ``schema`` names. Other texts are not read."""
    names = [x.split()[0] for x in schema.split(", ")]
    made = [MADE[name] for name in names[1:]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                part = whole.slice(at, ROWS)
                part = part.filter(pa.array(_in(keys, np.array(part.column(0), np.int64))))
                rows = []
                for tokens in shingles(part.column(1)):
                    cid = set_id(tokens)
                    if cid not in seen and _in(bits, np.array([cid]))[0]:
                        if len(seen) > 500_000:
                            seen.clear()
                        seen.add(cid)
                        rows.append((cid, *(f(tokens) for f, _ in made)))
                cols = list(zip(*rows)) if rows else [()] * len(names)
                types = [pa.int64(), *(t for _, t in made)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)
    return run


def sets_of(texts: DataFrame, homes: DataFrame, schema: str) -> DataFrame:
    """The sets whose ids ``homes`` (cid, row_key) holds, made from ``texts`` (row_key,
    text): one row at least for each, few others."""
    rows = _set_rows(bitmap(homes, "row_key"), bitmap(homes), schema)
    return texts.select("row_key", "text").mapInArrow(rows, schema)


def _in(bits: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Which ids pass the bitmap."""
    slot = ids & (len(bits) * 64 - 1)
    return (bits[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1) != 0


def _possible(num: int, den: int):
    """(pivot, cid, sizes, sketches) -> the pairs that may link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for na, nb, a, b in zip(*(c.to_pylist() for c in batch.columns[2:])):
                shared = min(most_shared(a, b), na, nb)
                keep.append(den * shared >= num * (na + nb - shared))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["pivot", "cid"]).filter(
                pa.array(keep, pa.bool_()))
    return run


def bitmap(ids: DataFrame, column: str = "cid", most_bits: int = 27) -> np.ndarray:
    """Bitmap of the low bits of a column; at most 2^most_bits bits whatever their
    number (fuller: more rows pass, none is lost)."""
    n = ids.count()
    size = 1 << min(most_bits, max(16, (16 * n).bit_length()))
    bit = F.col(column).bitwiseAND(F.lit(size - 1))
    rows = (ids.select(F.shiftright(bit, 6).alias("w"), bit.bitwiseAND(F.lit(63)).alias("b"))
            .groupBy("w").agg(F.bit_or(F.expr("shiftleft(1L, cast(b as int))")).alias("v")).toPandas())
    bits = np.zeros(size // 64, np.uint64)
    bits[rows["w"].to_numpy(np.int64)] = rows["v"].to_numpy(np.int64).view(np.uint64)
    return bits


def _verified(num: int, den: int):
    """Rows sorted by (pivot, salt, member flag, cid): the pivot's set, then its
    members' -> linked (pivot, cid)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, own, last = None, None, None
        for batch in batches:
            found = []
            for pivot, salt, member, cid, raw in zip(*(c.to_pylist() for c in batch.columns)):
                if (pivot, salt) != key:
                    key, own, last = (pivot, salt), None, None
                if not member:
                    own = unpacked(raw)
                elif own is not None and cid != last:
                    last = cid
                    other = unpacked(raw)
                    both = np.concatenate([own, other])
                    both.sort(kind="stable")
                    shared = int((both[1:] == both[:-1]).sum())
                    if den * shared >= num * (len(own) + len(other) - shared):
                        found.append((pivot, cid))
            a, b = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                                             names=["a", "b"])
    return run


def verify(pairs: DataFrame, outlines: DataFrame, texts: DataFrame, homes: DataFrame, num: int,
           den: int) -> DataFrame:
    """The linked ones of distinct (pivot, cid) pairs. Small sketches rule out most
    pairs without loss; only the sets of the rest are made again and moved. A pivot
    of many members is copied, once for each ``MEMBERS`` of them."""
    spark = pairs.sparkSession
    pairs = sent_if_small(written(spark, pairs, "pairs"))
    small = outlines.select("cid", F.col("size").alias("n"), F.col("sketch").alias("s"))
    lead = small.select(F.col("cid").alias("pivot"), F.col("n").alias("pn"), F.col("s").alias("ps"))
    pairs = (small.join(pairs, "cid").join(lead, "pivot").select("pivot", "cid", "n", "pn", "s", "ps")
             .mapInArrow(_possible(num, den), "pivot long, cid long").distinct())
    pairs = written(spark, pairs, "possible-pairs")
    salts = (pairs.groupBy("pivot").agg(F.ceil(F.count("*") / MEMBERS).cast("int").alias("salts")))
    members = (pairs.join(salts, "pivot")
               .withColumn("salt", F.pmod(F.xxhash64("cid"), F.col("salts")).cast("int"))
               .select("pivot", "salt", F.lit(1).alias("member"), "cid"))
    pivots = salts.select("pivot", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
                          F.lit(0).alias("member"), F.col("pivot").alias("cid"))
    roles = written(spark, members.unionByName(pivots), "pair-roles")
    needed = written(spark, homes.join(roles.select("cid").distinct(), "cid", "left_semi"), "needed-texts")
    rows = sets_of(texts, needed, SETS).join(sent_if_small(roles), "cid")
    return (rows.select("pivot", "salt", "member", "cid", "tokens").repartition("pivot", "salt")
            .sortWithinPartitions("pivot", "salt", "member", "cid")
            .mapInArrow(_verified(num, den), "a long, b long"))


def _across(num: int, den: int):
    """Rows sorted by (signature, block pair) -> the pairs of different components
    whose sizes, short prefixes and parities leave a link possible. A block pair
    holds at most about two blocks of ``GROUP`` sets; nothing else is kept."""
    def judged(rows):
        block, cid, size, short, comp, bits = zip(*rows)
        block, cid, comp = np.array(block), np.array(cid), np.array(comp)
        size, short = np.array(size, np.int64), np.array(short)
        bits = np.frombuffer(b"".join(bits), np.uint64).reshape(len(rows), -1)
        cross = block.min() != block.max()
        out = []
        for k in range(len(rows) - 1):
            n, m = size[k], size[k + 1:]
            ok = (comp[k + 1:] != comp[k]) & (np.minimum(n, m) * den >= np.maximum(n, m) * num)
            ok &= (short[k] & (n <= m)) | (short[k + 1:] & (m <= n))
            if cross:
                ok &= block[k + 1:] != block[k]
            at = np.flatnonzero(ok) + k + 1
            if len(at):
                apart = np.bitwise_count(bits[at] ^ bits[k]).sum(1)
                both = n + size[at]
                at = at[apart <= both - 2 * -(-num * both // (num + den))]
                out += [(int(cid[k]), int(x)) for x in cid[at]]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, out, seen = None, [], [], set()

        def flush():
            fresh = [p for p in map(lambda p: (min(p), max(p)), out) if p not in seen]
            seen.update(fresh)
            if len(seen) > 500_000:
                seen.clear()
            out.clear()
            a, b = zip(*set(fresh)) if fresh else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                                              names=["pivot", "cid"])

        for batch in batches:
            for sig, lo, hi, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if (sig, lo, hi) != key:
                    if len(rows) > 1:
                        out += judged(rows)
                    key, rows = (sig, lo, hi), []
                rows.append(row)
            yield flush()
        if len(rows) > 1:
            out += judged(rows)
        yield flush()
    return run


def across_components(rows: DataFrame, outlines: DataFrame, num: int, den: int) -> DataFrame:
    """Candidate (pivot, cid) pairs between the components of each signature. A
    signature of more than ``GROUP`` sets is cut into blocks; each pair of blocks
    meets in a task of its own."""
    blocks = rows.groupBy("sig").agg(F.ceil(F.count("*") / GROUP).cast("int").alias("nb"))
    cut = (rows.join(blocks, "sig").join(outlines.select("cid", "parity"), "cid")
           .withColumn("b", F.pmod(F.xxhash64("cid"), F.col("nb")).cast("int"))
           .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("nb") - 1))))
    cut = cut.select("sig", F.least("b", "o").alias("lo"), F.greatest("b", "o").alias("hi"),
                     "b", "cid", "size", "short", "comp", "parity")
    return (cut.repartition("sig", "lo", "hi").sortWithinPartitions("sig", "lo", "hi")
            .mapInArrow(_across(num, den), "pivot long, cid long"))


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, label): the least node of each connected component, for all nodes
    of the undirected ``edges`` (a, b). Labels fall to the least among neighbours
    and then to the label's own label, until nothing changes."""
    edges = written(spark, edges.select("a", "b").unionByName(
        edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = written(spark, edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label"))
                     .withColumnRenamed("a", "node"), "labels")
    while True:
        near = (edges.join(labels, edges["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("m")))
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("up"))
        step = (labels.join(near, labels["node"] == near["a"], "left").join(up, "label", "left")
                .select("node", F.least("label", F.coalesce("m", "label"), F.coalesce("up", "label")).alias("next"),
                        "label"))
        step = written(spark, step, "labels")
        labels = step.select("node", F.col("next").alias("label"))
        if step.filter("next != label").isEmpty():
            return labels


def _meet(a: str, b: str, num: int, den: int):
    """Whether two rows of a signature are a candidate pair: sizes that can be
    similar enough, and the signature in the short prefix of the smaller set."""
    n, m = F.col(f"{a}size"), F.col(f"{b}size")
    return ((F.least(n, m) * den >= F.greatest(n, m) * num)
            & ((F.col(f"{a}short") & (n <= m)) | (F.col(f"{b}short") & (m <= n))))


def linked_components(spark: SparkSession, shared: DataFrame, outlines: DataFrame, texts: DataFrame,
                      homes: DataFrame, num: int = NUM, den: int = DEN) -> DataFrame:
    """(node, label) for the sets of ``shared`` (sig, cid, size, short) that have links."""
    comp, links, last = None, None, False
    before = shared.groupBy("sig").count().agg(F.sum(F.expr("double(count) * (count - 1)"))).first()[0] or 0
    for turn in range(ROUNDS + 1):
        if comp is None:
            rows = shared.withColumn("comp", F.col("cid"))
        else:
            rows = (shared.join(comp.withColumnRenamed("node", "cid"), "cid", "left")
                    .withColumn("comp", F.coalesce("label", "cid")).drop("label"))
        if turn:                                     # a signature inside one component stays so
            rows = written(spark, rows, "labelled-signatures")
            open_ = (rows.groupBy("sig", "comp").count().groupBy("sig")
                     .agg(F.count("*").alias("comps"),
                          F.expr("pow(sum(count), 2) - sum(double(count) * count)").alias("apart"))
                     .filter("comps > 1"))
            open_ = written(spark, open_, "open")
            rows = written(spark, rows.join(open_.select("sig"), "sig"), "open-signatures")
            if rows.isEmpty():
                break
            shared = rows.drop("comp")
            apart = open_.agg(F.sum("apart")).first()[0]
            last = turn == ROUNDS or apart > (1 - SETTLED) * before
            before = apart
        if not last:
            lead = rows.groupBy("sig").agg(F.min(F.struct(
                ~F.col("short"), F.xxhash64(F.lit(turn), "cid").alias("h"), "cid", "size", "short",
                "comp")).alias("p"))
            lead = lead.select("sig", F.col("p.cid").alias("pivot"), F.col("p.size").alias("psize"),
                               F.col("p.short").alias("pshort"), F.col("p.comp").alias("pcomp"))
            pairs = rows.join(lead, "sig").filter((F.col("pcomp") != F.col("comp")) & _meet("", "p", num, den))
        else:
            pairs = across_components(rows, outlines, num, den)
        pairs = pairs.select("pivot", "cid")
        found = written(spark, verify(pairs.distinct(), outlines, texts, homes, num, den), "links")
        links = found if links is None else links.unionByName(found)
        if not found.isEmpty():
            comp = components(spark, links)
        if last:
            break
    return comp if comp is not None else spark.range(0).select(F.col("id").alias("node"), F.col("id").alias("label"))


def join_components(docs: DataFrame, num: int = NUM, den: int = DEN, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, class_id for every row. ``component_id``
    is the least id reachable by links, ``class_id`` the least id among texts of
    the same set. Empty sets (NULL, empty or blank texts) are linked with nothing.
    Equal sets link whatever their ids; rows that repeat are equal sets."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    text = text_of(docs, text_col)
    texts = docs.select(docs[id_col].cast("long").alias("doc_id"),
                        F.xxhash64(docs[id_col], text).alias("row_key"), text.alias("text"))
    first = written(spark, texts.mapInArrow(_first_pass, FIRST), "shingle-sets")
    rows = first.filter("cid is not null")
    least = max(FREQUENT, (rows.agg(F.sum("size")).first()[0] or 0) // PER_TOKENS)
    top = (first.filter("cid is null").groupBy("token").agg(F.sum("n").alias("n"))
           .filter(F.col("n") >= least).orderBy(F.col("n").desc(), "token").limit(MOST_FREQUENT).toPandas())
    frequent = Frequent(top["token"].to_numpy(np.int64).view(np.uint64), top["n"].to_numpy(np.int64))
    only = texts.select("text")
    groups = (only.mapInArrow(_signature_rows(sc.broadcast(frequent), num, den), ROLES)
              .repartition("sig").sortWithinPartitions("sig", "cid").mapInArrow(_shared, SHARED))
    groups = written(spark, groups, "signature-groups")
    once = groups.filter("whole").groupBy("grp").agg(
        *[F.first(c).alias(c) for c in ("cids", "sizes", "shorts")])
    groups = groups.filter("not whole").drop("whole").unionByName(once)
    shared = groups.select(F.col("grp").alias("sig"), F.explode(F.arrays_zip("cids", "sizes", "shorts")).alias("m"))
    shared = written(spark, shared.select("sig", F.col("m.cids").alias("cid"), F.col("m.sizes").alias("size"),
                                          F.col("m.shorts").alias("short")), "shared-signatures")
    homes = (rows.select("cid", "row_key").join(shared.select("cid").distinct(), "cid", "left_semi")
             .groupBy("cid").agg(F.min("row_key").alias("row_key")))
    homes = written(spark, homes, "candidate-texts")
    outlines = written(spark, sets_of(texts, homes, OUTLINES), "candidate-outlines")
    comp = linked_components(spark, shared, outlines, texts, homes, num, den)
    nodes = (rows.join(comp.withColumnRenamed("node", "cid"), "cid", "left")
             .withColumn("comp", F.coalesce("label", "cid")))
    least = written(spark, nodes.filter("size > 0").groupBy("comp", "cid").agg(F.min("doc_id").alias("class_id")),
                    "least-ids")
    least = least.join(least.groupBy("comp").agg(F.min("class_id").alias("component_id")), "comp")
    least = written(spark, least.select("cid", "comp", "class_id", "component_id"), "component-ids")
    own = F.col("size") == 0
    return (rows.join(least, "cid", "left").select(
        "doc_id", F.col("size").alias("n_shingles"),
        F.when(own, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(own, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(~own, F.col("comp")).alias("group_key"), "row_key"))


def keep_one(docs: DataFrame, num: int = NUM, den: int = DEN, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: that of least id (NULL first;
    equal ids by a hash of the text; of rows alike in both, one). Rows without
    words are in no component and all stay. Columns unchanged."""
    joined = join_components(docs, num, den, id_col, text_col)
    keep = (joined.filter("group_key is not null").groupBy("group_key")
            .agg(F.min(F.struct("doc_id", "row_key")).alias("m")).select(F.col("m.row_key").alias("_row_key")))
    text = text_of(docs, text_col)
    words = text.rlike(r"[^\x20\x09-\x0D]")
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"),
                       F.xxhash64(docs[id_col], text).alias("_row_key"), words.alias("_words"))
    one = (rows.filter("_words").join(keep.hint("shuffle_hash"), "_row_key", "left_semi")
           .dropDuplicates(["_row_key"]))
    return one.unionByName(rows.filter("not _words")).select("row.*")


__all__ = ["join_components", "keep_one", "components", "signatures", "shingles", "Frequent", "verify"]
