"""Alignment of two tokenizers' tokens over the same bytes.

Both tokenizers cut the bytes of a space and the text. Cumulative byte ends of
each side go into a dictionary end -> token index; the intersection of the two
key sets, sorted, slices both id lists into groups that cover the same bytes.
The links of a slice are the pairs of tokens that end where it ends; as every
token has a byte at least, that is its last token of either side.

Corpus-wide work reuses what words have in common. Text is cut before a space or a
line end between two visible characters, where both sides always begin a token (A's
pattern starts a word or a blank there; B has no piece with a space or line end after
another character). Each distinct segment is tokenized and sliced once per task, many
of them in one go; a segment that is a known one and a full stop, comma or the like is
put together from the two, unless some piece of B holds that letter and mark. A
text's groups are those of its segments one after the other.

Two tokens that end together agree in their last bytes, so the shorter one is a
suffix of the longer. There are hence no more linked id pairs, in a corpus of
any size, than the tokens of both vocabularies have bytes together. That bound
(checked in ``pair_scores``) is why the corpus-wide pair counts may be sent to
every task, while the links themselves stay in a written table.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import accumulate, count
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from medley.llm.bpe_transducer import SPACE, model_bytes
from medley.llm.common import text_of, text_slices, written

SLICE = 1 << 20         # bytes of text tokenized at once (a longer text is a slice of its own)
ROWS = 256              # texts whose links are scored at once
MAX_KEPT = 100_000      # segments remembered per worker, and as many old ones,
LONGEST = 48            # of at most so many characters
# Visible characters of Latin scripts; none is white space to any pattern.
VISIBLE = "[!-~\u00A1-\u024F]"
LETTERS = frozenset(chr(c) for c in range(0x250) if chr(c).isalpha() and c not in (0xAA, 0xBA))
STOPS = frozenset(".,;:!?")
CUT = re.compile(f"([ \n])(?<={VISIBLE}.)(?={VISIBLE})", re.DOTALL)
WORD = re.compile(f"[ \n](?={VISIBLE}).*{VISIBLE}", re.DOTALL)
NONE = (0, 0, 0, b"", "")
JOINED = 10_000         # segments tokenized together


def json_bytes(path: str | None = None) -> bytes:
    """The byte-level tokenizer's file; by default the installed public one."""
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, "rb") as f:
        return f.read()


def byte_chars() -> dict[str, int]:
    """Character -> byte of byte-level vocabularies: a printable Latin-1 character
    stands for its own byte, the other bytes follow from U+0100 on."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(rest)}


class Aligner:
    """Both tokenizers with the bytes of each of their entries."""

    def __init__(self, a_json: bytes, b_model: bytes):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_buffer(a_json)
        self.a.encode_special_tokens = True       # their strings in a text are ordinary text
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        code = byte_chars()
        special = {t.content for t in self.a.get_added_tokens_decoder().values()}
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, k in self.a.get_vocab().items():
            if token not in special:
                self.a_bytes[k] = bytes(code[c] for c in token)
        self.b_bytes = []
        for k in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(k)
            if self.b.is_byte(k):
                self.b_bytes.append(bytes([int(piece[3:5], 16)]))
            elif self.b.is_control(k) or self.b.is_unknown(k) or self.b.is_unused(k):
                self.b_bytes.append(b"")
            else:
                self.b_bytes.append(piece.replace(SPACE, " ").encode())
        self.a_len, self.b_len = list(map(len, self.a_bytes)), list(map(len, self.b_bytes))
        self.text = list(map(str, range(max(len(self.a_len), len(self.b_len)))))
        if any(re.search(rb"[^ ] |\n.|.\n", piece) for piece in self.b_bytes):
            raise ValueError("pieces of B reach across a space or line end after another character")
        #: letter and mark that some piece holds
        self.joined = {pair for piece in self.b_bytes if (text := piece.decode("utf-8", "replace"))
                       for pair in zip(text, text[1:]) if pair[1] in STOPS}
        #: marks that end a word
        self.marks = {m: self.entry(self.a.encode(m, add_special_tokens=False).ids, [k]) for m in STOPS
                      if self.b_bytes[k := self.b.piece_to_id(m)] == m.encode()}
        self.kept: dict = {}
        self.old: dict = {}
        #: no more id pairs than this can be linked
        self.most_pairs = sum(self.a_len) + sum(self.b_len)

    def encode(self, texts: list[str]) -> Iterator[tuple[list[int], list[int]]]:
        """(A ids, B ids) of each text; two empty lists where the text is empty or
        either side's bytes are not those of a space and the text."""
        spaced = [" " + t for t in texts]
        both = zip(texts, spaced, self.a.encode_batch(spaced, add_special_tokens=False),
                   self.b.encode(texts, num_threads=1))
        for text, full, a, b in both:
            a, raw = a.ids, full.encode()
            if (text and b"".join(map(self.a_bytes.__getitem__, a)) == raw
                    and b"".join(map(self.b_bytes.__getitem__, b)) == raw):
                yield a, b
            else:
                yield [], []

    def cuts(self, a: list[int], b: list[int]) -> tuple[list[int], list[int], list[int]]:
        """(byte ends, A indexes, B indexes) of the groups, each index exclusive."""
        at_a = dict(zip(accumulate(map(self.a_len.__getitem__, a)), count(1)))
        at_b = dict(zip(accumulate(map(self.b_len.__getitem__, b)), count(1)))
        ends = sorted(at_a.keys() & at_b.keys())
        return ends, list(map(at_a.__getitem__, ends)), list(map(at_b.__getitem__, ends))

    def groups(self, a, b, cut_a, cut_b) -> list[str]:
        """``a1,a2|b1`` of each group: decimal ids."""
        a, b = list(map(self.text.__getitem__, a)), list(map(self.text.__getitem__, b))
        out, i, j = [], 0, 0
        for p, q in zip(cut_a, cut_b):
            out.append((a[i] if p - i == 1 else ",".join(a[i:p])) + "|"
                       + (b[j] if q - j == 1 else ",".join(b[j:q])))
            i, j = p, q
        return out

    def links(self, a, b, cut_a, cut_b) -> np.ndarray:
        """The last tokens of each group as ``A id * 2^32 + B id``."""
        last_a = np.array(a, np.int64)[np.array(cut_a, np.int64) - 1]
        return (last_a << 32) | np.array(b, np.int64)[np.array(cut_b, np.int64) - 1]

    def entry(self, a: list[int], b: list[int]) -> tuple[int, int, int, bytes, str]:
        """(A tokens, B tokens, groups, links as bytes, written groups) of a text's ids;
        zeros where it has none."""
        if not a:
            return NONE
        _, cut_a, cut_b = self.cuts(a, b)
        return (len(a), len(b), len(cut_a), self.links(a, b, cut_a, cut_b).tobytes(),
                ";".join(self.groups(a, b, cut_a, cut_b)))

    def _sliced(self, part: list[str], a: list[int], b: list[int]) -> Iterator[tuple[str, tuple]]:
        """Each segment of ``part`` with its ``entry``, from the ids of "x" and all of them."""
        ends, cut_a, cut_b = self.cuts(a, b)
        groups, links = self.groups(a, b, cut_a, cut_b), self.links(a, b, cut_a, cut_b).tobytes()
        own = np.cumsum([2, *(len(k.encode()) for k in part)])          # 2: a space and the x
        upto = np.searchsorted(np.array(ends, np.int64), own) + 1       # groups up to each end
        n_a, n_b, n = (np.diff(x).tolist() for x in (
            np.array(cut_a, np.int64)[upto - 1], np.array(cut_b, np.int64)[upto - 1], upto))
        i, *upto = upto.tolist()
        for k, j, *sizes in zip(part, upto, n_a, n_b, n):
            yield k, (*sizes, links[8 * i:8 * j], ";".join(groups[i:j]))
            i = j

    def entries(self, segments: set[str]) -> Iterator[tuple[str, tuple]]:
        """Each segment with its ``entry``. Those that end with a visible character
        are tokenized together, one after the other."""
        together = [k for k in segments if WORD.fullmatch(k) and SPACE not in k]
        alone = list(segments - set(together))
        for at in range(0, len(together), JOINED):
            part = together[at:at + JOINED]
            a, b = next(self.encode(["x" + "".join(part)]))
            if a:
                yield from self._sliced(part, a, b)
            else:                                 # one of them is not given back
                alone += part
        for k, (a, b) in zip(alone, self.encode(["x" + k for k in alone])):
            yield from self._sliced([k], a, b) if a else ((k, NONE),)

    def learn(self, segments: set[str]) -> None:
        """Have the entries of all ``segments`` among the kept ones."""
        if len(self.kept) > MAX_KEPT:
            self.old, self.kept = self.kept, {}
        missing = segments - self.kept.keys()
        stems = {k: k[:-1] for k in missing if k[-1] in self.marks and k[-2:-1] in LETTERS
                 and (k[-2], k[-1]) not in self.joined}
        missing = (missing - stems.keys()).union(stems.values()) - self.kept.keys()
        again = missing & self.old.keys()
        self.kept.update(zip(again, map(self.old.__getitem__, again)))
        self.kept.update(self.entries(missing - again))
        for k, stem in stems.items():
            word, mark = self.kept[stem], self.marks[k[-1]]
            self.kept[k] = (word[0] + mark[0], word[1] + mark[1], word[2] + mark[2], word[3] + mark[3],
                            f"{word[4]};{mark[4]}") if word[0] else NONE

    def linked(self, texts: list[str]) -> Iterator[tuple]:
        """The ``entry`` of each whole text."""
        cut = []
        for text in texts:
            first, *more = CUT.split(" " + text) if text else ("",)
            cut.append([first, *map(add, more[::2], more[1::2])] if first else [])
        here = set().union(*cut)
        self.learn(here)
        for segments in cut:
            entries = list(map(self.kept.__getitem__, segments))
            n_a, n_b, n, links, groups = zip(*entries) if entries else ((0,), (), (), (), ())
            if all(n_a):
                yield sum(n_a), sum(n_b), sum(n), b"".join(links), ";".join(groups)
            else:
                yield NONE
        for k in here:
            if len(k) > LONGEST:                  # not worth remembering
                del self.kept[k]


_ALIGNERS: dict = {}


def aligner(a_json: bytes, b_model: bytes) -> Aligner:
    """One per Python worker and pair of files."""
    key = (a_json, b_model)
    if key not in _ALIGNERS:
        _ALIGNERS.clear()
        _ALIGNERS[key] = Aligner(*key)
    return _ALIGNERS[key]


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = text_of(docs, text_col)
    return docs.select(docs[id_col].cast("long").alias("doc_id"), text.alias("text"))


ALIGNED = ("doc_id long, a_ids array<int>, b_ids array<int>, byte_ends array<int>, "
           "a_ends array<int>, b_ends array<int>")


def align(docs: DataFrame, a_path: str | None = None, b_path: str | None = None,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: both id lists and, for each group, the byte offset
    and the two token indexes where it ends (all exclusive).

    NULL or empty texts, and texts that a tokenizer doesn't give back byte for
    byte (a U+2581 inside a text is one), have empty lists. Repeated rows are
    separate rows. No shuffle; a task holds ``SLICE`` bytes at a time, and a longer
    text whole, since a tokenizer needs it whole."""
    files = json_bytes(a_path), model_bytes(b_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = aligner(*files)
        for part in text_slices(batches, 1, SLICE):
            rows = [(a, b, *t.cuts(a, b)) for a, b in t.encode(part.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *(pa.array(c, pa.list_(pa.int32())) for c in zip(*rows))],
                names=["doc_id", "a_ids", "b_ids", "byte_ends", "a_ends", "b_ends"])

    return _texts(docs, id_col, text_col).mapInArrow(run, ALIGNED)


LINKED = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, links array<long>, "
          "groups_sha256 string")


def linked(docs: DataFrame, a_path: str | None = None, b_path: str | None = None,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: token, group and link counts, the digest of its
    written groups ('' without tokens) and ``links``, one entry
    ``A id * 2^32 + B id`` per link. The same cases as ``align``."""
    files = json_bytes(a_path), model_bytes(b_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = aligner(*files)
        for part in text_slices(batches, 1, SLICE):
            n_a, n_b, n, links, groups = zip(*t.linked(part.column(1).to_pylist()))
            digests = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
            offsets = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
            flat = np.frombuffer(b"".join(links), np.int64)
            counts = [pa.array(c, pa.int64()) for c in (n_a, n_b, n, n)]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *counts, pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                 pa.array(digests, pa.string())],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "links", "groups_sha256"])

    return _texts(docs, id_col, text_col).mapInArrow(run, LINKED)


def pair_counts(links: DataFrame) -> DataFrame:
    """(pair, n, best) over all links: how often the pair is linked, and whether no
    A id is linked to its B id more often. Counted per task before the shuffle."""
    counts = (links.select(F.explode("links").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
              .withColumn("b", F.col("pair").bitwiseAND(0xFFFFFFFF)))
    top = F.max("n").over(Window.partitionBy("b"))
    return counts.withColumn("best", F.col("n") == top).select("pair", "n", "best")


def pair_scores(links: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pair counts as arrays sorted by pair; ``most`` is the proven bound."""
    counts = written(links.sparkSession, pair_counts(links), "pair-counts")
    if (found := counts.count()) > most:
        raise ValueError(f"{found} linked pairs, where the vocabularies allow {most}")
    rows = counts.toArrow().sort_by("pair")
    return tuple(rows.column(c).to_numpy() for c in ("pair", "n", "best"))


REPORT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, "
          "count_sum long, groups_sha256 string")


def alignment_report(docs: DataFrame, a_path: str | None = None, b_path: str | None = None,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Texts are tokenized once; links are written, counted, and read once more to
    be scored. A document without tokens has zeros and the digest ''. An empty
    table gives no rows."""
    spark = docs.sparkSession
    most = Aligner(json_bytes(a_path), model_bytes(b_path)).most_pairs
    links = written(spark, linked(docs, a_path, b_path, id_col, text_col), "token-links")
    scores = spark.sparkContext.broadcast(pair_scores(links, most))    # at most ``most`` pairs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts, best = scores.value
        _ALIGNERS.clear()                         # a worker that tokenized is done with it
        for batch in (whole.slice(at, ROWS) for whole in batches for at in range(0, whole.num_rows, ROWS)):
            of = batch.column(5)
            offsets = of.offsets.to_numpy().astype(np.int64)
            flat = of.values.to_numpy()[offsets[0]:offsets[-1]]
            offsets -= offsets[0]
            at = np.searchsorted(pairs, flat)
            sums = [np.concatenate([[0], np.cumsum(v[at].astype(np.int64))]) if len(flat)
                    else np.zeros(1, np.int64) for v in (best, counts)]
            n_best, total = (pa.array(s[offsets[1:]] - s[offsets[:-1]]) for s in sums)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in range(5)), n_best, total, batch.column(6)],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                       "groups_sha256"])

    return links.mapInArrow(run, REPORT)


__all__ = ["Aligner", "align", "linked", "pair_counts", "alignment_report", "byte_chars", "json_bytes"]
