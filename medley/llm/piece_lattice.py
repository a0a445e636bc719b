"""N-best piece segmentation of whole texts, and decoding.

The lattice of a text has a node between every two characters and an arc for
each piece, weighted with the piece's score. Its best segmentations are found
exactly: a forward Viterbi pass gives each node the best score from the start,
and a backward A* search from the end uses those scores as its heuristic. As the
heuristic is exact, paths leave the queue in order and the first N are the N
best.

A space mark after another character, and a line end, lie inside no piece, so
the lattice is a chain of segments. Each segment keeps its best path and the gap
to its second best (the forward pass keeps two scores a node; remembered in a
table of bounded size). A path among a text's N best can differ from the best
one only in the N-1 segments of least gap, because all ways to differ elsewhere
score below those N-1 single changes and the best path itself. The search
over the text therefore runs on those segments' alternatives, each found by the
same A* within its segment.

A character outside the piece table costs ten below the lowest score and becomes
its UTF-8 bytes' pieces.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from medley.llm.bpe_transducer import SPACE, PieceTable, model_bytes, normalized
from medley.llm.common import text_of

MAX_KEPT = 300_000      # remembered segments per worker, and as many old ones
MAX_OPTIONS = 50_000    # segments whose alternatives are remembered
SEGMENT = re.compile(f"\n|{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+")
UNUSABLE = -1e8         # scores at or below this mark pieces that sampling never picks


def best_paths(n_nodes: int, arcs: list[tuple], forward: list[float], n: int) -> list[tuple]:
    """The ``n`` best (score, labels) from node 0 to node n_nodes - 1.

    ``arcs``: (from, to, score, label); ``forward``: best score from node 0 to
    each node, which makes the backward A* exact. Ties: by labels."""
    into: list[list] = [[] for _ in range(n_nodes)]
    for arc in arcs:
        into[arc[1]].append(arc)
    end, found = n_nodes - 1, []
    queue = [(-forward[end], (), end, 0.0)]
    while queue and len(found) < n:
        f, labels, node, g = heapq.heappop(queue)
        if not node:
            found.append((-f, labels))
            continue
        for a, _, score, label in into[node]:
            heapq.heappush(queue, (-(forward[a] + score + g), (label, *labels), a, g + score))
    return found


class _Kept(dict):
    """segment -> (best score, gap to the second best, ids as bytes). A full table
    becomes the old one, from which what is met again moves back."""

    __slots__ = ("coder", "old")

    def __missing__(self, segment: str):
        if len(self) > MAX_KEPT:
            self.old = dict(self)
            self.clear()
        entry = self[segment] = self.old.pop(segment, None) or self.coder.best(segment)
        return entry


class Coder:
    """Encoder and decoder of one piece table."""

    def __init__(self, pieces: PieceTable):
        self.p = pieces
        self.unknown = min(s for s in pieces.score.values() if s > UNUSABLE) - 10
        self.trie: dict = {}                      # char -> [children, score, id]
        for piece, score in pieces.score.items():
            node = self.trie
            for char in piece[:-1]:
                node = node.setdefault(char, [{}, None, None])[0]
            node.setdefault(piece[-1], [{}, None, None])[1:] = [score, pieces.id[piece]]
        self.options: dict = {}                   # (segment, n) -> alternatives, bounded
        self.kept = _Kept()
        self.kept.coder, self.kept.old = self, {}
        if not pieces.spaced or any("\n" in p for p in pieces.score):
            raise ValueError("pieces reach across spaces or line ends")

    def _arcs(self, segment: str):
        score, prefixes, n = self.p.score, self.p.prefixes, len(segment)
        arcs = []
        for i in range(n):
            if segment[i] not in score:
                arcs.append((i, i + 1, self.unknown))
            for j in range(i + 1, n + 1):
                piece = segment[i:j]
                s = score.get(piece)
                if s is not None:
                    arcs.append((i, j, s))
                if piece not in prefixes:
                    break
        return arcs

    def _forward(self, segment: str, arcs):
        n = len(segment)
        best, back = [0.0] + [float("-inf")] * n, [0] * (n + 1)
        for i, j, s in arcs:                      # arcs come in order of their start
            if best[i] + s > best[j]:
                best[j], back[j] = best[i] + s, i
        return best, back

    def _ids(self, segment: str, cuts) -> bytes:
        out = array("i")
        for i, j in zip(cuts, cuts[1:]):
            piece = segment[i:j]
            known = self.p.id.get(piece)
            out.extend([known] if known is not None else [self.p.byte_id[b] for b in piece.encode()])
        return out.tobytes()

    def best(self, segment: str):
        """Best score, gap to the second best, best ids; one forward pass keeps
        the two best scores of every node."""
        n, root, single = len(segment), self.trie, self.p.score
        low = float("-inf")
        best, second = [0.0] + [low] * n, [low] * (n + 1)
        back: list = [None] * (n + 1)
        for i in range(n):
            b, b2, node = best[i], second[i], root
            if segment[i] not in single:
                t, k = b + self.unknown, i + 1
                if t > best[k]:
                    second[k] = max(best[k], b2 + self.unknown)
                    best[k], back[k] = t, (i, None)
                elif t > second[k]:
                    second[k] = t
            for j in range(i, n):
                step = node.get(segment[j])
                if step is None:
                    break
                node, s, piece = step
                if s is not None:
                    t, k = b + s, j + 1
                    if t > best[k]:
                        second[k] = max(best[k], b2 + s)
                        best[k], back[k] = t, (i, piece)
                    elif t > second[k]:
                        second[k] = t
        ids, k = [], n
        while k:
            i, piece = back[k]
            if piece is None:
                ids.extend(reversed([self.p.byte_id[x] for x in segment[i:k].encode()]))
            else:
                ids.append(piece)
            k = i
        ids.reverse()
        return best[n], best[n] - second[n], array("i", ids).tobytes()

    def alternatives(self, segment: str, n: int) -> list[tuple[float, bytes]]:
        """The segment's ``n`` best (score, ids), the remembered best first."""
        known = self.options.get((segment, n))
        if known is not None:
            return known
        arcs = self._arcs(segment)
        forward, _ = self._forward(segment, arcs)
        paths = best_paths(len(segment) + 1, [(i, j, s, i) for i, j, s in arcs], forward, n)
        found = [(score, self._ids(segment, (*starts, len(segment)))) for score, starts in paths]
        top = self.kept[segment]
        first = (top[0], top[2])
        if len(self.options) > MAX_OPTIONS:
            self.options.clear()
        result = self.options[segment, n] = [first] + [x for x in found if x != first][:n - 1]
        return result

    def encode(self, text: str, n: int = 1) -> list[tuple[float, bytes]]:
        """The ``n`` best (score, ids as int32 bytes) of a whole text, best first;
        fewer where the lattice has fewer paths. '' has one empty segmentation."""
        segments = SEGMENT.findall(normalized(text))
        entries = list(map(self.kept.__getitem__, segments))
        total = sum(e[0] for e in entries)
        parts = [e[2] for e in entries]
        result = [(total, b"".join(parts))]
        if n == 1 or not segments:
            return result
        gaps = [e[1] for e in entries]
        free = sorted(heapq.nsmallest(n - 1, range(len(gaps)), key=gaps.__getitem__))
        choices = [self.alternatives(segments[k], n) for k in free]
        arcs, forward = [], [0.0]
        for k, options in enumerate(choices):
            arcs += [(k, k + 1, score, rank) for rank, (score, _) in enumerate(options)]
            forward.append(forward[-1] + options[0][0])
        fixed = total - forward[-1]
        for score, ranks in best_paths(len(free) + 1, arcs, forward, n):
            if any(ranks):
                for k, options, rank in zip(free, choices, ranks):
                    parts[k] = options[rank][1]
                result.append((fixed + score, b"".join(parts)))
        return result[:n]

    def decode(self, ids) -> str:
        """The text of an id sequence (a space mark in the text comes back as a space)."""
        raw = b"".join(map(self.p.surface.__getitem__, ids))
        text = raw.decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


_CODERS: dict = {}


def coder(model: bytes) -> Coder:
    if model not in _CODERS:
        _CODERS.clear()
        _CODERS[model] = Coder(PieceTable(model))
    return _CODERS[model]


ENCODED = ("doc_id long, n_pieces long, score double, ids array<int>, "
           "nbest array<struct<score:double,n_pieces:int,ids_sha256:string>>, round_trip boolean")
ROWS = 256              # rows encoded before a batch is passed on


def encode(docs: DataFrame, n: int = 3, model_path: str | None = None, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """One row per document: the best segmentation's ids and score, the ``n``
    best segmentations' scores, lengths and SHA-256 (over little-endian int32
    ids), and whether decoding the best gives the text back (a space mark in the
    text counts as a space). NULL or empty text: no pieces, score 0. Repeated
    rows are separate rows. No shuffle; memory is one batch of texts."""
    model = model_bytes(model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(model)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                texts = batch.column(1).to_pylist()
                coded = [c.encode(t, n) for t in texts]
                tops = [x[0][1] for x in coded]
                sizes = np.fromiter((len(t) // 4 for t in tops), np.int32, len(tops))
                ids = np.frombuffer(b"".join(tops), "<i4")
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                flat = ids.tolist()
                same = [c.decode(flat[offsets[k]:offsets[k + 1]]) == t.replace(SPACE, " ")
                        for k, t in enumerate(texts)]
                nbest = [[{"score": s, "n_pieces": len(b) // 4,
                           "ids_sha256": hashlib.sha256(b).hexdigest()} for s, b in x] for x in coded]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0), pa.array(sizes, pa.int64()),
                    pa.array([x[0][0] for x in coded], pa.float64()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids)),
                    pa.array(nbest, pa.list_(pa.struct([("score", pa.float64()),
                                                        ("n_pieces", pa.int32()),
                                                        ("ids_sha256", pa.string())]))),
                    pa.array(same)],
                    names=["doc_id", "n_pieces", "score", "ids", "nbest", "round_trip"])

    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), text_of(docs, text_col).alias("text"))
    return rows.mapInArrow(run, ENCODED)


def decode(encoded: DataFrame, model_path: str | None = None, id_col: str = "doc_id",
           ids_col: str = "ids") -> DataFrame:
    """doc_id, text from id arrays; a NULL array gives ''."""
    model = model_bytes(model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(model)
        for batch in batches:
            texts = [c.decode(ids or ()) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())],
                                             names=["doc_id", "text"])

    rows = encoded.select(encoded[id_col].cast("long").alias("doc_id"), encoded[ids_col].alias("ids"))
    return rows.mapInArrow(run, "doc_id long, text string")


__all__ = ["Coder", "best_paths", "encode", "decode"]
