"""Token counts by a finite-state transducer compiled from a BPE piece table.

BPE has two properties that make it a finite-state machine. A token sequence is
the encoding of its text exactly when every adjacent pair is (the pair, joined
and encoded again, gives the pair back), and every prefix of a text has one last
token T(prefix), with the rest of that prefix's encoding ending before it. So
while reading characters it suffices to remember, for each start from which some
piece could still grow, the token that ended there and how many tokens lie
before it. That bounded tuple is the state. A character's transition leads to
the next state and emits the change in the token count (which may be negative:
a longer piece takes the place of several). States are built when first met and
kept in a table of bounded size.

Two neighbouring characters that occur in no piece are a hard boundary: what
follows does not depend on what went before. A chunk's state map therefore needs
only the text before its first boundary (which waits for the entry state), the
tokens between the boundaries, and the text after the last one. These maps
compose associatively; ``compose_all`` combines them pairwise, as a parallel
prefix scan does.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from medley.llm.common import text_of

CHUNK = 32_768          # code points
MAX_STATES = 150_000    # states, and
MAX_WORDS = 300_000     # word transitions (and as many old ones) per table
SPACE = "▁"


def model_bytes(path: str | None = None) -> bytes:
    """The tokenizer's file; by default the installed public 32k piece model."""
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path("piece_bpe_32k.model")
    with open(path, "rb") as f:
        return f.read()


class PieceTable:
    """Normal pieces with scores and ids, and the 256 byte pieces."""

    def __init__(self, model: bytes):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.score: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.byte_id = [0] * 256
        self.surface: list[bytes] = []
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
                self.surface.append(bytes([int(piece[3:5], 16)]))
            elif sp.is_unknown(i) or sp.is_control(i) or sp.is_unused(i):
                self.surface.append(b"")
            else:
                self.score[piece], self.id[piece] = sp.get_score(i), i
                self.surface.append(piece.replace(SPACE, " ").encode())
        self.longest = max(map(len, self.score))
        self.bigrams = {p[k:k + 2] for p in self.score for k in range(len(p) - 1)}
        self.prefixes = {p[:k] for p in self.score for k in range(1, len(p))}
        #: whether a space mark after anything else is always a hard boundary
        self.spaced = not any(b[1] == SPACE != b[0] for b in self.bigrams)


def normalized(text: str) -> str:
    """Identity normaliser with a leading space mark; '' stays ''."""
    return SPACE + text.replace(" ", SPACE) if text else ""


class _State(dict):
    """char -> (next state, change in count). ``live`` lists, flat: the trie node
    of a start's text, the token that ended there (None at a boundary) and the
    tokens before it minus the tokens now; longest start first."""

    __slots__ = ("machine", "live", "last")

    def __missing__(self, char: str):
        arc = self[char] = self.machine.arc(self, char)
        return arc


START = (0, None, 0)


class _Words(dict):
    """Word -> tokens emitted from the root over ``before`` and the word: the
    path between two boundaries as one transition. A full table becomes the old
    one, from which what is met again moves back."""

    __slots__ = ("machine", "before", "old")

    def __missing__(self, word: str) -> int:
        if len(self) > MAX_WORDS:
            self.old = dict(self)
            self.clear()
        n = self[word] = self.old.pop(word, 0) or self.machine.run(self.before + word)
        return n


SPACED = re.compile(f"{SPACE}+[^{SPACE}]*")


class Transducer:
    """Lazily built transducer of one piece table."""

    def __init__(self, pieces: PieceTable):
        self.p = pieces
        self.child: list[dict[str, int]] = [{}]   # piece trie
        self.piece: list[str | None] = [None]
        for piece in pieces.score:
            node = 0
            for char in piece:
                nxt = self.child[node].get(char)
                if nxt is None:
                    nxt = self.child[node][char] = len(self.child)
                    self.child.append({})
                    self.piece.append(None)
                node = nxt
            self.piece[node] = piece
        self.words, self.bare = _Words(), _Words()
        self.words.machine = self.bare.machine = self
        self.words.before, self.bare.before = SPACE, ""
        self.words.old, self.bare.old = {}, {}
        self._reset()

    def _reset(self) -> None:
        self.states: dict = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.root = self._state(START, "")

    def _state(self, live, last) -> _State:
        key = (live, last)
        state = self.states.get(key)
        if state is None:
            state = self.states[key] = _State()
            state.machine, state.live, state.last = self, live, last
        return state

    def bpe(self, text: str) -> list[str]:
        """Plain merging, best score first, leftmost on ties; for short texts."""
        score = self.p.score
        parts = list(text)
        pairs = [score.get(text[k:k + 2]) for k in range(len(text) - 1)]
        while True:
            best, at = None, -1
            for k, s in enumerate(pairs):
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if at < 0:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del pairs[at]
            if at:
                pairs[at - 1] = score.get(parts[at - 1] + parts[at])
            if at < len(pairs):
                pairs[at] = score.get(parts[at] + parts[at + 1])

    def _follows(self, left: str | None, piece: str) -> bool:
        if left is None:
            key, want = piece, [piece]
        else:
            key, want = (left, piece), [left, piece]
        ok = self.pairs.get(key)
        if ok is None:
            ok = self.pairs[key] = self.bpe((left or "") + piece) == want
        return ok

    def arc(self, state: _State, char: str):
        child, pieces = self.child, self.piece
        first = child[0].get(char)
        live = state.live
        if state.last and state.last + char not in self.p.bigrams:
            live = START                          # hard boundary: forget the past
        if first is None or pieces[first] is None:
            return self._state(START, ""), live[-1] + len(char.encode())   # byte fallback
        token, count, grown = None, 0, []
        for k in range(0, len(live), 3):
            node = child[live[k]].get(char)
            if node is None:
                continue
            piece = pieces[node]
            if token is None and piece is not None and self._follows(live[k + 1], piece):
                token, count = piece, live[k + 2] + 1
            if child[node]:
                grown.append((node, live[k + 1], live[k + 2]))
        flat = []
        for node, left, rel in grown:
            flat += (node, left, rel - count)
        return self._state((*flat, 0, token, 0), char), count

    def run(self, text: str) -> int:
        """Tokens emitted over ``text`` from the root, character by character."""
        if len(self.states) > MAX_STATES:
            self._reset()
        state, n = self.root, 0
        for char in text:
            state, d = state[char]
            n += d
        return n

    def count(self, text: str) -> int:
        """Tokens of ``text`` (already normalised) read from a boundary on."""
        if not self.p.spaced or "\n" in self.p.score:
            return self.run(text)
        lines = text.split("\n")                  # a line end is one byte piece
        n = len(lines) - 1
        for line in lines:
            first, *words = line.split(SPACE)
            n += self.bare[first] if first else 0
            if "" in words:                       # runs of spaces keep together
                n += sum(self.words[w[1:]] for w in SPACED.findall(line))
            else:
                n += sum(map(self.words.__getitem__, words))
        return n

    def chunk_map(self, text: str) -> tuple[str, int, str, bool]:
        """(text before the first boundary, tokens between, text after the last
        boundary, whether there is one)."""
        inside = self.p.bigrams
        first = next((k for k in range(1, len(text)) if text[k - 1:k + 1] not in inside), 0)
        if not first:
            return text, 0, "", False
        last = next(k for k in range(len(text) - 1, 0, -1) if text[k - 1:k + 1] not in inside)
        return text[:first], self.count(text[first:last]), text[last:], True

    def compose(self, a, b):
        """The map of two neighbouring chunks from their own maps."""
        if not a[3]:
            return (a[0] + b[0], *b[1:])
        if not b[3]:
            return a[0], a[1], a[2] + b[0], True
        return a[0], a[1] + self.count(a[2] + b[0]) + b[1], b[2], True

    def compose_all(self, maps: list) -> tuple[str, int, str, bool]:
        while len(maps) > 1:
            pairs = [self.compose(maps[k], maps[k + 1]) for k in range(0, len(maps) - 1, 2)]
            maps = pairs + maps[len(pairs) * 2:]
        return maps[0]

    def total(self, m) -> int:
        """Tokens of a whole text from its composed map."""
        return self.count(m[0]) + m[1] + self.count(m[2])


_KEPT: dict = {}


def transducer(model: bytes) -> Transducer:
    """One per Python worker and model: workers serve many tasks."""
    if model not in _KEPT:
        _KEPT.clear()
        _KEPT[model] = Transducer(PieceTable(model))
    return _KEPT[model]


MAPS = ("part int, row long, chunk int, doc_id long, n_bytes long, head string, count long, "
        "tail string, cut boolean")
BLOCK = 64              # chunk maps combined before one is shuffled


def token_counts(docs: DataFrame, limit: int = 4096, model_path: str | None = None,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row.

    Two stages: texts to chunk maps (combined over blocks of ``BLOCK`` chunks),
    then each row's maps, sorted, composed in order. Rows are told apart by the
    task and position they were read from, so repeated rows and ids stay apart.
    NULL or empty text: 0 tokens. What is shuffled per block is two text
    fragments (usually one word each) and a number. A text without any boundary
    is one fragment, as long as the text itself."""
    model = model_bytes(model_path)

    def to_maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        t, part, row = transducer(model), TaskContext.get().partitionId(), 0
        for batch in batches:
            rows = []
            for doc_id, text, size in zip(*(c.to_pylist() for c in batch.columns)):
                text = normalized(text)
                step = CHUNK * BLOCK
                for k, at in enumerate(range(0, max(len(text), 1), step)):
                    m = t.compose_all([t.chunk_map(text[c:c + CHUNK]) for c in range(
                        at, min(at + step, max(len(text), 1)), CHUNK)])
                    rows.append((part, row, k, doc_id, size, *m))
                row += 1
            yield _batch(rows, ("part", "row", "chunk", "doc_id", "n_bytes", "head", "count",
                                "tail", "cut"),
                         (pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string(),
                          pa.int64(), pa.string(), pa.bool_()))

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, key, ids, maps = transducer(model), None, None, []

        def done():
            return (*ids, t.total(t.compose_all(maps)))

        for batch in batches:
            rows = []
            for part, row, _, doc_id, size, *m in zip(*(c.to_pylist() for c in batch.columns)):
                if (part, row) != key:
                    if maps:
                        rows.append(done())
                    key, ids, maps = (part, row), (doc_id, size), []
                maps.append(tuple(m))
            yield _batch(rows, ("doc_id", "n_bytes", "n_tokens"), (pa.int64(),) * 3)
        if maps:
            yield _batch([done()], ("doc_id", "n_bytes", "n_tokens"), (pa.int64(),) * 3)

    text = text_of(docs, text_col)
    maps = docs.select(docs[id_col].cast("long").alias("doc_id"), text.alias("text"),
                       F.octet_length(text).cast("long").alias("n_bytes"))
    maps = maps.mapInArrow(to_maps, MAPS)
    counts = (maps.repartition("part", "row").sortWithinPartitions("part", "row", "chunk")
              .mapInArrow(compose, "doc_id long, n_bytes long, n_tokens long"))
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)


def _batch(rows, names, types) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=list(names))


__all__ = ["PieceTable", "Transducer", "token_counts", "model_bytes", "normalized", "transducer"]
