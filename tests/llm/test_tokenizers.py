"""Token counts and piece segmentation against the library and enumeration."""

import random

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from medley.llm import bpe_transducer, piece_lattice
from medley.llm.bpe_transducer import SPACE, PieceTable, Transducer, model_bytes, normalized

ALPHABET = ["a", "th", "in", "ing", " ", "  ", "     ", "\n", "\t", "é", "你", "𠀀", "-", "----", "1", "20",
            SPACE, "<s>", "<0x0A>", "\u0000", "tion", "ß", "=", "AKIA"]


@pytest.fixture(scope="module")
def model():
    return model_bytes()


@pytest.fixture(scope="module")
def library(model):
    return sentencepiece.SentencePieceProcessor(model_proto=model)


def test_transducer_equals_library(model, library):
    t, rng = Transducer(PieceTable(model)), random.Random(7)
    for _ in range(4000):
        text = "".join(rng.choices(ALPHABET, k=rng.randint(0, 30)))
        z, step = normalized(text), rng.choice([1, 2, 5, 1000])
        maps = [t.chunk_map(z[k:k + step]) for k in range(0, max(len(z), 1), step)]
        assert t.total(t.compose_all(maps)) == len(library.encode(text)), repr(text)


def test_state_maps_compose_associatively(model):
    t, rng = Transducer(PieceTable(model)), random.Random(2)
    for _ in range(300):
        a, b, c = (t.chunk_map("".join(rng.choices(ALPHABET, k=rng.randint(1, 6))).replace(" ", SPACE))
                   for _ in range(3))
        left, right = t.compose(t.compose(a, b), c), t.compose(a, t.compose(b, c))
        assert t.total(left) == t.total(right)


def test_small_tables_do_not_change_counts(model, library, monkeypatch):
    monkeypatch.setattr(bpe_transducer, "MAX_STATES", 50)
    monkeypatch.setattr(bpe_transducer, "MAX_WORDS", 5)
    t, rng = Transducer(PieceTable(model)), random.Random(3)
    for _ in range(300):
        text = "".join(rng.choices(ALPHABET, k=rng.randint(0, 40)))
        assert t.count(normalized(text)) == len(library.encode(text))


def test_token_counts_of_a_table(docs, rows, library):
    from collections import Counter
    got = bpe_transducer.token_counts(docs, limit=100).collect()
    want = Counter((r[0], len((r[1] or "").encode()), n := len(library.encode(r[1] or "")), n > 100) for r in rows)
    assert Counter(tuple(r) for r in got) == want


def test_long_text_over_many_chunks(spark, library, monkeypatch):
    monkeypatch.setattr(bpe_transducer, "CHUNK", 64)
    monkeypatch.setattr(bpe_transducer, "BLOCK", 4)
    rng = random.Random(4)
    texts = ["".join(rng.choices(ALPHABET, k=800)) for _ in range(6)] + ["q" * 3000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in bpe_transducer.token_counts(df).collect()}
    assert got == {k: len(library.encode(t)) for k, t in enumerate(texts)}


def every_path(coder, text):
    s, out = normalized(text), []

    def go(i, score, cuts):
        if i == len(s):
            out.append((score, coder._ids(s, (*cuts, len(s)))))
            return
        if s[i] not in coder.p.score:
            go(i + 1, score + coder.unknown, (*cuts, i))
        for j in range(i + 1, min(len(s), i + coder.p.longest) + 1):
            if s[i:j] in coder.p.score:
                go(j, score + coder.p.score[s[i:j]], (*cuts, i))
    go(0, 0.0, ())
    return sorted(out, key=lambda x: -x[0])


def test_n_best_equals_enumeration(model):
    coder, rng = piece_lattice.Coder(PieceTable(model)), random.Random(5)
    for _ in range(400):
        text = "".join(rng.choices(["a", "th", "in", " ", "  ", "\n", "é", "𠀀", "-", "tion", SPACE],
                                   k=rng.randint(1, 5)))
        n = rng.randint(1, 6)
        got, want = coder.encode(text, n), every_path(coder, text)
        assert [x[0] for x in got] == [x[0] for x in want[:n]]
        assert len(set(got)) == len(got) and set(got) <= set(want)


def test_encode_and_decode_a_table(docs, rows):
    coded = piece_lattice.encode(docs, n=3)
    got = coded.collect()
    assert len(got) == len(rows) and all(r.round_trip for r in got)
    assert all(len(r.ids) == r.n_pieces == r.nbest[0].n_pieces for r in got)
    assert all([x.score for x in r.nbest] == sorted((x.score for x in r.nbest), reverse=True) for r in got)
    back = {r.doc_id: r.text for r in piece_lattice.decode(coded).collect()}
    assert back == {r[0]: (r[1] or "").replace(SPACE, " ") for r in rows}
    assert all(np.isfinite(r.score) for r in got)


def test_empty_tables(none):
    assert bpe_transducer.token_counts(none).count() == 0
    assert piece_lattice.encode(none).count() == 0
    assert piece_lattice.decode(piece_lattice.encode(none)).filter(F.col("text") != "").count() == 0
