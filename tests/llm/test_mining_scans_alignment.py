"""Hard negatives, license scans and tokenizer alignment against brute force."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from medley.llm import hard_negatives, licenses, token_alignment
from medley.llm.hard_negatives import Lists
from medley.llm.licenses import Template

VECTORS = "vec_id long, embedding array<float>, label int, uid string, q int, g int, rank int"


# ---- hard negatives ---------------------------------------------------------

def mined(rows, every=50, k=5, n=3):
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in v], y) for i, v, y in rows
            if i is not None and v is not None and y is not None
            and all(x is not None and math.isfinite(x) for x in v)]
    out = Counter()
    for at, (i, v, y) in enumerate(kept):
        if i % every:
            continue
        others = [(-sum(a * b for a, b in zip(v, w)), j, z) for p, (j, w, z) in enumerate(kept) if p != at]
        best = sorted((s, j) for s, j, z in others if z == y)[:k]
        for s, j in best:
            fit = sorted((t, m) for t, m, z in others if z != y and 50 * -s <= 100 * -t <= 95 * -s)[:n]
            out.update((i, j, r + 1, m, -s, -t) for r, (t, m) in enumerate(fit))
    return out


def vectors(rng, n, d=6, labels=3, lumps=1):
    return [(rng.randrange(n * 2), [round(rng.uniform(-1, 1) * lumps) / lumps for _ in range(d)],
             rng.randrange(labels)) for _ in range(n)]


def as_table(spark, rows):
    return spark.createDataFrame([r + ("x", 1, 1, 1) for r in rows], VECTORS).repartition(3)


def result(df):
    return Counter(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id",
                                               "positive_score", "negative_score").collect())


@pytest.mark.parametrize("lumps", [1, 2, 1000])
def test_mining_equals_brute_force(spark, monkeypatch, lumps):
    """Many ties (lumps of 1), several blocks, rows that take no part, repeated rows."""
    rng = random.Random(lumps)
    rows = vectors(rng, 150, lumps=lumps)
    rows += rows[:20] + [(None, [1.0] * 6, 1), (50, None, 1), (100, [1.0] * 6, None),
                         (150, [1.0, None] + [0.0] * 4, 1), (200, [float("nan")] + [0.0] * 5, 1),
                         (250, [float("inf")] + [0.0] * 5, 2), (300, [0.0] * 6, 1), (350, [], 2),
                         (400, [1.0, 1.0], 0), (-50, [0.5] * 6, 0)]
    monkeypatch.setattr(hard_negatives, "BLOCK", 40)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 3)
    got = result(hard_negatives.mine(as_table(spark, rows), every=10))
    assert got == mined(rows, every=10) and got


def test_one_vector_of_a_third_of_all_rows(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK", 64)
    rng = random.Random(3)
    rows = vectors(rng, 200, lumps=50) + [(k, [0.5, -0.25, 1.0, 0.0, 0.75, -1.0], 1) for k in range(1000, 1100)]
    assert result(hard_negatives.mine(as_table(spark, rows), every=25)) == mined(rows, every=25)


def test_threshold_stops_early_and_exactly():
    """One strong dimension: the lists need not be read to their ends."""
    rng = np.random.default_rng(1)
    x = rng.integers(-5, 6, (4000, 8))
    x[:, 0] = rng.permutation(4000)
    lists, seen = Lists(x, np.arange(4000)), []
    inner = lists._scored
    lists._scored = lambda a: (lambda v, t: (_Counting(v, seen), t))(*inner(a))
    anchor = np.array([100, 1, -1, 0, 0, 0, 0, 0])
    (places, scores), = lists.search(anchor, np.ones(4000, bool), [(-2**62, 2**62)], 5)
    want = sorted(((-int(v @ anchor), k) for k, v in enumerate(x)))[:5]
    assert [(-int(s), int(p)) for p, s in zip(places, scores)] == want
    assert sum(seen) < 600


class _Counting:
    def __init__(self, vectors, seen):
        self.vectors, self.seen = vectors, seen

    def __getitem__(self, at):
        self.seen.append(len(at))
        return self.vectors[at]


@pytest.mark.parametrize("size", [10, 40_000, 4_000_000])
def test_scores_are_exact_for_large_components(size):
    rng = np.random.default_rng(size)
    x, a = rng.integers(-size, size, (300, 64)), rng.integers(-size, size, 64)
    (places, scores), = Lists(x, np.arange(300)).search(a, np.ones(300, bool), [(-2**62, 2**62)], 300)
    assert scores.tolist() == sorted((x.astype(object) @ a.astype(object)).tolist(), reverse=True)
    assert (x[places] @ a).tolist() == scores.tolist()


def test_noisy_labels_and_empty_vectors(spark):
    df = spark.createDataFrame([(7, 9), (8, 9), (14, None), (None, 3), (21, 2**31 - 1)], "vec_id long, label int")
    got = {r.vec_id: r.label for r in hard_negatives.noisy_labels(df).collect()}
    assert got == {7: 0, 8: 9, 14: None, None: 3, 21: 8}
    assert hard_negatives.mine(as_table(spark, [])).count() == 0
    assert hard_negatives.mine(as_table(spark, [(1, [1.0], 1), (2, [1.0], 2)])).count() == 0


# ---- license scans ----------------------------------------------------------

NOTICES = [
    "Released under the MIT License.", "released UNDER the\nMit-License", "licensed under CC BY-NC 4.0",
    "Licensed under the Apache License, Version 2.0. Apache License!", "cc by cc by cc\tby", "mit licenses, mit_license",
    "This program is free software; you can redistribute it and or modify it under terms of the GNU General "
    "Public License published by the Free Software Foundation",
    "under the terms of the GNU Lesser General Public License as published by Free Software",
    "Redistributions of source code must retain the copyright notice this list of conditions and following disclaimer",
    "GNU general ünder public license", "gnu 通用 general public license gnu general public license",
    "apache license", "the the the license license under released mit", "MITLicense", "cc--by"]


def license_rows(rng, rows):
    filler = [w for r in rows if r[1] for w in r[1].split()[:50]]
    texts = [r[1] for r in rows] + NOTICES
    for n in NOTICES:
        for _ in range(4):
            words = n.split(" ")
            for _ in range(rng.randrange(3)):
                words.insert(rng.randrange(len(words) + 1), rng.choice(filler + ["the", "license", "of"]))
            texts.append(" ".join(rng.choices(filler, k=rng.randrange(40)) + words + rng.choices(filler, k=9)))
    return texts


def scanned(text, templates, percent):
    words = [w for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+",
                                   re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))]
    starts, base = [], set()
    for p in licenses.PHRASES:
        parts = p.text.split()
        at = [i for i in range(len(words)) if words[i:i + len(parts)] == parts]
        starts += at
        base |= {p.label} if at else set()
    labels, most = set(base), 0.0
    for t in templates:
        want = set(t.words)
        for s in range(0, len(words), t.step):
            both = len(want & set(words[s:s + 2 * t.step]))
            if 100 * both >= percent * len(want):
                labels.add(t.label)
                most = max(most, both / len(want))
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None),
            ",".join(sorted(base)), ",".join(sorted(labels)), 1.0 if starts else most)


@pytest.mark.parametrize("percent", [90, 60, 100])
def test_license_report_equals_brute_force(spark, rows, percent):
    texts = license_rows(random.Random(percent), rows)
    df = spark.createDataFrame([(k, t, "d", 1, "w") for k, t in enumerate(texts)],
                               "doc_id long, text string, digest string, template int, word string").repartition(4)
    got = {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score)
           for r in licenses.license_report(df, percent=percent).collect()}
    want = {k: scanned(t, licenses.TEMPLATES, percent) for k, t in enumerate(texts)}
    assert got == want
    assert {"mit", "cc-by", "gpl", "apache"} <= {x for v in want.values() for x in v[5].split(",")}


def test_notices_in_one_piece_are_always_inside_one_block():
    for t in licenses.TEMPLATES:
        assert t.step >= len(t.words) and t.step & (t.step - 1) == 0
        for at in range(3 * t.step):
            assert any(s <= at and at + len(t.words) <= s + 2 * t.step for s in range(0, at + 1, t.step))


def test_blocks_keep_their_words(spark):
    df = spark.createDataFrame([(1, "x y " * 20 + "Released, under the MIT\nLicense z"), (2, "nothing here"),
                                (3, None)], "doc_id long, text string")
    found = licenses.find_blocks(df).collect()
    assert {r.label for r in found} == {"mit"}
    assert all("released under the mit license" in r.block and r.overlap == r["size"] == 5 for r in found)
    assert all(r.first_word % 8 == 0 and r.n_words <= 16 for r in found)
    assert licenses.find_blocks(df, templates=[]).count() == 0
    assert licenses.find_blocks(df, templates=[Template("none", " ,; ")]).count() == 0


def test_license_rows_repeat_and_empty_tables(docs, rows, none):
    got = licenses.license_report(docs).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    assert licenses.license_report(none).count() == 0


def test_license_scan_has_no_python_and_shuffles_no_text(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = licenses.license_report(df)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|ExistingRDD", plan)
    order = [w for t in licenses.TEMPLATES for w in t.words]
    assert set(licenses.word_order(df, order)) == set(order)


# ---- cross-tokenizer alignment ----------------------------------------------

@pytest.fixture(scope="module")
def files():
    return token_alignment.json_bytes(), token_alignment.model_bytes()


def aligned(t, text):
    """Every pair of tokens against every other."""
    a, b = next(t.encode([text or ""]))
    ends_a = np.cumsum([t.a_len[i] for i in a]).tolist()
    ends_b = np.cumsum([t.b_len[i] for i in b]).tolist()
    links = [(x, y) for x, e in zip(a, ends_a) for y, f in zip(b, ends_b) if e == f]
    groups, i, j = [], 0, 0
    for e in sorted(set(ends_a) & set(ends_b)):
        p, q = ends_a.index(e) + 1, ends_b.index(e) + 1
        groups.append(",".join(map(str, a[i:p])) + "|" + ",".join(map(str, b[j:q])))
        i, j = p, q
    return a, b, groups, links


TRICKY = ["a", " ", "   ", "\n", "tab\t\tand\r\n", "naïve café ﬁ ½", "你好，世界 𠀀𠀀", "<s>x</s> <unk> <0x0A>",
          "<|endoftext|> and <|endoftext|>", "▁mark", "a ▁ b", "\u0000nul", "x" * 5000, "don't 12345 --- ====",
          "é́", " nbsp　wide", "🙂🙂 👩‍👩‍👧", "ÀÈ" * 30]


def test_alignment_equals_brute_force(spark, rows, files):
    texts = [r[1] for r in rows if not r[1] or len(r[1]) < 9500] + TRICKY + TRICKY[:3]
    t = token_alignment.Aligner(*files)
    df = spark.createDataFrame([(k, x, 1, "p") for k, x in enumerate(texts)],
                               "doc_id long, text string, links int, pair string").repartition(4)
    got = {r.doc_id: r for r in token_alignment.alignment_report(df).collect()}
    want = [aligned(t, x) for x in texts]
    counts = Counter(p for w in want for p in w[3])
    top = {}
    for (_, b), n in counts.items():
        top[b] = max(top.get(b, 0), n)
    assert len(got) == len(texts)
    for k, (a, b, groups, links) in enumerate(want):
        r = got[k]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links) == (len(a), len(b), len(groups), len(links))
        assert r.n_best == sum(counts[p] == top[p[1]] for p in links)
        assert r.count_sum == sum(counts[p] for p in links)
        assert r.groups_sha256 == (hashlib.sha256(";".join(groups).encode()).hexdigest() if a else "")
    zero = {x for x, w in zip(texts, want) if not w[0]}
    assert zero >= {None, "", "▁mark", "a ▁ b"} and "<s>x</s> <unk> <0x0A>" not in zero


def test_reused_segments_change_nothing(files, monkeypatch):
    """Texts put together from segments equal texts tokenized whole; small memory too."""
    t, rng = token_alignment.Aligner(*files), random.Random(12)
    parts = ["word", "Mr", "it's", "é", "naïve", "e.g", "x", "1", "20", ".", ",", "!?", "...", "'s", "(", "\t", "\n", "\n\n",
             " ", "  ", "▁", "你好", "\u00ad", "\u00a0", "<|endoftext|>", "<s>", "don't", "St.", "U.S.", "etc.,", "-", "end."]
    for limit in (150_000, 3):
        monkeypatch.setattr(token_alignment, "MAX_KEPT", limit)
        for _ in range(150):
            texts = ["".join(rng.choice(parts) + rng.choice(["", " ", " ", "\n"]) for _ in range(rng.randrange(14)))
                     for _ in range(20)]
            for text, got, (a, b) in zip(texts, t.linked(texts), t.encode(texts)):
                assert got == t.entry(a, b), repr(text)


def test_ids_are_the_libraries(files):
    import sentencepiece
    from tokenizers import Tokenizer
    t = token_alignment.Aligner(*files)
    a = Tokenizer.from_buffer(files[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_proto=files[1])
    for text in TRICKY:
        got = next(t.encode([text]))
        assert got == ([], []) or got == (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text))
        if got[0]:
            assert b"".join(t.a_bytes[i] for i in got[0]) == (" " + text).encode()


def test_linked_pairs_are_suffixes_and_bounded(spark, files, rows):
    t = token_alignment.Aligner(*files)
    df = spark.createDataFrame([(k, r[1]) for k, r in enumerate(rows)], "doc_id long, text string")
    pairs = token_alignment.pair_counts(token_alignment.linked(df)).collect()
    assert 0 < len(pairs) <= t.most_pairs
    for r in pairs:
        a, b = t.a_bytes[r.pair >> 32], t.b_bytes[r.pair & 0xFFFFFFFF]
        assert a.endswith(b) or b.endswith(a)
    with pytest.raises(ValueError):
        token_alignment.pair_scores(token_alignment.linked(df), 3)


def test_align_keeps_ids_and_offsets(docs, rows, files):
    t = token_alignment.Aligner(*files)
    got = token_alignment.align(docs).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    by = {r[0]: r[1] for r in rows}
    for r in got:
        raw = (" " + (by[r.doc_id] or "")).encode()
        at = 0
        for end, i, j in zip(r.byte_ends, r.a_ends, r.b_ends):
            assert b"".join(t.a_bytes[x] for x in r.a_ids[:i]) == raw[:end]
            assert b"".join(t.b_bytes[x] for x in r.b_ids[:j]) == raw[:end]
            assert end > at
            at = end
        assert at in (0, len(raw))


def test_alignment_of_empty_tables_and_long_texts(spark, none, monkeypatch):
    assert token_alignment.alignment_report(none).count() == 0
    assert token_alignment.align(none).count() == 0
    monkeypatch.setattr(token_alignment, "SLICE", 50)
    df = spark.createDataFrame([(k, "some words " * (k % 30)) for k in range(90)], "doc_id long, text string")
    small = token_alignment.alignment_report(df).orderBy("doc_id").collect()
    monkeypatch.undo()
    assert small == token_alignment.alignment_report(df).orderBy("doc_id").collect()
    long = spark.createDataFrame([(1, "x" * 2_000_000), (2, "word " * 300_000)], "doc_id long, text string")
    assert all(r.n_a > 0 and r.n_b > 0 for r in token_alignment.alignment_report(long).collect())
    assert token_alignment.linked(long).filter(F.size("links") != F.col("n_links")).count() == 0
