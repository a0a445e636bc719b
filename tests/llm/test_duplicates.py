"""Joins, substring dedup and fingerprints against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from medley.llm import iblt_fingerprint, ngram_join, substring_dedup
from tests.llm.helpers import words


def word_list(text, lower=False):
    b = (text or "").encode()
    return (b.lower() if lower else b).split()


def near_copies(seed=0, families=6):
    """Families of texts around the similarity threshold, with hubs and chains."""
    rng, out = random.Random(seed), []
    for _ in range(families):
        base = words(rng, rng.randint(12, 60))
        for _ in range(rng.randint(1, 9)):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = "z" + str(rng.randrange(50))
            out.append(" ".join(copy + words(rng, rng.randint(0, 3))))
            if rng.random() < 0.3:
                base = copy                          # drift: chains of links
    line = " ".join(words(rng, 30))
    out += [line + " " + " ".join(words(rng, rng.randint(3, 14))) for _ in range(25)]
    rng.shuffle(out)
    return out


def brute_components(rows):
    sets = {}
    for k, (_, text) in enumerate(rows):
        w = word_list(text, lower=True)
        sets[k] = frozenset(tuple(w[j:j + 5]) for j in range(len(w) - 4)) if len(w) >= 5 else frozenset(
            [tuple(w)] if w else [])
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= 75 * len(sets[a] | sets[b]):
                    up[root(a)] = root(b)
    members = defaultdict(list)
    for k in range(len(rows)):
        members[root(k)].append(rows[k][0])
    least = {r: min((x for x in m if x is not None), default=None) for r, m in members.items()}
    return Counter((rows[k][0], len(sets[k]), least[root(k)] if sets[k] else rows[k][0])
                   for k in range(len(rows)))


@pytest.mark.parametrize("frequent,group", [(2, 4096), (5, 3), (10**9, 2)])
def test_components_equal_all_pairs(spark, monkeypatch, frequent, group):
    monkeypatch.setattr(ngram_join, "FREQUENT", frequent)
    monkeypatch.setattr(ngram_join, "GROUP", group)
    rows = list(enumerate(near_copies(frequent % 97)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.join_components(df).collect())
    assert got == brute_components(rows)


def test_no_whole_sets_are_written_and_an_idle_round_is_the_last(spark, monkeypatch):
    seen, write = [], ngram_join.written
    monkeypatch.setattr(ngram_join, "FREQUENT", 10**9)
    monkeypatch.setattr(ngram_join, "written",
                        lambda spark, df, name: seen.append((name, df.columns)) or write(spark, df, name))
    rng = random.Random(8)
    line = words(rng, 24)                            # signatures that no link goes with
    texts = [" ".join(line + words(rng, 40)) for _ in range(12)]
    rows = list(enumerate(texts + [texts[0] + " end", texts[5]]))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.join_components(df).collect())
    assert got == brute_components(rows)
    assert not [name for name, columns in seen if "tokens" in columns]
    assert [name for name, _ in seen].count("links") == 2


def test_components_of_odd_rows(docs, rows):
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.join_components(docs).collect())
    assert got == brute_components([r[:2] for r in rows])


def test_similar_sets_always_share_a_signature():
    rng = np.random.default_rng(3)
    for _ in range(4000):
        pool = np.unique(rng.integers(0, 2**63, 200).astype(np.uint64))
        often = rng.permutation(pool)[:rng.integers(0, 200)]
        frequent = ngram_join.Frequent(often, rng.integers(8, 99, len(often)))
        n = int(rng.integers(2, 90))
        x = rng.permutation(pool)[:n]
        y = x.copy()
        for _ in range(int(rng.integers(0, n // 4 + 1))):
            y[rng.integers(0, n)] = rng.integers(0, 2**63)
        y = y[:max(1, n - int(rng.integers(0, n // 5 + 1)))]
        x, y = np.unique(x), np.unique(y)
        both = len(np.intersect1d(x, y))
        if 100 * both >= 75 * len(np.union1d(x, y)) and len(x) + len(y) != 2 * both:
            x, y = sorted((x, y), key=len)
            small, short = ngram_join.signatures(x, frequent)
            large, _ = ngram_join.signatures(y, frequent)
            assert np.intersect1d(small[short], large).size


@pytest.mark.parametrize("num", [20, 40, 50, 60, 90])
def test_similar_sets_share_a_signature_at_other_thresholds(num):
    assert ngram_join.sizes(75, 100) == (ngram_join.SMALL, ngram_join.SMALLEST)
    rng, seen = np.random.default_rng(num), 0
    for _ in range(3000):
        pool = np.unique(rng.integers(0, 2**63, 300).astype(np.uint64))
        often = pool if rng.random() < 0.5 else rng.permutation(pool)[:rng.integers(0, 300)]
        frequent = ngram_join.Frequent(often, rng.integers(8, 99, len(often)))
        order, n = rng.permutation(pool), int(rng.integers(1, 140))
        both = -(-n * num // 100)                    # y: a part of x, or as far from it as a link may be
        more = both * 100 // num - n if rng.random() < 0.5 else 0
        x, y = np.sort(order[:n]), np.sort(np.concatenate([order[:both], order[n:n + more]]))
        both = len(np.intersect1d(x, y))
        if 100 * both >= num * len(np.union1d(x, y)) and len(x) + len(y) != 2 * both:
            seen += 1
            x, y = sorted((x, y), key=len)
            small, short = ngram_join.signatures(x, frequent, num, 100)
            large, _ = ngram_join.signatures(y, frequent, num, 100)
            assert np.intersect1d(small[short], large).size
    assert seen > 500


def test_components_at_a_lower_threshold(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "FREQUENT", 2)
    rng, texts = random.Random(5), ["a b c d e", "a b c d e f"]      # sets of 1 and 2
    for k in range(25):
        base = words(rng, 40 + 2 * k)
        texts += [" ".join(base), " ".join(base[:len(base) * 6 // 10])]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.component_id for r in ngram_join.join_components(df, 50, 100).collect()}
    assert got == {k: k - k % 2 for k in range(len(texts))}


def test_sketches_never_rule_out_a_link():
    rng = np.random.default_rng(11)
    for n in (1, 5, 40, 300, 3000):
        for _ in range(40):
            x = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
            y = np.unique(np.concatenate([x[rng.random(len(x)) < 0.9], rng.integers(0, 2**63, n // 5).astype(np.uint64)]))
            if len(y):
                assert ngram_join.most_shared(ngram_join.sketch(x), ngram_join.sketch(y)) >= len(np.intersect1d(x, y))
                a, b = (np.frombuffer(ngram_join.parity(z), np.uint8) for z in (x, y))
                assert int(np.bitwise_count(a ^ b).sum()) <= len(np.setxor1d(x, y))


def test_keep_one_of_each_group(docs, rows):
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    want = Counter(c for c, in {(k[2],) for k in brute_components([r[:2] for r in rows]) if k[1]})
    got = Counter(r.doc_id for r in kept.collect() if (r.text or "").split())
    assert got == want
    blank = [r for r in rows if not word_list(r[1])]
    assert kept.filter(~F.coalesce("text", F.lit("")).rlike(r"[^\x20\x09-\x0D]")).count() == len(blank)


def test_component_labels(spark):
    rng = random.Random(8)
    edges = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [
        (rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.label for r in ngram_join.components(spark, df).collect()}
    assert all(got[k] == 0 for k in range(41)) and all(got[100 + k] == 100 for k in range(30))
    for a, b in edges:
        assert got[a] == got[b] <= min(a, b)


def brute_repeats(texts):
    all_words = [word_list(t) for t in texts]
    seen = Counter(tuple(w[j:j + 35]) for w in all_words for j in range(len(w) - 34))
    out = []
    for w in all_words:
        hit = [False] * len(w)
        for j in range(len(w) - 34):
            if seen[tuple(w[j:j + 35])] > 1:
                hit[j:j + 35] = [True] * 35
        left = b" ".join(x for x, h in zip(w, hit) if not h)
        out.append((len(w), sum(hit), hashlib.sha256(left).hexdigest(), left.decode()))
    return out


@pytest.mark.parametrize("shard", [512, 1])
def test_repeated_windows_equal_brute_force(spark, docs, rows, monkeypatch, shard):
    monkeypatch.setattr(substring_dedup, "SHARD", shard)
    rng = random.Random(6)
    passage, few = words(rng, 90), words(rng, 3)
    texts = [r[1] for r in rows]
    for k in range(10):
        a = rng.randrange(40)
        texts.append(" ".join(words(rng, k) + passage[a:a + rng.randint(33, 50)] + words(rng, 5)))
    texts += [" ".join(few * 40), " ".join(few * 13), " ".join(passage + ["x"] + passage)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = substring_dedup.dedup(df, keep_text=True).collect()
    want = brute_repeats(texts)
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256, r.text) for r in got if r.n_removed) == Counter(
        (k, *w) for k, w in enumerate(want) if w[1])
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == {
        k: w[:3] for k, w in enumerate(want)}


def test_suffix_automaton_counts_windows():
    rng = random.Random(9)
    for _ in range(200):
        strings = [[rng.randrange(3) for _ in range(rng.randint(1, 14))] for _ in range(rng.randint(1, 5))]
        times = [rng.randint(1, 3) for _ in strings]
        a = substring_dedup.SuffixAutomaton()
        for s, n in zip(strings, times):
            a.add(s, n)
        a.finish()
        for width in (1, 2, 4):
            seen = Counter()
            for s, n in zip(strings, times):
                for j in range(len(s) - width + 1):
                    seen[tuple(s[j:j + width])] += n
            probe = [rng.randrange(4) for _ in range(12)]
            assert a.windows(probe, width) == [seen[tuple(probe[j:j + width])] for j in range(13 - width)]


def test_rows_alike_in_id_and_text_repeat(spark):
    text = " ".join(words(random.Random(1), 50))
    df = spark.createDataFrame([(1, text), (1, text), (None, text[:5])], "doc_id long, text string")
    assert sorted(r.n_removed for r in substring_dedup.dedup(df).collect()) == [0, 50, 50]


def test_rows_alike_cost_no_more_than_rows_of_their_own(spark):
    """N rows alike in id and text: each carries its spans once, not N times."""
    import time
    text = " ".join(words(random.Random(3), 300))
    took = {}
    for name, ids in (("warm", range(600)), ("own", range(600)), ("alike", [7] * 600)):
        df = spark.createDataFrame([(k, text) for k in ids], "doc_id long, text string").repartition(4)
        start = time.perf_counter()
        out = substring_dedup.dedup(df).select("n_words", "n_removed").distinct().collect()
        took[name] = time.perf_counter() - start
        assert [tuple(r) for r in out] == [(300, 300)]
    assert took["alike"] < 2 * took["own"] + 2, took


def test_fingerprints_equal_set_arithmetic(docs, rows):
    got = sorted((r for r in iblt_fingerprint.fingerprint(docs).collect()),
                 key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    texts = [(r[0], r[1] or "") for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))]

    def like(a, b):
        a, b = set(iblt_fingerprint.digests(a).tolist()), set(iblt_fingerprint.digests(b).tolist())
        return len(a & b) / len(a | b) if a | b else 1.0
    prints = defaultdict(set)
    assert len(got) == len(texts)
    for k, ((doc_id, text), r) in enumerate(zip(texts, got)):
        following = texts[(k + 1) % len(texts)][1]
        q = len(text) // 4
        new = text[:len(text) - q] + following[:q]
        assert (r.doc_id, r.n_chars) == (doc_id, len(text))
        assert r.edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
        assert abs(r.near_edited - like(text, new)) < 1e-12 and abs(r.near_next - like(text, following)) < 1e-12
        prints[text].add(r.fingerprint)
    assert all(len(p) == 1 for p in prints.values())


def test_peeling_recovers_or_grows():
    rng = np.random.default_rng(1)
    with np.errstate(over="ignore"):
        for n in (0, 1, 5, 40, 700):
            a = np.unique(rng.integers(0, 2**63, n + 3).astype(np.uint64))
            b = np.unique(np.concatenate([a[: len(a) // 2], rng.integers(0, 2**63, n).astype(np.uint64)]))
            want = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            assert iblt_fingerprint.likeness([a], [b])[0] == pytest.approx(want)


def test_stored_fingerprints_subtract_or_fail():
    rng, whole = np.random.default_rng(2), 0
    with np.errstate(over="ignore"):
        for n in (0, 1, 2, 3, 30, 40):
            for _ in range(20):
                shared = rng.integers(0, 2**64, 80000 if n == 1 else 50, dtype=np.uint64)
                a, b = (np.unique(np.concatenate([shared, rng.integers(0, 2**64, k, dtype=np.uint64)])) for k in (n, n // 2))
                left, right = (iblt_fingerprint.fingerprints([x], iblt_fingerprint.sketch([x], iblt_fingerprint.CELLS))[0]
                               for x in (a, b))
                got = iblt_fingerprint.subtract(left, right)
                if n < 2 or got is not None:
                    assert got[0] == set(np.setdiff1d(a, b).tolist()) and got[1] == set(np.setdiff1d(b, a).tolist())
                    assert got[2] == pytest.approx(len(np.intersect1d(a, b)) / len(np.union1d(a, b)))
                    whole += 1
                assert n < 30 or got is None
    assert whole > 60


def test_single_and_empty_tables(spark, none):
    one = spark.createDataFrame([(3, "only one line here")], "doc_id long, text string")
    r = iblt_fingerprint.fingerprint(one).collect()
    assert len(r) == 1 and r[0].near_next == 1.0
    assert iblt_fingerprint.fingerprint(none).count() == 0
    assert substring_dedup.dedup(none).count() == 0
    assert ngram_join.join_components(none).count() == 0
    assert ngram_join.keep_one(none).count() == 0
