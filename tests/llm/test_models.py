"""Language model, quality rules, decontamination and the pipeline."""

import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from medley.llm import hmm_scores, quality_rules, template_decontam
from tests.llm.helpers import SF01, words


def held(doc_id, folds=5):
    return zlib.crc32(str(doc_id).encode() if doc_id is not None else b"") % folds


def test_base_scores_and_counts(docs, rows):
    got = hmm_scores.score(docs, states=3, symbols=20, lookup=40, iterations=2).collect()
    c = Counter()
    for doc_id, text, *_ in rows:
        if held(doc_id) != 1:
            c.update((text or "").encode().lower().split() + [b""])
    n, v = sum(c.values()), len(c)
    want = []
    for doc_id, text, *_ in rows:
        t = (text or "").encode().lower().split() + [b""]
        want.append((doc_id, held(doc_id) == 1, len(t), sum(c[w] > 0 for w in t), n,
                     round(sum(math.log10((c[w] + .5) / (n + .5 * (v + 1))) for w in t), 6)))
    assert Counter(want) == Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens,
                                     round(r.base_score, 6)) for r in got)
    assert all(r.score < 0 for r in got)


def small_model(states=3, size=6, seed=0):
    rng = np.random.default_rng(seed)
    start, move, emit = rng.random(states), rng.random((states, states)), rng.random((size, states))
    return hmm_scores.Model(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))


def test_forward_equals_sum_over_state_paths():
    m, rng = small_model(), np.random.default_rng(4)
    seqs = [rng.integers(0, 6, n).astype(np.uint16) for n in (1, 2, 5, 3)]
    for s, got in zip(seqs, hmm_scores.log_likelihood(m, seqs)):
        total = 0.0
        for path in itertools.product(range(3), repeat=len(s)):
            p = m.start[path[0]] * m.emit[s[0], path[0]]
            for t in range(1, len(s)):
                p *= m.move[path[t - 1], path[t]] * m.emit[s[t], path[t]]
            total += p
        assert got == pytest.approx(math.log10(total))


def test_expected_counts_equal_enumeration():
    m, rng = small_model(2, 4, 1), np.random.default_rng(5)
    runs = [rng.integers(0, 4, n).astype(np.uint16) for n in (4, 2, 1)]
    start, move, flat, gammas = hmm_scores.expected(m, runs, [True, True, True])
    want_start, want_move, want_emit = np.zeros(2), np.zeros((2, 2)), np.zeros((4, 2))
    for s in runs:
        weights = {}
        for path in itertools.product(range(2), repeat=len(s)):
            p = m.start[path[0]] * m.emit[s[0], path[0]]
            for t in range(1, len(s)):
                p *= m.move[path[t - 1], path[t]] * m.emit[s[t], path[t]]
            weights[path] = p
        total = sum(weights.values())
        for path, p in weights.items():
            want_start[path[0]] += p / total
            for t, k in enumerate(path):
                want_emit[s[t], k] += p / total
                if t:
                    want_move[path[t - 1], k] += p / total
    emit = np.stack([np.bincount(flat, gammas[:, k], 4) for k in range(2)], 1)
    assert np.allclose(start, want_start) and np.allclose(move, want_move) and np.allclose(emit, want_emit)


def test_model_beats_the_base_on_held_out_texts(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    r = hmm_scores.score(docs).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert r[0] > r[1]


def test_lm_without_training_rows(spark, none):
    assert hmm_scores.score(none).count() == 0
    k = next(k for k in range(99) if held(k) == 1)
    one = spark.createDataFrame([(k, "a b")], "doc_id long, text string")
    r = hmm_scores.score(one).first()
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (True, 3, 0, 0, 0.0)


def test_quality_on_held_out_labels(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    got = quality_rules.classify(docs, labels)
    assert got.count() == docs.count()
    seen = got.join(labels, "doc_id").filter("held_out")
    right = seen.filter("predicted = quality").count() / seen.count()
    assert right > 0.93
    kept = quality_rules.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert kept.count() == got.filter("predicted = 1").count()


def test_rules_are_the_paths_of_a_tree():
    text = ("If (feature 1 <= 0.5)\n If (feature 0 <= 2.0)\n  Predict: 0.0\n Else (feature 0 > 2.0)\n"
            "  Predict: 1.0\nElse (feature 1 > 0.5)\n Predict: 1.0\n")
    low, high = float("-inf"), float("inf")
    assert {r.bounds for r in quality_rules.paths(text)} == {
        ((1, low, 0.5),), ((0, low, 2.0), (1, low, 0.5)), ((0, 2.0, high), (1, low, 0.5)), ((1, 0.5, high),)}


def test_quality_of_odd_rows(spark, docs, none, rows):
    labels = spark.createDataFrame([(14, 1, 0), (3, 0, 1), (14, 1, 0), (999, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    got = quality_rules.classify(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (held(r.doc_id) == 0) for r in got)
    empty = labels.limit(0)
    assert quality_rules.classify(docs, empty).filter("predicted = 0").count() == 0
    assert quality_rules.classify(none, labels).count() == 0
    assert quality_rules.keep_good(docs, empty).count() == len(rows)


def statistics_by_hand(text):
    import regex
    t = text or ""
    w = [x for x in regex.split(r"[\x20\x09-\x0D]+", t) if x]
    lines = [x for x in t.split("\n") if x]
    share = lambda keep: len(regex.findall(keep, t)) / max(1, len(t))
    return {"log_chars": math.log1p(len(t)),
            "word_chars": len(regex.sub(r"[\x20\x09-\x0D]+", "", t)) / max(1, len(w)),
            "distinct_words": len(set(w)) / max(1, len(w)),
            "repeated_next": sum(a == b for a, b in zip(w, w[1:])) / max(1, len(w)),
            "upper": share(r"\p{Lu}"), "symbols": share(r"[#$%&*@~^<>{}\\=+_/\[\]]"), "bars": share(r"\|"),
            "cries": share("[!?]"), "stops": share("[.,;:]"), "digits": share("[0-9]"),
            "line_words": len(w) / max(1, len(lines)), "distinct_lines": len(set(lines)) / max(1, len(lines)),
            "spaces": share(r"[\x20\x09-\x0D]")}


def test_scores_equal_the_rules_evaluated_by_hand(spark, docs, rows, monkeypatch):
    """Statistics, conjunctions and the logistic sum, each in plain Python."""
    good = spark.read.parquet(f"{SF01}/documents.parquet")
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    ensemble = quality_rules.fit(good, labels)
    assert ensemble.weighted
    monkeypatch.setattr(quality_rules, "fit", lambda *a, **k: ensemble)
    texts = [(r.doc_id, r.text) for r in good.collect()] + [(r[0], r[1]) for r in rows]
    both = good.select("doc_id", "text").unionByName(docs.select("doc_id", "text"))
    got = Counter((r.doc_id, r.held_out, round(r.score, 9), r.predicted)
                  for r in quality_rules.classify(both, labels).collect())
    want = Counter()
    for doc_id, text in texts:
        s = statistics_by_hand(text)
        margin = ensemble.intercept + sum(weight for weight, rule in ensemble.weighted if all(
            low < s[quality_rules.NAMES[at]] <= high for at, low, high in rule.bounds))
        score = 1 / (1 + math.exp(-margin))
        want[doc_id, held(doc_id) == 0, round(score, 9), int(score >= 0.3)] += 1
    assert got == want


def test_decontamination_finds_copies_and_new_parameters(spark, none):
    rng = random.Random(4)
    item = ("a train with 12 wagons leaves the town of Arvik at 40 km per hour and meets Olsen who walks "
            "home at 5 km per hour so when do they meet")
    other = " ".join(words(rng, 30))
    bench = spark.createDataFrame([(1, item), (2, other), (3, "too short"), (4, None), (5, "six plain words in a row")],
                                  "item_id long, text string")
    changed = item.replace("12", "7").replace("40", "90").replace("Arvik", "Bergen").replace("Olsen", "Hansen")
    wrong = item.replace("40 km", "5 km").replace("12", "5")          # one value for several slots
    texts = ["x y. " + item.upper(), " ".join(words(rng, 50)) + " " + item, "So: " + changed + " " + other[:20],
             " ".join(words(rng, 80)), None, "", wrong, "Well, six plain words in a row!", other.replace(" ", "\n")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in template_decontam.report(docs, bench).collect()}
    assert len(got) == len(texts)
    assert got[1].items == [1] and got[2].items == [1] and got[7].items == [5] and got[8].items == [2]
    assert not any(got[k].contaminated for k in (3, 4, 5))
    assert got[0].contaminated
    clean = template_decontam.drop_contaminated(docs, bench)
    assert {r.doc_id for r in clean.collect()} == {k for k in got if not got[k].contaminated}
    assert template_decontam.report(docs, bench.limit(0)).filter("contaminated").count() == 0
    assert template_decontam.report(none, bench).count() == 0


def test_decontamination_drops_conflicting_windows_not_the_copy(spark):
    rng = random.Random(9)
    plain = [" ".join(words(rng, 24, ("lo", "ra", "mi", "ten", "su"))) for _ in range(3)]
    item = f"{plain[0]} saw 3 white birds {plain[1]} saw 3 brown birds {plain[2]}"
    two = "so a man with 5 red hats met one with 3 blue hats on the way"
    bench = spark.createDataFrame([(1, item), (2, two)], "item_id long, text string")
    docs = spark.createDataFrame([(1, item.replace("3 brown", "4 brown")), (2, item),
                                  (3, two.replace("5", "4").replace("3", "4")),
                                  (4, item.replace("3 brown", "4 brown").replace("3 white", "6 white"))],
                                 "doc_id long, text string")
    got = {r.doc_id: r for r in template_decontam.report(docs, bench).collect()}
    n = len(item.split()) - 7
    assert got[1].items == [1] and got[1].n_windows == n - 8       # those that hold the 4
    assert got[2].items == [1] and got[2].n_windows == n
    assert got[3].items == [2] and got[3].n_windows == len(two.split()) - 7     # values may coincide
    assert got[4].items == [1] and got[4].n_windows == n - 16


def test_decontamination_finds_copies_without_literal_words(spark):
    items = ["3 + 4 = 7 and 12 * 5 = 60 and 81 / 9 = 9", "Anna Berta Carl Dora Emil Frida Georg Hanna Ida",
             "The Old Man And The Sea By Ernest Hemingway", "forty-two", "где живёт белый медведь зимой",
             "one 2 three 4 five", "Quiet Rivers run deep below 9 old stones", "..."]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    texts = ["so here " + item + " they say" for item in items]
    texts += [items[0].replace("12", "13"), items[1].replace("Dora", "Doris"), "forty two", items[4].replace("зимой", "летом"),
              "one 3 three 4 five"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.items for r in template_decontam.report(docs, bench).collect()}
    assert [got[k] for k in range(len(items))] == [[0], [1], [2], [3], [4], [5], [6], []]
    assert got[8] == [0]                              # operators are literal words
    assert got[9] == got[10] == got[11] == got[12] == []


@pytest.mark.parametrize("share", [0.1, 0.3, 0.5, 0.7])
def test_decontamination_finds_items_with_all_parameters_changed(spark, share):
    """Every number, name and unit of each item is another one in the document."""
    rng = random.Random(int(share * 10))
    pool, units = words(rng, 400, ("lo", "ra", "mi", "ten", "su", "ke")), ["km", "kg", "hours", "ml"]

    def item():
        out = [rng.choice(pool)]
        while len(out) < rng.randrange(18, 45):
            if rng.random() < share:
                kind = rng.randrange(3)
                out += ([str(rng.randrange(2, 10**6))] if kind == 0 else [rng.choice(pool).capitalize()] if kind == 1
                        else [str(rng.randrange(2, 10**6)), rng.choice(units)])
            else:
                out.append(rng.choice(pool))
        return out

    def changed(ws):
        new, out = {}, []
        for k, w in enumerate(ws):
            if w.isdigit():
                out.append(new.setdefault(w, str(rng.randrange(10**6, 10**7))))
            elif w[0].isupper():
                out.append(new.setdefault(w, "".join(rng.choices(["Bo", "Ta", "Ni"], k=1)) + rng.choice(pool)))
            elif k and ws[k - 1].isdigit() and w in units:
                out.append(new.setdefault(w, {"km": "mi", "kg": "lb", "hours": "days", "ml": "oz"}[w]))
            else:
                out.append(w)
        return out

    items = [item() for _ in range(60)]
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string")
    texts = [" ".join(rng.choices(pool, k=9) + changed(w) + rng.choices(pool, k=9)) for w in items]
    texts += [" ".join(item()) for _ in range(60)] + [" ".join(rng.choices(pool, k=200)) for _ in range(20)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.items for r in template_decontam.report(docs, bench).collect()}
    found = sum(k in got[k] for k in range(60))
    assert found >= 54, f"recall {found / 60:.2f} at {share} of the words"
    assert not any(got[k] for k in range(60, len(texts)))


def test_decontamination_of_arithmetic(spark):
    item = "Solve 12 + 30 * 4 - 7 / 2 + 9 = x for x 5"
    new = "Solve 81 + 22 * 3 - 6 / 11 + 10 = x for x 13"
    other = "Solve 81 + 22 + 3 + 6 + 11 + 10 = y if y 13"
    bench = spark.createDataFrame([(1, item), (2, item + " and then some more words follow here")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "he said. " + new), (2, other), (3, "x" * 1_500_000), (4, "no 5 " * 300_000)],
                                 "doc_id long, text string")
    got = {r.doc_id: r.items for r in template_decontam.report(docs, bench).collect()}
    assert got == {1: [1, 2], 2: [], 3: [], 4: []}


def test_decontamination_reports_every_item_that_holds_a_window(spark):
    rng = random.Random(11)
    prompt, one, two = (" ".join(words(rng, 14, ("lo", "ra", "mi", "ten", "su"))) for _ in range(3))
    line = "so the man with 5 red hats met us at home"
    bench = spark.createDataFrame(
        [(1, prompt + " " + one), (2, prompt + " " + two), (3, two), (4, two), (5, f"{line} {line.replace('5', '6')}")],
        "item_id long, text string")
    docs = spark.createDataFrame([(1, prompt + " " + two), (2, prompt), (3, line.replace("5", "9")), (4, one)],
                                 "doc_id long, text string")
    got = {r.doc_id: r for r in template_decontam.report(docs, bench).collect()}
    assert got[1].items == [1, 2, 3, 4] and got[1].n_windows == 7 + 21 + 7 + 7
    assert got[2].items == [1, 2] and got[2].n_windows == 14
    assert got[3].items == [5] and got[3].n_windows == 4
    assert got[4].items == [1]
    found = template_decontam.matches(docs, bench).filter("item_id = 5")
    assert sorted((r.first_word, r.last_word, r.n_windows) for r in found.collect()) == [(0, 10, 4), (0, 10, 4)]


def test_planted_benchmark_passages(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    bench = spark.read.parquet(f"{SF01}/benchmark.parquet")
    items = [(r.text or "").lower().split() for r in bench.collect()]
    grams = {tuple(w[j:j + 8]) for w in items for j in range(len(w) - 7)}
    want = set()
    for r in docs.collect():
        w = (r.text or "").lower().split()
        if any(tuple(w[j:j + 8]) in grams for j in range(len(w) - 7)):
            want.add(r.doc_id)
    got = {r.doc_id for r in template_decontam.report(docs, bench).filter("contaminated").collect()}
    assert want and got == want


def test_pipeline_with_odd_rows(spark, docs, rows, none, tmp_path):
    """NULL ids and texts, empty and repeated rows, columns with clashing names, no rows."""
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(40)] + [(None, 1, 0), (3, None, None)],
                                   "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, " ".join(f"w{k}" for k in range(20))), (None, None)], "item_id long, text string")
    for name, table in (("odd", docs), ("empty", none)):
        folder = str(tmp_path / name)
        for t, df in (("documents", table), ("labels", labels), ("benchmark", bench)):
            df.write.parquet(f"{folder}/{t}.parquet")
        kept = spark.read.parquet(f"{folder}/documents.parquet")
        for stage, fn in corpus_pipeline.STAGES[:-1]:
            after = fn(spark, kept, folder)
            assert after.columns == docs.columns, stage
            path = str(tmp_path / f"{name}-{stage.split()[0]}")
            after.write.parquet(path)
            kept = spark.read.parquet(path)
            assert kept.count() <= table.count()
        out = corpus_pipeline.run(spark, folder)
        assert out.count() == kept.count()
        assert (out.count() > 0) == (name == "odd")
    texts = [r[1] for r in rows]
    assert {r.text for r in spark.read.parquet(str(tmp_path / "odd-n-gram")).select("text").collect()} <= set(texts)


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF01)
        assert after.columns == docs.columns, name
        assert 0 < after.count() <= before.count(), name
        path = str(tmp_path / name.split()[0])
        after.write.parquet(path)
        before = spark.read.parquet(path)
    assert before.filter(F.col("text").contains("[SECRET]")).count() > 0
    last = corpus_pipeline.STAGES[-1][1](spark, before, SF01)
    assert last.count() == before.count()
    assert last.filter("not round_trip").count() == 0
    assert corpus_pipeline.run(spark, SF01).count() == before.count()
