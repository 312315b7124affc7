from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from gridspan.llm import quality, rules, statistics
from gridspan.llm.statistics import COUNTS, FEATURES

WORD = r"[^\x20\x09-\x0D]+"


def counts(text):
    text = text or ""
    own = re.findall(WORD, text)
    windows = [tuple(own[i : i + 8]) for i in range(len(own) - 7)]
    often, covered, seen, lines = Counter(windows), set(), set(), 0
    for i, window in enumerate(windows):
        if often[window] > 1:
            covered |= set(range(i, i + 8))
    for line in text.split("\n"):
        if re.search(WORD, line):
            lines += line in seen
            seen.add(line)
    return (len(own), sum(map(len, own)), len(re.findall(r"[#*$%&|<>]", text)), lines, len(covered))


def corpus():
    rng = random.Random(1)
    parts = ["a", "b", " ", "\n", " a b a b a b a b", "#", "A\t", "é\x1c ", "\x85", "x y z "]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 80)))) for i in range(300)]
    return [*rows, rows[3], (900, None), (901, " \n"), (902, "a " * 30000), (None, "one two"),
            (903, " ".join(f"w{i}" for i in range(3000)) * 2)]


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_counts_equal_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame([(*r, 1, "t") for r in rows], "doc_id long, text string, n_words int, _text string")
    got = rules.judged(docs, labels(spark, [])).collect()
    want = []
    for i, text in rows:
        own = counts(text)
        failed = own[0] < 20 or 100 * own[4] > 30 * own[0]
        want.append((i, *own, failed, not failed))
    assert sorted(str(tuple(r)) for r in got) == sorted(map(str, want))
    assert got[0].asDict().keys() == {"doc_id", *COUNTS, "base_failed", "kept"}


def test_crowded_hashes_are_told_apart():
    """Places of equal windows, by the definition, for a text of two interleaved repeats."""
    text = " ".join([*"abcdefgh", *"12345678", *"abcdefgh", *"12345678"])
    assert counts(text)[4] == 32


def noisy(n, seed=2):
    rng = random.Random(seed)
    rows, marks = [], []
    for i in range(n):
        good = rng.random() < 0.8
        own = [f"{rng.choice('abcdefg')}{rng.randint(0, 999)}" for _ in range(rng.randint(30, 90))]
        text = " ".join(own if good else [w + rng.choice(["$$$", "###"]) for w in own])
        rows.append((i, text))
        marks.append((i, int(good), 0))
    return rows, marks


def test_learned_list_rejects_what_labels_call_bad(spark):
    rows, marks = noisy(900)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = labels(spark, [*marks[:500], (None, 1, 0), (3, None, None), marks[0], (10**9, 0, 0)])
    got = {r.doc_id: r.kept for r in rules.judged(docs, known).collect()}
    good = {i: bool(q) for i, q, _ in marks}
    assert np.mean([got[i] == good[i] for i in range(500, 900)]) > 0.97
    kept = rules.filtered(docs.withColumn("lang", docs.doc_id), known)
    assert kept.columns == ["doc_id", "text", "lang"]
    assert {r.doc_id for r in kept.collect()} == {i for i in got if got[i]}


def test_compiled_list_equals_the_learned_one(spark):
    rng = np.random.default_rng(3)
    x = rng.random((600, len(FEATURES)))
    good = ~((x[:, 2] > 0.7) | ((x[:, 5] < 0.2) & (x[:, 0] > 0.5)))
    found = rules.learn(x, good)
    assert found.rules and "reject if" in str(found)
    frame = spark.createDataFrame([(*map(float, r),) for r in x], FEATURES).withColumn("kept", found.column())
    rejected = np.zeros(len(x), bool)
    for rule in found.rules:
        rejected |= rules.met(x, FEATURES, rule).all(axis=1)
    assert [r.kept for r in frame.collect()] == (~rejected).tolist()
    assert (rejected == ~good).mean() > 0.95


@pytest.mark.parametrize("good", [[], [True] * 9, [False] * 9])
def test_nothing_is_learned_from_labels_of_one_kind(good):
    x = np.zeros((len(good), len(FEATURES)))
    assert rules.learn(x, np.array(good, bool)).rules == []
    assert quality.learn(x, np.array(good, bool)).rules == []


def test_ensemble_scores_held_out_texts(spark):
    rows, marks = noisy(900, 5)
    rows += [(5000, None), (5001, ""), (None, "a b"), rows[0]]
    docs = spark.createDataFrame([(*r, "en") for r in rows], "doc_id long, text string, score string")
    got = quality.score(docs, labels(spark, marks)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert all(r.predicted == int(r.score >= 0.3) for r in got)
    good = {i: q for i, q, _ in marks}
    held = [r for r in got if r.held_out]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in held)
    assert np.mean([r.predicted == good[r.doc_id] for r in held if r.doc_id in good]) > 0.97


def test_held_out_labels_are_not_seen(spark):
    rows, marks = noisy(300, 7)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q, t) for i, q, t in marks]
    one, two = (
        sorted(map(tuple, quality.score(docs, labels(spark, m)).collect())) for m in (marks, flipped)
    )
    assert one == two


def test_lasso_drops_useless_rules():
    rng = np.random.default_rng(1)
    x = (rng.random((2000, 30)) > 0.5).astype(float)
    good = (rng.random(2000) < 1 / (1 + np.exp(-(4 * x[:, 3] - 2)))).astype(float)
    _, weights = quality.lasso(x, good)
    assert abs(weights[3]) > 2 and np.abs(np.delete(weights, 3)).max() < 0.5
    assert (weights == 0).sum() >= 5


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert rules.judged(docs, labels(spark, [])).count() == 0
    assert quality.score(docs, labels(spark, [])).count() == 0
    assert statistics.counted(docs, ["doc_id"]).count() == 0


@pytest.mark.parametrize("query", [rules.judged])
def test_main_path_is_native(spark, query):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = query(docs, labels(spark, []))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_a_repeated_id_is_one_labelled_row(spark):
    rows = [(i, f"text {i} " * 9) for i in range(30)] + [(7, f"other {i} " * 9) for i in range(300)]
    rows += [(8, "text 8 " * 9)] * 40 + [(50, None)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    known = labels(spark, [(i, i % 2, 0) for i in [*range(30), 50]])
    got = rules.labelled(docs, known, 100).collect()
    assert sorted(r.doc_id for r in got) == [*range(30), 50]
    assert {(r.doc_id, r.text) for r in got} <= set(rows)
    x, good = rules.sample(docs, known, 100)
    assert len(x) == 31 and good.sum() == 15
    again = rules.labelled(docs.repartition(3), known, 100).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_ensemble_scores_equal_rules_applied_row_by_row(spark):
    import naive

    rows, marks = noisy(400, 8)
    rows += [(5000, None), (5001, ""), (5002, "Same line\n" * 40), (5003, "A # b " * 900)]
    docs, known = spark.createDataFrame(rows, "doc_id long, text string"), labels(spark, marks)
    model = quality.learn(*rules.sample(docs, known, quality.SAMPLE, ~quality.held_out(5, 0)))
    assert model.rules
    got = {r.doc_id: r.score for r in quality.score(docs, known).collect()}
    assert all(abs(got[i] - naive.ensemble_score(model, text)) < 1e-12 for i, text in rows)
    found = rules.learn(*rules.sample(docs, known, rules.SAMPLE))
    kept = {r.doc_id: r.kept for r in rules.judged(docs, known).collect()}
    assert all(kept[i] == naive.list_keeps(found, text) for i, text in rows)
