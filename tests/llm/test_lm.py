from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from gridspan.llm import lm

SMALL = lm.Settings(words=12, growth=0, size=4, block=500, learner=900)


def is_held_out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def tokens(text):
    return [*(text or "").encode().lower().split(), b""]


def corpus():
    rng = random.Random(3)
    words = [f"W{int(rng.expovariate(0.1))}" for _ in range(400)] + ["É", "é", "the", "The"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 50)))) for i in range(150)]
    return [*rows, rows[9], rows[9], (None, "a b"), (801, None), (802, ""), (803, "unseen " * 5000),
            (9, "another text")]


@pytest.mark.parametrize("frequent", [15, 100_000])
def test_base_columns_equal_brute_force(spark, frequent):
    rows = corpus()
    counts = Counter(t for i, text in rows if not is_held_out(i) for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    docs = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, score double")
    got = lm.score(docs, SMALL, frequent=frequent).collect()

    def expected(i, text):
        own = tokens(text)
        base = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in own)
        return i, is_held_out(i), len(own), sum(counts[t] > 0 for t in own), n, f"{base:.6f}"

    assert sorted(str((*r[:5], f"{r[5]:.6f}")) for r in got) == sorted(
        str(expected(*r)) for r in rows
    )
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)


def test_scores_do_not_depend_on_which_words_travel(spark):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string").coalesce(1)
    few, many = (
        sorted((str(r.doc_id), round(r.score, 4)) for r in lm.score(docs, SMALL, frequent=f).collect())
        for f in (15, 1000)
    )
    assert few == many


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(1)
    model = lm.Model(*(rng.normal(size=(700, 8)) for _ in range(2)), rng.normal(size=700))
    log_z = model.log_normalisers()
    h = np.repeat([0, 5, 699], 700)
    p = np.exp(model.scores(h, np.tile(np.arange(700), 3)) - log_z[h]).reshape(3, 700)
    assert np.allclose(p.sum(axis=1), 1)


def test_training_learns_which_word_follows():
    unigram = np.full(20, 1 / 20)
    settings = lm.Settings(size=8, passes=300, batch=20)
    start = lm.Mixture.fresh(unigram, settings)
    trainer = lm.Trainer(unigram, settings, start.models[0], start.squares[0])
    h = np.arange(20)
    trainer.learn(h, (h + 1) % 20, np.full(20, 10))
    log_z = trainer.model.log_normalisers()
    p = np.exp(trainer.model.scores(h, (h + 1) % 20) - log_z)
    assert p.mean() > 0.3


def test_model_scores_held_out_text_better_than_its_unigrams(spark):
    rng = random.Random(1)
    rows = []
    for i in range(600):
        side = rng.choice("xy")  # each text keeps to one of two vocabularies
        rows.append((i, " ".join(side + str(rng.randint(0, 30)) for _ in range(60))))
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    settings = lm.Settings(words=100, growth=0, passes=20)
    got = [r for r in lm.score(docs, settings).collect() if r.held_out]
    assert sum(r.score for r in got) > sum(r.base_score for r in got) + 5 * len(got)


@pytest.mark.parametrize("rows", [[], [(3, "a b")]])
def test_without_training_text(spark, rows):
    rows = [r for r in [(i, "a b") for i in range(40)] if is_held_out(r[0])][:2] if rows else []
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = lm.score(docs, SMALL).collect()
    assert len(got) == len(rows)
    assert all(r.train_tokens == 0 and r.n_known == 0 and math.isfinite(r.score) for r in got)


def naive_score(vocabulary, model, counts, text):
    """log10 probability of a text, token by token, with a softmax over all entries each time."""
    width, total = vocabulary.words, 0.0
    history = [0, 0]
    for token in tokens(text):
        at = vocabulary.index.get(token, 0 if token == b"" else -1)
        entry = at if 0 <= at < width else width
        p = 0.0
        for k, m in enumerate(model.models, 1):
            h = history[-k]
            scores = [float(m.context[h].astype(float) @ m.word[w].astype(float) + m.bias[w]) for w in range(width + 1)]
            top = max(scores)
            p += model.weights[k - 1] * math.exp(scores[entry] - top) / sum(math.exp(s - top) for s in scores)
        total += math.log10(p)
        if entry == width:
            total += math.log10((counts[token] + 1) / vocabulary.others_base)
        history.append(entry)
    return total


@pytest.mark.parametrize("partitions", [1, 9])
def test_scores_equal_brute_force_token_by_token(spark, monkeypatch, partitions):
    rows = [r for r in corpus() if r[1] is None or len(r[1]) < 1000]
    learned = []
    real = lm.trained
    monkeypatch.setattr(lm, "trained", lambda t, shared, s: learned.append((shared.value, real(t, shared, s))) or learned[0][1])
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(partitions)
    got = lm.score(docs, SMALL).collect()
    vocabulary, model = learned[0]
    counts = Counter(t for i, text in rows if not is_held_out(i) for t in tokens(text))
    want = sorted((str(i), round(naive_score(vocabulary, model, counts, text), 3)) for i, text in rows)
    assert len(got) == len(want)
    for a, b in zip(sorted((str(r.doc_id), round(r.score, 3)) for r in got), want):
        assert a[0] == b[0] and abs(a[1] - b[1]) < 0.01
    assert abs(model.weights.sum() - 1) < 1e-6


def test_scores_do_not_depend_on_partitions(spark):
    """What is learned hangs on ids, so files may be split in any way."""
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice("xy") + str(rng.randint(0, 30)) for _ in range(60))) for i in range(500)]
    rows += [(7, "x1 y2 " * 30)] * 100
    found = []
    for partitions in (1, 8, 64):
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(partitions)
        got = lm.score(docs, lm.Settings(words=100, growth=0, learner=9000)).collect()
        held = [r for r in got if r.held_out]
        found.append(sum(r.score - r.base_score for r in held))
    assert max(found) - min(found) < 0.02 * abs(found[0])


def test_more_words_of_one_count_than_travel(spark):
    """The first ones by name travel then, not none."""
    counts = spark.createDataFrame([("", 9), *[(f"w{i:02}", 3) for i in range(40)]], "word string, c long")
    found = lm.vocabulary(counts, lm.Settings(words=50, growth=0), frequent=10)
    assert sorted(found.index) == [f"w{i:02}".encode() for i in range(10)]


def test_the_vocabulary_grows_with_distinct_words():
    settings = lm.Settings()
    assert [settings.vocabulary(n) for n in (10, 1 << 20, 1 << 24)] == [4096, 4096, 16384]


@pytest.mark.parametrize("places", [1, 2, 3])
def test_weights_of_places_follow_from_all_words(places):
    rng = np.random.default_rng(5)
    width, n = 40, 2 * lm.SCORED + 77
    models = [
        lm.Model.of_table(rng.normal(size=(width, 9)).astype(np.float32)) for _ in range(places)
    ]
    weights = rng.dirichlet(np.ones(places))
    w, *contexts = rng.integers(0, width, (places + 1, n))
    w[::16] = 0  # a word in sixteen is unlike the others
    p = np.array([
        q * np.exp([m.context[h] @ m.word[x] + m.bias[x] for h, x in zip(own, w)])
        for q, m, own in zip(weights, models, contexts)
    ])
    expected = (p / p.sum(axis=0)).sum(axis=1)
    assert np.allclose(lm._credit(models, weights, contexts, w), expected, rtol=1e-4)
