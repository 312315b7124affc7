from __future__ import annotations

import random
import zlib

import naive
import numpy as np

from gridspan.llm import language

ENDINGS = {"aa": ["tion", "ing", "the"], "bb": ["ung", "ich", "sch"], "cc": ["été", "eau", "oix"]}


def corpus(n, seed=4):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(list(ENDINGS))
        text = " ".join(rng.choice("bdfglmnprst") + rng.choice("aeiou") + rng.choice(ENDINGS[lang])
                        for _ in range(rng.randint(15, 120)))
        rows.append((i, text, lang))
    return rows


def test_held_out_texts(spark):
    rows = corpus(600)
    extra = [(9000, None, "aa"), (9001, "", "bb"), (9002, "12 !? \n", "cc"), (None, rows[0][1], "aa"),
             rows[3], (9003, rows[5][1], None), (9004, (rows[7][1] + " ") * 300, rows[7][2])]
    docs = spark.createDataFrame([(*r, 1) for r in rows + extra], "doc_id long, text string, lang string, c0 int")
    got = language.identified(docs).collect()
    assert len(got) == len(rows) + len(extra)
    by_id = {r.doc_id: r for r in got}
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 for i in (9000, 9001, 9002))
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [by_id[i].lang_pred == lang for i, _, lang in rows if by_id[i].held_out]
    assert np.mean(held) > 0.95 and by_id[9004].lang_pred == rows[7][2]
    assert all(0 <= r.score <= 1 for r in got)


def test_tables_give_the_network_s_responses():
    rng = np.random.default_rng(2)
    rows = rng.integers(0, language.SYMBOLS, (9, language.WINDOW)).astype(np.uint8)
    network = language.train(rows, np.arange(9) % 2, ["x", "y"])
    pooled = []
    for filters, shift in zip(network.filters, network.shifts):
        w, x = len(filters), network.vectors[rows]
        response = sum(x[:, j : language.WINDOW - w + 1 + j] @ filters[j] for j in range(w)) + shift
        pooled.append(np.maximum(response.max(axis=1), 0))
    want = language._log_softmax(np.concatenate(pooled, axis=1) @ network.weights + network.offset)
    assert np.allclose(network.log_probabilities(rows, network.tables()), want, atol=1e-3)


def test_gradients_equal_differences():
    rng = np.random.default_rng(3)
    rows = rng.integers(0, language.SYMBOLS, (5, language.WINDOW))
    target = rng.integers(0, 3, 5)
    k, f = language.WIDTHS, language.FILTERS
    p = [rng.normal(0, 0.5, (language.SYMBOLS, language.SIZE)), rng.normal(0, 0.3, (f * len(k), 3)), np.zeros(3)]
    p += [rng.normal(0, 0.3, (w * language.SIZE, f)) for w in k] + [np.zeros(f) for _ in k]

    def loss(q):
        pooled = []
        for i, w in enumerate(k):
            x = q[0][rows].reshape(5, -1)
            view = np.lib.stride_tricks.sliding_window_view(x, w * language.SIZE, axis=1)[:, :: language.SIZE]
            pooled.append((view @ q[3 + i] + q[3 + len(k) + i]).max(axis=1))
        out = language._log_softmax(np.maximum(np.concatenate(pooled, axis=1), 0) @ q[1] + q[2])
        return -out[np.arange(5), target].mean()

    for i, g in enumerate(language._gradients(p, rows, target)):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        up, down = [x.copy() for x in p], [x.copy() for x in p]
        up[i][at] += 1e-5
        down[i][at] -= 1e-5
        assert abs((loss(up) - loss(down)) / 2e-5 - g[at]) < 1e-3


def test_windows_cover_the_whole_text():
    text = ("Aé" * 1000).encode()
    rows = language.windows(text)
    assert rows.ravel()[: len(text)].tolist() == language.FOLD[np.frombuffer(text, np.uint8)].tolist()
    assert not rows.ravel()[len(text) :].any() and len(language.windows(b"")) == 0


def test_nothing_to_learn_from(spark):
    for rows in ([], [(1, "some text", None), (2, None, "aa")]):
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
        got = language.identified(docs).collect()
        assert len(got) == len(rows) and all(r.lang_pred == "und" for r in got)


def test_filtered(spark):
    rows = corpus(200)
    extra = [(9000, None, "aa"), (9002, "12 !?", "cc")]
    docs = spark.createDataFrame([(lang, i, t) for i, t, lang in rows + extra], "lang string, doc_id long, text string")
    got = language.filtered(docs)
    assert got.columns == docs.columns
    kept = {r.doc_id for r in got.collect()}
    assert not kept & {9000, 9002} and len(kept) > 190


def test_a_repeated_id_gives_windows_of_one_text(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(language, "train", lambda x, y, languages: seen.update(n=len(x), of=languages))
    rows = corpus(40)
    rows += [(3, t, rows[3][2]) for _, t, _ in corpus(200, seed=5)] + [(5, "12 !?", rows[5][2])] * 9
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    language.learned(docs)
    assert 40 <= seen["n"] <= 40 * language.PER_TEXT and seen["of"] == sorted(ENDINGS)


def test_scores_equal_naive_convolutions_of_whole_texts(spark):
    rows = [*corpus(150, 9), (900, "été " * 400 + "ung " * 300, "aa"), (901, "1 2", "bb"), (902, "ß", "cc"), (903, None, "aa")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    network = language.learned(docs, ~language.held_out(4, 2))
    got = {r.doc_id: r for r in language.identified(docs).collect()}
    for i, text, _ in rows:
        name, score = naive.language_of(network, text)
        assert abs(got[i].score - score) < 1e-3
        assert got[i].lang_pred == name or abs(score - 1 / 2) < 0.01
