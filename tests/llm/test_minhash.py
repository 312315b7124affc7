from __future__ import annotations

import random

import numpy as np
import oracle
import pytest

from gridspan.llm import minhash
from gridspan.llm.graph import components


def shingle_set(text):
    own = (text or "").encode().lower().split()
    if not own:
        return frozenset()
    return frozenset(tuple(own[i : i + 5]) for i in range(max(1, len(own) - 4)))


def brute(rows, percent):
    sets = [shingle_set(t) for _, t in rows]
    label = {i: i for i, _ in rows if i is not None}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for p, (a, _) in enumerate(rows):
        for q, (b, _) in enumerate(rows[:p]):
            x, y = sets[p], sets[q]
            if a is None or b is None or not x or not y:
                continue
            if 100 * len(x & y) >= percent * len(x | y):
                ra, rb = root(a), root(b)
                label[max(ra, rb)] = min(ra, rb)
    return sorted(
        str((i, len(s), None if i is None else root(i), i is None or root(i) == i))
        for (i, _), s in zip(rows, sets)
    )


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(25):
        text = [rng.choice(vocabulary) for _ in range(rng.randint(1, 300))]
        for _ in range(rng.randint(1, 12)):
            rows.append(" ".join(text))
            for _ in range(rng.randint(0, 4)):  # the copies drift, so ends of a chain differ
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
    rows += ["A b  C", "a b c", "a b d", "", " \n", None, "x " * 9000, "x " * 40]
    rng.shuffle(rows)
    out = [(7 * i % 9973, t) for i, t in enumerate(rows)]
    return [*out, out[0], (None, rows[0]), (None, None)]


@pytest.mark.parametrize("percent", [80, 85])
def test_components_equal_brute_force(spark, percent):
    rows = corpus(percent)
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, kept int")
    got = minhash.near_duplicates(docs, percent).collect()
    assert sorted(str(tuple(r)) for r in got) == brute(rows, percent)


def staying(rows, percent):
    """One row of each component by brute force over rows: that with the smallest id."""
    numbered = [(k, t) for k, (_, t) in enumerate(rows)]
    best = {}
    for k, _, component, _ in map(eval, brute(numbered, percent)):
        place = (rows[k][0] is None, rows[k][0] or 0, rows[k][1] or "")
        best[component] = min(best.get(component, (place, rows[k])), (place, rows[k]), key=lambda x: x[0])
    return sorted((i is None, i or 0, "" if t is None else f"t{t.lower().split()}") for _, (i, t) in best.values())


@pytest.mark.parametrize("rows", [
    corpus(4),
    [(3, "A " * 30), (5, "A " * 30), (5, "b " * 30), (7, "A " * 31), (9, "B " * 30), (9, "b " * 30)],
    [(1, "one two three")] * 3 + [(None, "one two three")] * 2 + [(None, "x y z")] * 2 + [(1, None)] * 2 + [(1, "")] * 2,
])
def test_deduplicated(spark, rows):
    docs = spark.createDataFrame([(t, i, "s") for i, t in rows], "text string, doc_id long, _row string")
    got = minhash.deduplicated(docs, 80)
    assert got.columns == docs.columns
    kept = [(r.doc_id is None, r.doc_id or 0, "" if r.text is None else f"t{r.text.lower().split()}") for r in got.collect()]
    assert sorted(kept) == staying(rows, 80)


def test_a_crowded_bucket_tries_few_pairs(spark, monkeypatch):
    """A hundred near copies and one stranger that shares their buckets: no square of the hundred."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(100):
        text = list(base)
        text[rng.randrange(400)] = f"x{i}"
        rows.append((i + 1, " ".join(text)))
    rows.append((500, " ".join(base[:330] + [f"y{i}" for i in range(70)])))
    tried = []
    real = minhash.confirmed
    monkeypatch.setattr(minhash, "confirmed", lambda d, pairs, p: tried.append(pairs.count()) or real(d, pairs, p))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = minhash.near_duplicates(docs, 85).collect()
    assert sorted(str(tuple(r)) for r in got) == brute(rows, 85)
    assert sum(tried) <= 400


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert minhash.near_duplicates(docs).count() == 0


@pytest.mark.parametrize(("n", "common"), [(1000, 900), (40, 36), (9000, 8600), (1, 1)])
def test_estimate_is_near_the_similarity(spark, n, common):
    rng = np.random.default_rng(2)
    a = rng.integers(0, 1 << 64, n, dtype=np.uint64)
    b = np.concatenate([a[:common], rng.integers(0, 1 << 64, n - common, dtype=np.uint64)])
    longs = minhash.packed([np.unique(a), np.unique(b)])
    fields = ", ".join(f"{s} long" for s in minhash.SIGNATURE)
    x = spark.createDataFrame([tuple(map(int, longs[:, 0]))], fields).alias("x")
    y = spark.createDataFrame([tuple(map(int, longs[:, 1]))], fields).alias("y")
    got = x.join(y).select(minhash.estimate(*minhash.agreement("x", "y"))).first()[0]
    assert abs(got - common / (2 * n - common)) < 0.06


def test_long_chains_have_one_component(spark):
    order = list(range(200))
    random.Random(1).shuffle(order)
    edges = list(zip(order, order[1:]))[:150] + [(500, 501), (501, 502)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    chain = order[:151]
    assert {v: r for v, r in got.items() if v < 500} == {v: min(chain) for v in chain if v != min(chain)}
    assert got[501] == got[502] == 500


def test_query_equals_its_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = minhash.near_duplicates(docs)
    assert oracle.compare(found, oracle.connect(sf_dir), minhash.sql()) == ""


def test_a_group_unlike_its_smallest_member(spark, monkeypatch):
    """Near copies of a text, each like most others, but few like the one with the smallest id."""
    rng = random.Random(8)
    base = [f"w{i}" for i in range(600)]
    rows = []
    for i in range(250):
        text = list(base)
        for at in rng.sample(range(600), 20 if i == 0 else 4):
            text[at] = f"x{i}-{at}"
        rows.append((i, " ".join(text)))
    tried = []
    real = minhash.confirmed
    monkeypatch.setattr(minhash, "confirmed", lambda d, pairs, p: tried.append(pairs.count()) or real(d, pairs, p))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = minhash.near_duplicates(docs, 85).collect()
    assert sorted(str(tuple(r)) for r in got) == brute(rows, 85)
    assert sum(tried) < 12 * len(rows)


def test_copies_that_are_like_their_original_only(spark, monkeypatch):
    """Of two copies each is like the text in the middle, and hardly like each other."""
    rng = random.Random(4)
    base = [f"w{i}" for i in range(600)]
    rows = [(1000, " ".join(base))]
    for i in range(200):
        text = list(base)
        for at in rng.sample(range(600), 9):
            text[at] = f"x{i}-{at}"
        rows.append((i, " ".join(text)))
    tried = []
    real = minhash.confirmed
    monkeypatch.setattr(minhash, "confirmed", lambda d, pairs, p: tried.append(pairs.count()) or real(d, pairs, p))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = minhash.near_duplicates(docs, 85).collect()
    assert sorted(str(tuple(r)) for r in got) == brute(rows, 85)
    assert len({r.component_id for r in got}) == 1 and sum(tried) < 4 * len(rows)
