from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from gridspan.llm import fingerprint


def phrases(data):
    seen, start = set(), 0
    for end in range(1, len(data) + 1):
        if data[start:end] not in seen:
            seen.add(data[start:end])
            start = end
    return seen


def text_hash(text):
    h = xxhash.xxh64((text or "").encode(), seed=42).intdigest()
    return h - (1 << 64 if h >> 63 else 0)


def brute(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, text_hash(r[1])))
    out = []
    for i, (doc, text) in enumerate(order):
        text, following = text or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = (text[: len(text) - half] + following[:half]).encode()
        sets = [phrases(x) for x in (text.encode(), edited, following.encode())]
        near = [len(sets[0] & s) / len(sets[0] | s) if sets[0] | s else 1.0 for s in sets[1:]]
        out.append((doc, len(text), hashlib.sha256(edited).hexdigest(), near))
    return out


def corpus(n):
    rng = random.Random(n)
    rows = [(rng.randrange(10**6), "".join(rng.choice("abcé \U0001F600") for _ in range(rng.randint(0, 400))))
            for _ in range(n)]
    return rows


@pytest.mark.parametrize("rows", [
    [], [(5, "abcabc")], [(5, "abcabc"), (5, "abcabc"), (5, None)], corpus(200),
    [*corpus(40), (None, "x"), (None, None), (7, None), (2**60, "ab" * 40000)],
    [(None, "b"), (None, "a")],
    [*corpus(300), *[(7, f"text {i} " * 3) for i in range(200)]],
    [*corpus(900), *[(7, "equal rows ")] * 900, *[(None, f"n{i}") for i in range(300)]],
])
def test_equals_brute_force(spark, rows):
    docs = spark.createDataFrame([(*r, 0, 1) for r in rows], "doc_id long, text string, copy int, range int")
    got = fingerprint.fingerprints(docs).collect()
    want = brute(rows)
    assert sorted(str(tuple(r[:3])) for r in got) == sorted(str(w[:3]) for w in want)
    near = {}  # short texts may have equal edited texts and unlike next ones
    for w in want:
        near.setdefault(w[:3], []).append(w[3])
    for r in got:
        found = r.near_edited, r.near_next
        assert all(0 <= x <= 1 for x in found)
        assert any(all(abs(x - y) < 0.3 for x, y in zip(found, w)) for w in near[tuple(r[:3])])


def test_equal_texts_have_equal_fingerprints(spark):
    docs = spark.createDataFrame([(i, "same text é" * (1 + i % 3)) for i in range(60)], "doc_id long, text string")
    marks = {(r.n_chars, r.fingerprint) for r in fingerprint.fingerprints(docs).collect()}
    assert len(marks) == 3


def test_parse_is_the_definition():
    data = "abab aab é".encode() * 30
    parse = fingerprint.Parse().feed(data[:17]).feed(data[17:])
    starts = [0, *parse.ends]
    assert {data[a:b] for a, b in zip(starts, parse.ends)} == phrases(data)
    assert parse.fork().feed(b"xyz").ends[: len(parse.ends)] == parse.ends


def test_a_hot_id_is_spread_over_tasks(spark):
    """A third of the rows have one id, and a third of those one text; ranges stay about even."""
    rows = [(i * 10, f"t{i}") for i in range(4000)] + [(7, f"u{i}") for i in range(1300)] + [(7, "same")] * 700
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    keys = docs.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("h"))
    ranges = fingerprint.ranges_of(keys, 16)
    ids, hashes = (np.array(x, np.int64) for x in zip(*keys.collect()))
    first, last = ranges.places(ids, hashes)
    sizes = np.zeros(len(ranges.ids) + 1)
    for a, b in zip(first, last):
        sizes[a : b + 1] += 1 / (b - a + 1)
    assert sizes.sum() == pytest.approx(len(rows)) and sizes.max() < 2 * len(rows) / 16
    got = fingerprint.fingerprints(docs).collect()
    assert sorted(str(tuple(r[:3])) for r in got) == sorted(str(w[:3]) for w in brute(rows))
