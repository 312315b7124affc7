from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import duckdb
import oracle
import pytest

from gridspan.llm import variants

SCHEMA = "doc_id long, text string"


def is_near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def counted(rows):
    out = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]+", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                out[run] += 1
    return {w: n for w, n in out.items() if n >= 2}


def brute(rows):
    n = counted(rows)
    near = {w: [v for v in n if is_near(w, v)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, n[w], len(near[w]), form[w], n.get(form[w]), root))
    return out


def corpus(seed, letters="abé"):
    """Many words one edit apart, with repeated letters, at unlike frequencies."""
    rng = random.Random(seed)
    words = []
    for _ in range(12):
        word = "".join(rng.choices(letters, k=rng.randint(7, 10)))
        for _ in range(10):
            words.append((word, rng.choice([1, 2, 3, 25, 400])))
            i = rng.randrange(len(word) + 1)
            word = rng.choice([word[:i] + word[i + 1 :], word[:i] + rng.choice(letters) + word[i:],
                               word[:i] + rng.choice(letters) + word[i + 1 :]])
    tokens = [w if rng.random() < 0.7 else w.capitalize() for w, n in words for _ in range(n)]
    rng.shuffle(tokens)
    rows = [(i, rng.choice([" ", "-", "\n", "1", "ß ", "Ā"]).join(tokens[i::40])) for i in range(40)]
    return [*rows, rows[0], rows[0], (None, rows[1][1]), (77, None), (78, ""), (79, "short ones only")]


def found(spark, rows):
    out = [tuple(r) for r in variants.grouped(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert len(out) == len(set(out))
    return set(out)


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed):
    rows = corpus(seed)
    assert found(spark, rows) == brute(rows)
    assert any(f for _, _, _, f, _, _ in brute(rows))


@pytest.mark.parametrize("length", [variants.LONG - 1, variants.LONG, variants.LONG + 1, 300])
def test_long_words_at_the_border_of_sorted_rotations(spark, length):
    rng = random.Random(length)
    word = "".join(rng.choices("abß", k=length))
    words = [word, word[1:], word[:-1], word + word[-1], word[:9] + "q" + word[9:], word[:9] + "q" + word[10:],
             word[:9] + "z" + word[10:], word[0] + word, word[1:] + "é"]
    rows = [(i, " ".join(words)) for i in range(3)] + [(9, " ".join([word] * 50))]
    assert found(spark, rows) == brute(rows)


def test_one_very_long_word(spark):
    rows = [(1, "ab" * 100_000), (2, "ab" * 100_000), (3, "ab" * 100_000 + "a"), (4, "ab" * 100_000 + "a")]
    got = found(spark, rows)
    assert {(len(w), n, near) for w, n, near, *_ in got} == {(len(w), n, 1) for w, n in counted(rows).items()}


def test_runs_of_equal_rotations_are_bounded(spark):
    """A third of all occurrences are of one word: it is one row before rotations are made."""
    rows = [(i, "commonest " * 50 + f"word{chr(97 + i % 26)}rest commonxst") for i in range(60)]
    assert found(spark, rows) == brute(rows)


def test_rotations_of_a_word():
    keys = [(k, kind) for ks, kinds in variants.rotations("aab") for k, kind in zip(ks, kinds)]
    assert keys == [
        (b"aab$", 0), (b"ab$a", 0), (b"b$aa", 0), (b"$aab", 0),
        (b"ab$", 1), (b"b$a", 2), (b"$aa", 2),
    ]


def test_empty_table_and_more_columns(spark):
    assert found(spark, []) == set()
    rows = corpus(7)
    more = spark.createDataFrame([(*r, "x", 1) for r in rows], f"{SCHEMA}, word string, n int")
    assert {tuple(r) for r in variants.grouped(more).collect()} == brute(rows)


def test_equals_its_sql_on_odd_rows(spark, tmp_path):
    spark.createDataFrame(corpus(4), SCHEMA).coalesce(1).write.parquet(str(tmp_path / "d"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/d/*.parquet')")
    assert oracle.compare(variants.grouped(spark.read.parquet(str(tmp_path / "d"))), con, variants.sql()) == ""
