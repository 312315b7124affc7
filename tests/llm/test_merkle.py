from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import duckdb
import oracle
import pytest
from pyspark.sql import functions as F

from gridspan.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(fields):
    return sha("".join("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def tree(hashes):
    """The root and each leaf's path [(left, right), ...]."""
    paths, place, level = [[] for _ in hashes], list(range(len(hashes))), hashes
    while len(level) > 1:
        for i, p in enumerate(place):
            run = p // 3 * 3
            paths[i].append(("".join(level[run:p]), "".join(level[p + 1 : run + 3])))
        place = [p // 3 for p in place]
        level = [sha("".join(level[i : i + 3])) for i in range(0, len(level), 3)]
    return level[0], paths


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in order:
        own = sorted(groups[source], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[source] = (own, *tree([leaf(r) for r in own]))
    root, above = tree([trees[s][1] for s in order])
    out = Counter()
    for source, up in zip(order, above):
        own, subroot, paths = trees[source]
        for r, path in zip(own, paths):
            node = leaf(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None:
                node = leaf((*r[:4], r[4].replace("\n", "")))
            for left, right in path + up:
                node = sha(left + node + right)
            proof = sha("".join(a + b for a, b in path + up))
            out[(r[0], leaf(r), subroot, root, proof, node, node == root)] += 1
    return out


def documents(sizes, seed=0):
    rng = random.Random(seed)
    rows, ids = [], iter(rng.sample(range(100_000), sum(sizes.values()) + 9))
    for source, n in sizes.items():
        for _ in range(n):
            text = rng.choice(["a\nb é", "one line", "", None, "\n", "x\ny" * 50])
            rows.append((next(ids), source, rng.choice([None, "", "de"]), rng.choice([None, 3]), text))
    rng.shuffle(rows)
    return rows


def found(spark, rows, **options):
    return Counter(tuple(r) for r in merkle.checked(spark.createDataFrame(rows, SCHEMA)).collect())


@pytest.mark.parametrize("sizes", [
    {"a": 1}, {"a": 1, "b": 1}, {None: 2, "": 3, "a": 4, "é": 10, "z": 9, "😀": 28, "～": 1},
    {"hot": 400, "b": 82, "c": 81, "d": 1},
])
def test_equals_brute_force(spark, sizes):
    rows = documents(sizes)
    assert found(spark, rows) == brute(rows)


@pytest.mark.parametrize("levels", [1, 2])
def test_rounds_of_small_blocks(spark, monkeypatch, levels):
    """Blocks of three or nine rows lead through many rounds, as many rows would."""
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "BLOCK", 3**levels)
    rows = documents({"hot": 100, "b": 27, "c": 9, "d": 10, **{f"s{i}": 1 for i in range(14)}}, seed=levels)
    assert found(spark, rows) == brute(rows)


def test_more_rows_than_a_block(spark):
    rows = documents({"hot": merkle.BLOCK + 5, "full": merkle.BLOCK, "c": 3}, seed=3)
    assert found(spark, rows) == brute(rows)


def test_repeated_and_missing_ids(spark):
    rows = documents({"a": 5, None: 3}) + [(7, "a", None, None, "x\n")] * 6 + [(7, "a", None, None, "y")] * 2
    rows += [(None, "a", "en", 1, "n\n"), (None, None, None, None, None), (8, None, "en", None, "long\n" * 40_000)]
    assert found(spark, rows) == brute(rows)


def test_a_hot_id_is_spread_over_tasks(spark, monkeypatch):
    """Equal rows in a third of the table end up in ranges and blocks like any others."""
    monkeypatch.setattr(merkle, "LEVELS", 4)
    monkeypatch.setattr(merkle, "BLOCK", 81)
    rows = documents({"a": 1000, "b": 500}) + [(7, "a", None, None, "same")] * 900
    own = merkle.placed(
        spark.createDataFrame(rows, SCHEMA).select(merkle.group_key().alias("group"), "doc_id", merkle.leaf().alias("leaf")),
        ["doc_id", "leaf"],
    ).cache()
    assert own.groupBy("group", "pos").count().filter("count > 1").isEmpty()
    assert own.filter("pos >= n or pos < 0").isEmpty()
    blocks = own.groupBy("group", F.floor(F.col("pos") / 81)).count().agg(F.max("count")).first()[0]
    assert blocks <= 81
    assert found(spark, rows) == brute(rows)


def test_empty_table_and_more_columns(spark):
    assert found(spark, []) == Counter()
    rows = documents({"a": 4, "b": 2})
    more = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], f"{SCHEMA}, leaf string, n int, path string")
    assert Counter(tuple(r) for r in merkle.checked(more).collect()) == brute(rows)


def test_equals_its_sql_on_odd_rows(spark, tmp_path):
    rows = documents({None: 2, "": 3, "a": 40, "é": 10}) + [(7, "a", None, None, "x\n")] * 3 + [(None, "a", "en", 1, "n\n")]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(str(tmp_path / "d"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/d/*.parquet')")
    assert oracle.compare(merkle.checked(spark.read.parquet(str(tmp_path / "d"))), con, merkle.sql()) == ""
