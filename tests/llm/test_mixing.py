from __future__ import annotations

import hashlib
import random

import oracle
import pytest

from gridspan.llm import mixing
from gridspan.llm.mixing import Mixture

SF_DIR = "/root/testdata/sf0.001"


def filled(given, children):
    """Budgets by repeated hand-outs: (name, capacity, weight) -> budget."""
    left, out, open_ = given, {}, sorted(children, key=lambda c: (c[1] / c[2], c[0]))
    while open_:
        share = left / sum(w for _, _, w in open_)
        name, capacity, weight = open_[0]
        if capacity <= weight * share:
            out[name] = capacity
            left -= capacity
            open_ = open_[1:]
            continue
        weights = sum(w for _, _, w in open_)
        for name, _, weight in open_:
            out[name] = weight * left // weights
        lost = left - sum(out[n] for n, _, _ in open_)
        for name in sorted(n for n, _, _ in open_)[:lost]:
            out[name] += 1
        break
    return out


@pytest.mark.parametrize("seed", range(6))
def test_shortages_go_to_siblings(spark, seed):
    rng = random.Random(seed)
    rows = [(f"c{i}", rng.choice("pq"), rng.randint(0, 500), rng.randint(1, 9)) for i in range(12)]
    given = {"p": rng.randint(0, 3000), "q": rng.randint(0, 1000)}
    frame = spark.createDataFrame([(*r, given[r[1]]) for r in rows],
                                  "child string, parent string, capacity long, weight int, given long")
    got = {r.child: r.budget for r in mixing.shared_out(frame, ["parent"]).collect()}
    for parent, total in given.items():
        own = [(n, c, w) for n, p, c, w in rows if p == parent]
        assert {n: got[n] for n, _, _ in own} == filled(total, own)


def brute_read(rows, mixture, got):
    """(doc_id, epochs, tokens read) of every row, given the leaf budgets, as one stream a leaf."""
    budgets = {(r.domain, r.lang, r.source): r.budget for r in got}
    by_id = {}
    for i, text, lang, source in rows:
        text, name = text or "", "" if i is None else str(i)
        leaf = next(k for k in budgets if k[1:] == (lang or "", source or ""))
        key = (*leaf[1:], hashlib.md5(text.encode()).hexdigest())
        by_id.setdefault(name, []).append((key, i, leaf, len(text.split())))
    leaves = {}
    for name, own in by_id.items():
        for copy, (_, i, leaf, n) in enumerate(sorted(own, key=lambda r: r[0])):
            leaves.setdefault(leaf, []).append((name, copy, i, n))
    out = []
    for leaf, own in leaves.items():
        left = budgets[leaf]
        read = {r: [0, 0] for r in own}
        tokens = sum(r[3] for r in own)
        for epoch in range(mixture.epochs if tokens else 0):
            all_of_it = tokens <= left
            for r in sorted(own, key=lambda r: hashlib.md5(f"{mixture.seed}:{epoch}:{r[0]}:{r[1]}".encode()).hexdigest()):
                if all_of_it or left > 0:
                    read[r][0] += 1
                    read[r][1] += min(r[3], left)
                    left -= min(r[3], left)
        out += [(r[2], *read[r]) for r in own]
    return out


def corpus():
    rng = random.Random(8)
    rows = []
    for i in range(400):
        source = "src0" if i % 3 == 0 else rng.choice(["src1", "src2", "src12", "blog", None])
        rows.append((i, " ".join("w" * rng.randint(0, 30)), rng.choice(["en", "de", None]), source))
    return [*rows, rows[0], (None, "a b", "en", "src0"), (900, None, "xx", "src0"), (901, "t " * 5000, "en", "src2"),
            (902, "", "yy", "src7")]


@pytest.mark.parametrize("mixture", [Mixture(), Mixture(percent=500, epochs=3), Mixture(percent=5, epochs=1),
                                     Mixture(percent=0)])
def test_epochs(spark, mixture):
    rows = corpus()
    docs = spark.createDataFrame([(*r, 3) for r in rows], "doc_id long, text string, lang string, source string, budget int")
    got = mixing.mixed(docs, mixture).collect()
    assert sorted(map(str, ((r.doc_id, r.epochs, r.tokens_read) for r in got))) == sorted(
        map(str, brute_read(rows, mixture, got)))
    tokens = sum(r.n_tokens for r in got)
    read = sum(r.tokens_read for r in got)
    assert read == min(tokens * mixture.epochs, tokens * mixture.percent // 100)
    assert max(r.epochs for r in got) <= mixture.epochs
    if mixture.percent == 500:
        assert read == tokens * 3
    drawn = mixing.drawn(docs, mixture)
    assert drawn.columns == docs.columns
    assert sorted(str(r.doc_id) for r in drawn.collect()) == sorted(str(r.doc_id) for r in got for _ in range(r.epochs))


def test_target_shares_are_met_to_the_token(spark):
    docs = spark.createDataFrame(
        [(i, "w " * 10, lang, src) for i, (lang, src) in enumerate([("en", "src0")] * 900 + [("de", "src0")] * 300
                                                                     + [("en", "src1")] * 900 + [("en", "src2")] * 900)],
        "doc_id long, text string, lang string, source string")
    got = mixing.mixed(docs, Mixture(percent=30, epochs=1)).groupBy("domain").sum("tokens_read")
    assert dict(map(tuple, got.collect())) == {"web": 4500, "books": 2700, "forum": 1800}


@pytest.mark.parametrize("seed", range(3))
def test_one_text_longer_than_the_budget(spark, seed):
    rows = [(0, "w " * 5000, "en", "src0")] + [(i, "w " * 10, "en", "src0") for i in range(1, 501)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    mixture = Mixture(percent=40, epochs=1, seed=seed)
    got = mixing.mixed(docs, mixture).filter("epochs > 0").collect()
    assert sum(r.tokens_read for r in got) == 4000
    whole = mixing.drawn(docs, mixture).select(mixing.n_tokens().alias("n")).groupBy().sum("n").first()[0]
    assert 4000 <= whole < 4000 + max(r.n_tokens for r in got)


def test_an_id_with_a_third_of_all_rows_is_read_in_part(spark):
    """Its rows have hashes of their own, so no hash digits hold them all."""
    rows = [(7, "w " * 10, "en", "src0")] * 1000 + [(i, "w " * 10, "en", "src0") for i in range(100, 2100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = mixing.mixed(docs, Mixture(percent=40, epochs=1)).groupBy(
        (mixing.F.col("doc_id") == 7).alias("hot")).sum("tokens_read").collect()
    read = dict(map(tuple, got))
    assert sum(read.values()) == 12_000 and 3500 < read[True] < 4500
    copies = mixing.described(docs).filter("doc_id = 7").select("copy").distinct().count()
    assert copies == 1000
    assert mixing.drawn(docs, Mixture(percent=40, epochs=1)).count() == 1200


def test_sql_with_a_document_of_half_a_leaf(spark, tmp_path):
    rows = [*corpus(), (950, "t " * 9000, "de", "src4"), (951, "t " * 4000, "fr", "src5")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    frame.coalesce(1).write.parquet(str(tmp_path / "d"))
    con = __import__("duckdb").connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/d/*.parquet')")
    for mixture in (Mixture(), Mixture(percent=150, epochs=3, seed=4), Mixture(percent=7, epochs=1)):
        docs = spark.read.parquet(str(tmp_path / "d"))
        assert oracle.compare(mixing.mixed(docs, mixture), con, mixing.sql(mixture)) == ""


def test_no_python_in_the_plan(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    plan = mixing.mixed(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert mixing.mixed(docs).count() == 0 and mixing.drawn(docs, Mixture()).count() == 0


def test_query_equals_its_sql(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert oracle.compare(mixing.mixed(docs), oracle.connect(SF_DIR), mixing.sql()) == ""
