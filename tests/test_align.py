from __future__ import annotations

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridspan.operators import align

MEASURES = {"OutputEnergy": "O", "CapabilityEnergy": "C", "AvailCapacity": "A"}


def long_rows(seed, n=400):
    rng = random.Random(seed)
    # One key holds a third of the rows.
    keys = ["hot" if rng.random() < 1 / 3 else f"g{rng.randrange(40)}" for _ in range(n)]
    return [
        (k, rng.randrange(1, 25), rng.choice("OCAX"), rng.choice([None, rng.random()]), i)
        for i, k in enumerate(keys)
    ]


def test_alignment_equals_last_wins_dictionaries(spark):
    cells = long_rows(3)
    df = spark.createDataFrame(cells, "g string, h int, tag string, v double, pos long")
    aligned = align.align_measures(df.repartition(7), ["g", "h"], "tag", MEASURES, "v", ["pos"])
    tags = list(MEASURES.values())
    expected = {}
    for g, h, tag, v, _ in cells:
        if v is not None and tag in tags:
            expected.setdefault((g, h), dict.fromkeys(tags, 0.0))[tag] = v
    actual = {(r.g, r.h): {m: r[n] for n, m in MEASURES.items()} for r in aligned.collect()}
    assert actual == expected


def test_one_order_column_aggregates_by_hash_and_combines_first(spark):
    df = spark.range(100).select(
        (F.col("id") % 10).alias("g"), F.lit("O").alias("tag"), F.lit(1.0).alias("v"), "id"
    )
    one = align.align_measures(df, ["g"], "tag", MEASURES, "v", ["id"])
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "partial_max_by" in plan
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_last_wins_by_two_columns(spark):
    rng = random.Random(5)
    cells = [(rng.randrange(5), rng.randrange(9), i, rng.random()) for i in range(300)]
    df = spark.createDataFrame(cells, "k int, t int, id int, v double")
    expected = pd.DataFrame(cells, columns=["k", "t", "id", "v"]).sort_values(["t", "id"])
    expected = expected.groupby("k").last()
    actual = align.last_wins(df.repartition(5), ["k"], ["t", "id"], ["v"]).collect()
    assert {r.k: (r.t, r.id, r.v) for r in actual} == {
        k: (r.t, r.id, r.v) for k, r in expected.iterrows()
    }


def test_key_union(spark):
    left = spark.createDataFrame([(1, "a"), (1, "a")], "k int, x string")
    right = spark.createDataFrame([("b", 2), (None, 1)], "x string, k int")
    union = align.key_union([left, right], ["k", "x"])
    assert sorted(map(tuple, union.collect()), key=repr) == sorted(
        [(1, "a"), (2, "b"), (1, None)], key=repr
    )


@pytest.mark.parametrize("order", [["o"], ["o", "p"]])
def test_rows_without_an_order_come_first(spark, order):
    rows = [(1, None, None, 5.0), (2, None, 1, 6.0), (2, 3, None, 7.0), (2, 2, 9, 8.0)]
    df = spark.createDataFrame(rows, "k int, o int, p int, v double")
    got = {r.k: r.v for r in align.last_wins(df, ["k"], order, ["v"]).collect()}
    assert got == {1: 5.0, 2: 7.0}
    tagged = df.selectExpr("*", "'A' AS tag")
    aligned = align.align_measures(tagged, ["k"], "tag", {"a": "A", "b": "B"}, "v", order)
    assert {r.k: (r.a, r.b) for r in aligned.collect()} == {1: (5.0, 0.0), 2: (7.0, 0.0)}
