from __future__ import annotations

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from gridspan.operators import profile, quality

DAY = date(2025, 1, 2)


def found(report):
    rows = report.orderBy("step").collect()
    return {(r.rule, r.column): r.violations for r in rows if not r.passed}


def test_generator_rules(spark):
    df = spark.createDataFrame(
        [(DAY, ""), (DAY, "  "), (DAY, None), (DAY, "GAS")], "Date date, Fuel_Type string"
    )
    report = quality.check_generator(df, fuel="Fuel_Type")
    assert found(report) == {("not_null", "Fuel_Type"): 1, ("not_blank", "Fuel_Type"): 2}
    warnings = quality.enforce(report)
    assert {w.severity for w in warnings} == {"warning"}


def test_duplicates_count_rows_beyond_the_first(spark):
    df = spark.createDataFrame(
        [("a", 1), ("a", 1), ("a", 1), (None, 1), (None, 1), ("", 1)], "t string, n int"
    )
    for long_text in ([], ["t"]):
        assert tuple(quality.duplicate_rows(df, long_text).first()) == (3, 6)
    assert tuple(quality.duplicate_rows(df.limit(0)).first()) == (0, 0)
    report = quality.check(df, ["t"], check_duplicates=True)
    assert found(report) == {("not_null", "t"): 2, ("no_duplicates", "*"): 3}


def test_empty_table(spark):
    empty = spark.createDataFrame([], "Date date, fuel_type string")
    report = quality.check_generator(empty)
    assert found(report) == {("min_rows", "*"): 1}
    with pytest.raises(quality.DataCheckError, match="min_rows"):
        quality.enforce(report)
    assert quality.enforce(quality.check_generator(empty, min_rows=0)) == []


def test_missing_columns_come_before_domain_rules(spark):
    df = spark.createDataFrame([(DAY, 99)], "Date date, Hour int")
    report = quality.check_demand(df)
    assert found(report) == {
        ("required_columns", "Market_Demand,Ontario_Demand"): 2, ("hour_range", "Hour"): 1,
    }
    with pytest.raises(quality.DataCheckError, match="required_columns"):
        quality.enforce(report)


def test_no_table():
    with pytest.raises(quality.DataCheckError):
        quality.check(None, [])


def test_missing_values_pass_range_and_sign(spark):
    df = spark.createDataFrame(
        [(DAY, None, None, float("nan")), (DAY, 24, 0.0, -0.5)],
        "Date date, Hour int, Market_Demand double, Ontario_Demand double",
    )
    assert found(quality.check_demand(df)) == {
        ("not_null", "Hour"): 1,
        ("not_null", "Market_Demand"): 1,
        ("not_null", "Ontario_Demand"): 1,
        ("non_negative", "Ontario_Demand"): 1,
    }


def test_check_is_one_pass(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    rows = events.select(F.to_date("ts").alias("Date"), F.hour("ts").alias("Hour"))
    plan = quality.check_zonal(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_profile(spark):
    df = spark.createDataFrame(
        [(1, "ab", 1.0), (2, None, float("nan")), (None, "é", None)], "i int, s string, x double"
    )
    rows = profile.profile(df).orderBy("position").collect()
    assert [tuple(r) for r in rows] == [
        (1, "i", "int", 3, 3, 1, 8), (2, "s", "string", 3, 3, 1, 4), (3, "x", "double", 3, 3, 2, 16),
    ]


def test_distinct(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "f string")
    assert profile.distinct_counts(df, ["f"]).first()[0] == 2
    assert profile.distinct_counts(df, ["f"], approximate=True).first()[0] == 2
    values = {r.f: r.row_count for r in profile.distinct_values(df, "f").collect()}
    assert values == {"a": 2, "b": 1, None: 1}


def test_sketches_merge_and_follow_changed_dates_only(spark, store):
    from gridspan.operators import sketches

    rows = spark.range(60_000).select(
        F.expr("date_add(DATE '2025-01-01', CAST(id % 10 AS INT))").alias("Date"),
        (F.col("id") * 7919 % 20_011).alias("many"), (F.col("id") % 3).alias("few"),
        F.when(F.col("id") % 4 != 0, F.col("id") % 50 / 2).alias("number"),
    )
    store.replace_table(rows, "raw/t")
    name = sketches.refresh(store, "raw/t", ["many", "few", "number"])

    def found(df):
        return {r.column_name: r for r in sketches.merged(df).collect()}

    got = found(store.read(name).filter("`Date` < '2025-01-06'"))
    want = rows.filter("`Date` < '2025-01-06'").agg(
        F.count_distinct("many"), F.count_distinct("few"), F.count_distinct("number")).first()
    assert got["few"].distinct == want[1] and got["number"].distinct == want[2]
    assert abs(got["many"].distinct - want[0]) < 0.06 * want[0]
    assert {r.row_count for r in got.values()} == {30_000} and got["number"].null_count > 0
    top = rows.filter("`Date` < '2025-01-06'").groupBy("few").count().agg(F.max("count")).first()[0]
    assert got["few"].top[0]["count"] == top
    # One date changes: its partition alone is read, and its sketches alone are rewritten.
    files = {r[0] for r in store.read(name).select(F.col("_metadata.file_path")).collect()}
    changed = rows.filter("`Date` = '2025-01-03'").withColumn("few", F.lit(9))
    store.upsert(changed, "raw/t", mode="all_dates_in_batch")
    plan = sketches.date_sketches(sketches.on_dates(store.read("raw/t"), changed.select("Date")), ["few"])
    scan = re.search(r"PartitionFilters: \[[^\]]*\]", plan._jdf.queryExecution().executedPlan().toString())
    assert scan and "subquery" in scan[0]
    sketches.refresh(store, "raw/t", ["many", "few", "number"], changed.select("Date"))
    after = {r[0] for r in store.read(name).select(F.col("_metadata.file_path")).collect()}
    assert len(files - after) == len(after - files) == 1
    assert found(store.read(name))["few"].distinct == 4
