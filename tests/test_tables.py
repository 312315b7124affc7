from __future__ import annotations

from datetime import date, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as hs
from pyspark.sql import functions as F

from gridspan import schemas
from gridspan.operators import slices
from gridspan.plans.ingest import refresh_primary
from gridspan.plans.standins import INSTANT
from gridspan.session import scratch
from gridspan.sinks.store import EmptyBatchError, Store

TABLE = "raw/t"


def frame(spark, cells):
    return spark.createDataFrame(cells, "Date date, Hour int, v double")


def day(n):
    return date(2025, 1, 1) + timedelta(days=n)


def history(spark):
    return frame(spark, [(day(0), h, 1.0) for h in range(1, 25)] + [(day(1), h, 0.0) for h in (1, 2, 3)])


def batch(spark):
    return frame(spark, [(day(1), h, 5.0) for h in range(1, 6)] + [(day(0), 1, 99.0)])


def content(df):
    return sorted(map(tuple, df.select("Date", "Hour", "v").collect()), key=repr)


def test_upsert_replaces_the_newest_date_and_is_idempotent(spark, store):
    store.replace_table(history(spark), TABLE)
    for _ in range(2):
        store.upsert(batch(spark), TABLE)
        after = store.read(TABLE)
        assert after.groupBy("Date").count().orderBy("Date").collect() == [(day(0), 24), (day(1), 5)]
        assert after.filter("v = 99").count() == 0


def test_upsert_of_all_dates(spark, store):
    store.replace_table(history(spark), TABLE)
    store.upsert(batch(spark), TABLE, mode="all_dates_in_batch")
    assert store.read(TABLE).groupBy("Date").count().orderBy("Date").collect() == [
        (day(0), 1), (day(1), 5),
    ]
    with pytest.raises(ValueError):
        store.upsert(batch(spark), TABLE, mode="other")


@pytest.mark.parametrize("mode", ["latest", "all_dates_in_batch"])
def test_empty_batch_changes_nothing(spark, store, mode):
    store.replace_table(history(spark), TABLE)
    before = content(store.read(TABLE))
    store.upsert(history(spark).limit(0), TABLE, mode=mode)
    assert content(store.read(TABLE)) == before
    assert content(slices.upserted(history(spark), history(spark).limit(0), mode=mode)) == before


def test_write_form_and_query_form_agree(spark, tmp_path):
    cell = hs.tuples(hs.integers(0, 4).map(day), hs.integers(1, 24), hs.just(1.0))
    cases = []

    @given(hs.lists(cell, min_size=1, max_size=8), hs.lists(cell, min_size=1, max_size=8))
    @settings(max_examples=4, deadline=None, database=None)
    def gather(old, new):
        cases.append((old, new))

    gather()
    for i, (old, new) in enumerate(cases):
        for mode in ("latest", "all_dates_in_batch"):
            store = Store(spark, str(tmp_path / f"{i}-{mode}"))
            target, fresh = frame(spark, old), frame(spark, new).withColumn("v", F.lit(2.0))
            store.replace_table(target, TABLE)
            store.upsert(fresh, TABLE, mode=mode)
            assert content(store.read(TABLE)) == content(slices.upserted(target, fresh, mode=mode))


def test_rows_without_a_date_survive_an_upsert(spark):
    target = frame(spark, [(None, 1, 1.0), (day(0), 1, 1.0)])
    for mode in ("latest", "all_dates_in_batch"):
        after = slices.upserted(target, frame(spark, [(day(0), 2, 2.0)]), mode=mode)
        assert content(after) == sorted([(None, 1, 1.0), (day(0), 2, 2.0)], key=repr)


def test_replace_slice(spark, store):
    store.replace_table(history(spark), TABLE)
    newest = slices.latest_slice(batch(spark))
    store.replace_slice(newest, TABLE, "2025-01-02")
    assert store.read(TABLE).count() == 29
    with pytest.raises(Exception, match="row outside slice"):
        store.replace_slice(batch(spark), TABLE, "2025-01-02")
    with pytest.raises(EmptyBatchError):
        store.replace_slice(newest.limit(0), TABLE, "2025-01-02")
    assert store.read(TABLE).count() == 29


def test_replace_table_takes_the_new_schema(spark, store):
    store.replace_table(history(spark), TABLE)
    store.replace_table(batch(spark).withColumn("w", F.lit("x")), TABLE)
    assert store.read(TABLE).count() == 6
    assert "w" in store.read(TABLE).columns


def test_a_hot_date_is_written_by_several_tasks(spark, store):
    """A third of the rows on one date must not become one file from one task."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100KB")
    try:
        rows = spark.range(300_000).select(
            F.when(F.col("id") % 3 == 0, F.lit(day(0)))
            .otherwise(F.date_add(F.lit(day(1)), (F.col("id") % 20).cast("int"))).alias("Date"),
            F.rand(1).alias("v"),
        )
        store.replace_table(rows, TABLE)
        files = store.read(TABLE).select("Date", F.input_file_name().alias("f")).distinct()
        sizes = {r.Date: r["count"] for r in files.groupBy("Date").count().collect()}
        assert sizes[day(0)] > 1
        assert store.read(TABLE).count() == 300_000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_register_counts_the_whole_table(spark, store):
    store.replace_table(history(spark).union(history(spark).filter("Date = '2025-01-01'")), TABLE)
    store.upsert(batch(spark), TABLE)
    store.append_register(TABLE, INSTANT)
    store.append_register(TABLE, INSTANT + timedelta(hours=1))
    register = store.register().orderBy("id").collect()
    first = 1735805045678000  # the instant in microseconds
    assert [(r.id, r.TABLE_NAME, r.TABLE_SCHEMA, r.ROW_COUNT) for r in register] == [
        (first, "t", "raw", 53), (first + 3_600_000_000, "t", "raw", 53),
    ]
    assert register[0].MODIFIED_DT == date(2025, 1, 2)


def test_register_of_two_tables_and_a_repeated_write(spark, store):
    for table in (TABLE, "raw/other", TABLE):
        store.replace_table(batch(spark), table)
        store.append_register(table, INSTANT)
    rows = store.register().collect()
    assert sorted(r.TABLE_NAME for r in rows) == ["other", "t"]


def test_ten_latest_register_rows(spark, store):
    store.replace_table(batch(spark), TABLE)
    for i in range(12):
        store.append_register(TABLE, INSTANT + timedelta(days=i))
    latest = store.latest_writes().collect()
    assert [r.MODIFIED_DT for r in latest] == [date(2025, 1, 13) - timedelta(days=i) for i in range(10)]


def zonal(spark, cells):
    rows = frame(spark, cells).withColumnRenamed("v", "Ontario_Demand")
    for name in [*schemas.ZONES, "Zone_Total", "Diff"]:
        rows = rows.withColumn(name, F.col("Ontario_Demand") + len(name))
    return rows.withColumn("Modified_DT", F.lit("2025-01-02 00:00:00").cast("timestamp_ntz"))


def test_primary_refresh_whole_and_changed_dates(spark, store):
    store.replace_table(zonal(spark, [(day(i), 1, 1.0) for i in range(4)]), schemas.ZONAL_DEMAND)
    refresh_primary(store, INSTANT)
    assert store.read(schemas.PRIMARY_ZONAL_DEMAND).count() == 40
    changed = zonal(spark, [(day(1), 1, 7.0), (day(3), 1, 8.0)])
    store.upsert(changed, schemas.ZONAL_DEMAND, mode="all_dates_in_batch")
    refresh_primary(store, INSTANT, changed)
    primary = store.read(schemas.PRIMARY_ZONAL_DEMAND)
    assert primary.count() == 40
    demand = primary.select("Date", "Ontario_Demand").distinct().orderBy("Date").collect()
    assert [r.Ontario_Demand for r in demand] == [1.0, 7.0, 1.0, 8.0]


def test_latest_slice_prunes_partitions_and_row_groups(spark, store):
    store.replace_table(history(spark), TABLE)
    plan = slices.latest_slice(store.read(TABLE))._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(Date" in plan and "Subquery" in plan
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    plan = slices.latest_slice(events, "ts")._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(ts,ScalarSubquery" in plan


def test_date_range(spark):
    row = slices.date_range(history(spark)).first()
    assert tuple(row) == (day(0), day(1), 27)


def test_upsert_query_never_shuffles_the_table_by_date(spark):
    after = slices.upserted(history(spark), batch(spark), mode="all_dates_in_batch")
    plan = after._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    with pytest.raises(TypeError):
        slices.calendar_dates(history(spark), "Hour")


def test_scratch_folders_are_new_and_shared(spark):
    class Context:
        master, applicationId = "spark://cluster", "app-1"

        @staticmethod
        def getCheckpointDir():
            return None

    class Session:
        def __init__(self, folder, master):
            self.conf = {"spark.checkpoint.dir": folder} if folder else {}
            self.sparkContext = Context()
            self.sparkContext.master = master

    shared = Session("hdfs://shared/dir/", "spark://cluster")
    first, second = scratch(shared, "x"), scratch(shared, "x")
    assert first != second and first.startswith("hdfs://shared/dir/gridspan/x-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch(Session(None, "spark://cluster"), "x")
    assert "gridspan-app-1-" in scratch(Session(None, "local[2]"), "x")
    assert "/gridspan/x-" in scratch(spark, "x")


def test_register_counts_without_reading_the_table(spark, store):
    """The sum over dates equals a count of the table, whatever was written how."""
    def counted():
        assert store.date_counts(TABLE).agg(F.sum("row_count")).first()[0] == store.read(TABLE).count()
        plan = store.date_counts(TABLE)._jdf.queryExecution().toString()
        assert store.path(TABLE) + "/" not in plan.replace(store.path(schemas.DATE_COUNTS), "")

    day = F.expr("date_add(DATE '2025-01-01', CAST(id % 5 AS INT))").alias("Date")
    rows = spark.range(50).select(day, "id")
    store.replace_table(rows, TABLE)
    store.append_register(TABLE, INSTANT)
    counted()
    for i, batch in enumerate([rows.filter("id < 13"), rows.filter("id < 13"), rows.filter("id < 0"), rows.filter("id % 5 = 4")]):
        store.upsert(batch, TABLE, mode="all_dates_in_batch", registered=True)
        store.append_register(TABLE, INSTANT, f"write-{max(i, 1)}", batch.select("Date"))
        counted()
    store.upsert(rows.filter("id < 7"), TABLE, mode="all_dates_in_batch")  # registered by nobody
    newest = rows.filter("id % 5 = 4")
    store.upsert(newest, TABLE, mode="all_dates_in_batch", registered=True)
    store.append_register(TABLE, INSTANT, "later", newest.select("Date"))
    counted()
    store.replace_table(rows.filter("id < 3"), TABLE)
    store.append_register(TABLE, INSTANT, "last", rows.select("Date"))
    counted()
