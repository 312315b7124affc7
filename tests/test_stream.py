from __future__ import annotations

import os
import time
from datetime import date

import pytest

from gridspan import schemas
from gridspan.plans import ingest
from gridspan.sinks.store import Store
from gridspan.sources import files
from gridspan.streaming import pickup
from gridspan.streaming.pickup import (
    UpstreamTimeout, await_refresh, pick_up, quarantine, refresh_from_register, rejected_reports,
)
from gridspan.streaming.versions import take_versions
from test_files import ZONAL, capability_text, fuel_text, mw, output


def run(store, name, tmp_path, instant, mode="latest", **options):
    landing, checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")
    query = pick_up(store, name, landing, checkpoint, lambda: instant, mode, **options)
    query.awaitTermination()
    assert query.exception() is None


def land(tmp_path, name, text):
    path = tmp_path / "landing" / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def demand(day, hours, value=10):
    return "Date,Hour,Market Demand,Ontario Demand\n" + "".join(
        f"2025-01-0{day},{h},{value},{value}\n" for h in hours
    )


def test_files_are_taken_once_across_restarts(spark, store, tmp_path, instant):
    land(tmp_path, "1.csv", demand(1, range(1, 25)))
    run(store, "demand", tmp_path, instant)
    land(tmp_path, "2.csv", demand(2, range(1, 4)))
    run(store, "demand", tmp_path, instant)
    run(store, "demand", tmp_path, instant)
    table = store.read(schemas.DEMAND)
    assert table.groupBy("Date").count().orderBy("Date").collect() == [
        (date(2025, 1, 1), 24), (date(2025, 1, 2), 3),
    ]
    assert store.register().count() == 2


def test_late_dates_are_ignored_or_taken_by_mode(spark, store, tmp_path, instant):
    land(tmp_path, "1.csv", demand(1, [1, 2]))
    run(store, "demand", tmp_path, instant)
    land(tmp_path, "2.csv", demand(1, [1, 2, 3], 99) + demand(2, [1]))
    run(store, "demand", tmp_path, instant)
    assert store.read(schemas.DEMAND).filter("Market_Demand = 99").count() == 0
    land(tmp_path, "3.csv", demand(1, [1, 2, 3], 99) + demand(2, [1]))
    run(store, "demand", tmp_path, instant, "all_dates_in_batch")
    table = store.read(schemas.DEMAND)
    assert table.filter("Market_Demand = 99").count() == 3 and table.count() == 4


def test_zonal_reaches_the_primary_table(spark, store, tmp_path, instant):
    land(tmp_path, "1.csv", ZONAL.replace("2025-01-02", "2025-01-01"))
    run(store, "zonal", tmp_path, instant)
    land(tmp_path, "2.csv", ZONAL)
    run(store, "zonal", tmp_path, instant)
    assert store.read(schemas.PRIMARY_ZONAL_DEMAND).count() == 40
    assert store.register().count() == 4


def test_xml_reports(spark, store, tmp_path, instant):
    land(tmp_path, "1.xml", fuel_text())
    run(store, "fuel", tmp_path, instant)
    assert store.read(schemas.FUEL_OUTPUT).count() == 1


def test_capability_reports(spark, store, tmp_path, instant):
    land(tmp_path, "1.xml", capability_text(output(1, mw(5)) + output(2, mw(6))))
    run(store, "capability", tmp_path, instant)
    assert store.read(schemas.CAPABILITY).count() == 2


def test_fetches_of_one_day_in_one_batch_leave_no_double_rows(spark, store, tmp_path, instant):
    land(tmp_path, "a.csv", demand(1, range(1, 25), 1))
    land(tmp_path, "b.csv", demand(1, [24], 2) + demand(2, [1, 2], 2))
    land(tmp_path, "c.csv", demand(2, [1, 2, 3], 3))
    for i, name in enumerate("abc"):
        os.utime(tmp_path / "landing" / f"{name}.csv", (1_700_000_000 + i, 1_700_000_000 + i))
    run(store, "demand", tmp_path, instant)
    table = store.read(schemas.DEMAND)
    assert table.groupBy("Date", "Market_Demand").count().orderBy("Date").collect() == [
        (date(2025, 1, 1), 1.0, 24), (date(2025, 1, 2), 3.0, 3),
    ]


def test_one_batch_equals_one_run_per_report(spark, tmp_path, instant):
    reports = [
        demand(1, range(1, 13), 1), demand(1, range(1, 25), 2), demand(1, [24], 3) + demand(2, [1], 3),
        demand(2, [1, 2], 4), demand(1, range(1, 25), 5) + demand(3, [1], 5), demand(2, [9], 6),
    ]
    for mode in ("latest", "all_dates_in_batch"):
        content = []
        for per_batch in (1, 4, None):
            folder = tmp_path / f"{mode}-{per_batch}"
            folder.mkdir()
            target = Store(spark, str(folder / "store"))
            for i, text in enumerate(reports):
                land(folder, f"{i}.csv", text)
                os.utime(folder / "landing" / f"{i}.csv", (1_700_000_000 + i,) * 2)
            run(target, "demand", folder, instant, mode, max_files=per_batch)
            content.append(sorted(map(tuple, target.read(schemas.DEMAND).collect())))
        assert content[0] == content[1] == content[2]


def test_files_of_a_folder_are_one_report(spark, store, tmp_path, instant):
    for fetch, value in ((1, 10), (2, 20)):
        for part, hours in (("a", range(1, 9)), ("b", range(9, 17)), ("c", range(17, 25))):
            land(tmp_path, f"fetch={fetch}/{part}.csv", demand(1, hours, value))
    for part in sorted((tmp_path / "landing").rglob("*.csv")):
        os.utime(part, (1_700_000_000, 1_700_000_000))
    run(store, "demand", tmp_path, instant)
    rows = store.read(schemas.DEMAND).collect()
    assert len(rows) == 24 and {r.Market_Demand for r in rows} == {20.0}


def test_a_broken_report_is_set_aside(spark, store, tmp_path, instant):
    land(tmp_path, "1.csv", demand(1, range(1, 25)))
    land(tmp_path, "2.csv", demand(2, range(1, 5)) + "2025-01-02,5,1,2,3\n")
    run(store, "demand", tmp_path, instant)
    land(tmp_path, "3.csv", demand(3, range(1, 4)))
    run(store, "demand", tmp_path, instant)
    counts = store.read(schemas.DEMAND).groupBy("Date").count().orderBy("Date").collect()
    assert counts == [(date(2025, 1, 1), 24), (date(2025, 1, 3), 3)]
    (rejected,) = rejected_reports(store).collect()
    assert rejected.report.endswith("/2.csv") and rejected.broken_rows == 1


def test_a_broken_document_is_set_aside(spark, store, tmp_path, instant):
    land(tmp_path, "1.xml", fuel_text())
    land(tmp_path, "2.xml", fuel_text().replace("</Hour>", "</Hou>", 1))
    run(store, "fuel", tmp_path, instant, "all_dates_in_batch")
    assert store.read(schemas.FUEL_OUTPUT).count() > 0
    assert rejected_reports(store).count() == 1


EMPTY_DAY = "<IMODocument><IMODocBody><DailyData><Day>2025-01-05</Day></DailyData></IMODocBody></IMODocument>"


def reasons(store):
    return sorted((r.report.split("/")[-1], r.reason) for r in rejected_reports(store).collect())


@pytest.mark.parametrize("bad", ["1.5", "", "n/a"])
def test_a_wrong_value_does_not_hold_up_other_reports(spark, store, tmp_path, instant, bad):
    land(tmp_path, "1.xml", fuel_text(first=bad).replace("2025", "2024"))
    land(tmp_path, "2.xml", fuel_text())
    run(store, "fuel", tmp_path, instant, "all_dates_in_batch")
    assert {r.Date.year for r in store.read(schemas.FUEL_OUTPUT).collect()} == {2025}
    assert reasons(store) == [("1.xml", "wrong value")]
    land(tmp_path, "3.xml", fuel_text().replace("2025", "2024"))
    run(store, "fuel", tmp_path, instant, "all_dates_in_batch")
    assert store.read(schemas.FUEL_OUTPUT).count() == 6


def test_a_lone_empty_report_is_recorded_and_the_next_one_taken_in(spark, store, tmp_path, instant):
    land(tmp_path, "1.xml", EMPTY_DAY)
    run(store, "fuel", tmp_path, instant)
    assert reasons(store) == [("1.xml", "too few rows")] and not store.exists(schemas.FUEL_OUTPUT)
    land(tmp_path, "2.xml", fuel_text())
    run(store, "fuel", tmp_path, instant)
    assert store.read(schemas.FUEL_OUTPUT).count() == 1


def test_empty_and_wrong_capability_reports(spark, store, tmp_path, instant):
    good = capability_text(output(1, mw(5)))
    land(tmp_path, "1.xml", "<IMODocument><IMODocBody><Date>2025-01-01</Date></IMODocBody></IMODocument>")
    land(tmp_path, "2.xml", capability_text(output(1, "<EnergyMW/>")).replace("2025", "2024"))
    land(tmp_path, "3.xml", capability_text(output("x", mw(1))).replace("2025", "2023"))
    land(tmp_path, "4.xml", good)
    run(store, "capability", tmp_path, instant, "all_dates_in_batch")
    assert [tuple(r) for r in store.read(schemas.CAPABILITY).select("Date", "OutputEnergy").collect()] == [
        (date(2025, 1, 2), 5.0)]
    assert reasons(store) == [("1.xml", "too few rows"), ("2.xml", "wrong value"), ("3.xml", "wrong value")]


def test_a_tolerant_pickup_keeps_wrong_values_apart(spark, store, tmp_path, instant):
    land(tmp_path, "1.xml", fuel_text(first="1.5"))
    run(store, "fuel", tmp_path, instant, "all_dates_in_batch", strict=False)
    rows = store.read(schemas.FUEL_OUTPUT).filter("fuel_type = 'NUCLEAR'").collect()
    assert [r.output for r in rows] == [None] and store.read(schemas.FUEL_OUTPUT).count() == 3
    (kept,) = quarantine(store).collect()
    assert (kept.field, kept.text, kept.table) == ("output", "1.5", schemas.FUEL_OUTPUT)
    assert kept.report.endswith("/1.xml") and '"fuel_type":"NUCLEAR"' in kept.row


def test_a_tolerant_job_keeps_lines_apart(spark, store, tmp_path, instant):
    land(tmp_path, "1.csv", demand(1, [1, 2]) + "2025-01-01,3,1,2,3\n")
    raw = files.scan_demand_csv(spark.read, str(tmp_path / "landing"))
    ingest.ingest(store, "demand", raw, instant, strict=False)
    assert store.read(schemas.DEMAND).count() == 2
    (kept,) = quarantine(store).collect()
    assert (kept.field, kept.text, kept.report) == ("row", "2025-01-01,3,1,2,3", None)
    ingest.ingest(store, "demand", raw, instant, strict=False)  # a repeated write
    assert quarantine(store).count() == 1


def test_reports_written_anew_under_one_name(spark, store, tmp_path, instant):
    landing, versions = str(tmp_path / "fetched"), str(tmp_path / "landing")
    (tmp_path / "fetched").mkdir()

    def fetch(value, hours):
        (tmp_path / "fetched" / "report.csv").write_text(demand(1, hours, value))
        time.sleep(0.01)

    for value, hours in ((1, [1]), (2, [1, 2]), (3, [1, 2, 3])):
        fetch(value, hours)
        assert take_versions(store, landing, versions) == 1
        assert take_versions(store, landing, versions) == 0
        if value != 2:  # two versions in one batch are in order of their times
            run(store, "demand", tmp_path, instant)
        if value == 1:
            assert store.read(schemas.DEMAND).count() == 1
    rows = store.read(schemas.DEMAND).collect()
    assert len(rows) == 3 and {r.Market_Demand for r in rows} == {3.0}


def test_versions_in_small_steps_and_after_a_stop(spark, store, tmp_path, instant):
    landing, versions = str(tmp_path / "fetched"), str(tmp_path / "landing")
    (tmp_path / "fetched").mkdir()
    for day in range(1, 6):
        (tmp_path / "fetched" / f"a b+%20é{day}.csv").write_text(demand(day, [1]))
    assert take_versions(store, landing, versions, most=2) == 2
    # A run that stopped before it noted its copies takes them again, to the same folders.
    stopped = Store(spark, str(tmp_path / "other"))
    assert take_versions(stopped, landing, versions, most=3) == 3
    assert [take_versions(store, landing, versions, most=2) for _ in range(3)] == [2, 1, 0]
    run(store, "demand", tmp_path, instant, "all_dates_in_batch")
    assert store.read(schemas.DEMAND).count() == 5


def test_the_primary_table_follows_the_register(spark, store, tmp_path, instant):
    checkpoint = str(tmp_path / "primary-checkpoint")

    def refresh(interval=None):
        return refresh_from_register(store, checkpoint, lambda: instant, interval)

    land(tmp_path, "1.csv", ZONAL.replace("2025-01-02", "2025-01-01"))
    run(store, "zonal", tmp_path, instant, primary=False)
    assert not store.exists(schemas.PRIMARY_ZONAL_DEMAND)
    refresh().awaitTermination()
    assert store.read(schemas.PRIMARY_ZONAL_DEMAND).count() == 20
    # Two raw writes without a refresh between them, as after a stop.
    land(tmp_path, "2.csv", ZONAL)
    run(store, "zonal", tmp_path, instant, primary=False)
    land(tmp_path, "3.csv", ZONAL.replace("2025-01-02", "2025-01-03"))
    run(store, "zonal", tmp_path, instant, primary=False)
    refresh().awaitTermination()
    assert store.read(schemas.PRIMARY_ZONAL_DEMAND).count() == 60
    counts = {r.TABLE_NAME: r.ROW_COUNT for r in store.register().orderBy("ROW_COUNT").collect()}
    assert counts == {"zonal_demand": 60}
    waiting = refresh("1 second")
    try:
        with pytest.raises(UpstreamTimeout):
            await_refresh(waiting, 3)
    finally:
        waiting.stop()


def test_a_replayed_batch_changes_nothing(spark, store, tmp_path, instant):
    land(tmp_path, "1.csv", demand(1, range(1, 25)))
    land(tmp_path, "2.xml.csv", demand(2, [1, 2]) + "2025-01-02,3,1,2,3\n")
    run(store, "demand", tmp_path, instant, "all_dates_in_batch")
    before = [sorted(map(str, df.collect())) for df in (store.read(schemas.DEMAND), store.register(), rejected_reports(store), store.date_counts(schemas.DEMAND))]
    (commit,) = (tmp_path / "checkpoint" / "commits").glob("0")
    commit.unlink()  # as if the batch had stopped after its writes
    for crc in (tmp_path / "checkpoint" / "commits").glob(".0*"):
        crc.unlink()
    run(store, "demand", tmp_path, instant, "all_dates_in_batch")
    after = [sorted(map(str, df.collect())) for df in (store.read(schemas.DEMAND), store.register(), rejected_reports(store), store.date_counts(schemas.DEMAND))]
    assert before == after


def test_a_batch_is_stored_once(spark, store, tmp_path, instant, monkeypatch):
    stored = []
    keep = pickup.materialize
    monkeypatch.setattr(pickup, "materialize", lambda df, label: (stored.append(label), keep(df, label))[1])
    land(tmp_path, "1.xml", fuel_text())
    run(store, "fuel", tmp_path, instant, "all_dates_in_batch")
    assert store.read(schemas.FUEL_OUTPUT).count() == 3
    assert stored == ["bad-reports"]  # small; the typed batch itself is stored by `stage`
