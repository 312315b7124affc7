from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gridspan import schemas
from gridspan.operators import quality, typing
from gridspan.operators.reshape import wide_to_long
from gridspan.operators.slices import latest_slice
from gridspan.plans import ingest, standins
from gridspan.sinks.store import EmptyBatchError
from gridspan.sources import files

DEMAND = """\\\\Hourly Demand Report,,,
Date,Hour,Market Demand,Ontario Demand
2025-01-01,23,16000,14500
2025-01-01,24,15800,14100
2025-01-02,1,15500,13900
2025-01-02,2,bad,13700
2025-1-2,3,15300,13600
2025-13-02,4,1,1
2025-01-02,25,15000,-5
"""
ZONAL = """2025-01-02,1,14000,500,1200,1000,900,5000,1100,60,2900,500,1500,14660,660
2025-01-02,2,13800,500,,1000,900,4900,1100,60,2800,500,1500,13260,-540
"""
FUEL = """<IMODocument{ns}><{p}IMODocBody>
 <{p}DailyData><{p}Day>2025-01-01</{p}Day>
  <{p}HourlyData><{p}Hour>1</{p}Hour>
   <{p}FuelTotal><{p}Fuel>NUCLEAR</{p}Fuel><{p}EnergyValue><{p}Output>{first}</{p}Output></{p}EnergyValue></{p}FuelTotal>
   <{p}FuelTotal><{p}Fuel>GAS</{p}Fuel><{p}EnergyValue/></{p}FuelTotal></{p}HourlyData></{p}DailyData>
 <{p}DailyData><{p}Day>2025-01-02</{p}Day>
  <{p}HourlyData><{p}Hour>1</{p}Hour><{p}FuelTotal><{p}Fuel>WIND</{p}Fuel><{p}EnergyValue><{p}Output>100</{p}Output></{p}EnergyValue></{p}FuelTotal></{p}HourlyData>
 </{p}DailyData></{p}IMODocBody></IMODocument>
"""
NAMESPACES = {
    "default": (' xmlns="urn:any"', ""),
    "prefixed": (' xmlns:x="urn:any"', "x:"),
    "none": ("", ""),
}


def fuel_text(kind="default", first="9000"):
    ns, prefix = NAMESPACES[kind]
    return FUEL.format(ns=ns, p=prefix, first=first)


def capability_text(outputs, more="", wrap=True):
    body = f"""<Generator><GeneratorName>A1</GeneratorName><FuelType>GAS</FuelType>
  <Outputs>{outputs}</Outputs>{more}</Generator>
  <Generator><GeneratorName>B2</GeneratorName><FuelType>WIND</FuelType></Generator>"""
    body = f"<Generators>{body}</Generators>" if wrap else body
    return f'<IMODocument xmlns="urn:any"><IMODocBody><Date>2025-01-02</Date>{body}</IMODocBody></IMODocument>'


def output(hour, energy=None):
    return f"<Output><Hour>{hour}</Hour>{'' if energy is None else energy}</Output>"


def mw(value):
    return f"<EnergyMW>{value}</EnergyMW>"


def landed(tmp_path, text, name="report.txt"):
    folder = tmp_path / "landing"
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)
    return str(folder)


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_demand_report(spark, tmp_path, instant):
    raw = files.scan_demand_csv(spark.read, landed(tmp_path, DEMAND))
    typed = typing.type_demand(raw, instant)
    assert typed.count() == 6
    latest = latest_slice(typed)
    stamp = date(2025, 1, 2)
    assert rows(latest, "Hour") == [
        (stamp, 1, 15500.0, 13900.0, stamp),
        (stamp, 2, None, 13700.0, stamp),
        (stamp, 3, 15300.0, 13600.0, stamp),
        (stamp, 25, 15000.0, -5.0, stamp),
    ]
    failed = quality.check_demand(latest).filter("NOT passed").select("rule", "column", "violations")
    assert sorted(map(tuple, failed.collect())) == [
        ("hour_range", "Hour", 1),
        ("non_negative", "Ontario_Demand", 1),
        ("not_null", "Market_Demand", 1),
    ]


def test_short_and_over_long_lines(spark, tmp_path, instant):
    text = '2025-01-02,1,10\n2025-01-02,2,10,20,30\n2025-01-02,3,"1,5",20\n'
    raw = files.scan_demand_csv(spark.read, landed(tmp_path, text))
    long = raw.select("Hour", files.over_long_rows(schemas.DEMAND_COLUMNS).alias("long"))
    assert rows(long, "Hour") == [("1", False), ("2", True), ("3", False)]
    assert rows(typing.type_demand(raw, instant).select("Hour", "Ontario_Demand"), "Hour") == [
        (1, None), (2, 20.0), (3, 20.0),
    ]
    with pytest.raises(Exception, match="too many fields"):
        ingest.typed_batch(ingest.FEEDS["demand"], raw, instant).collect()


def test_heading_only_demand_is_no_error_and_changes_nothing(spark, tmp_path, store, instant):
    path = landed(tmp_path, DEMAND)
    ingest.ingest(store, "demand", files.scan_demand_csv(spark.read, path), instant)
    before = rows(store.read(schemas.DEMAND), "Hour")
    (tmp_path / "landing" / "report.txt").write_text("\n".join(DEMAND.split("\n")[:2]))
    later = instant + timedelta(hours=1)
    ingest.ingest(store, "demand", files.scan_demand_csv(spark.read, path), later)
    assert rows(store.read(schemas.DEMAND), "Hour") == before
    assert store.register().count() == 2


def test_validation_stops_a_bad_batch(spark, tmp_path, store, instant):
    raw = files.scan_demand_csv(spark.read, landed(tmp_path, DEMAND))
    with pytest.raises(quality.DataCheckError, match="hour_range"):
        ingest.ingest(store, "demand", raw, instant, validate=True)
    assert not store.exists(schemas.DEMAND)


def test_archive_layout_drops_any_null(spark, tmp_path):
    text = "Date,Hour,Market Demand,Ontario Demand\n2025-01-02,1,10,20\n2025-01-02,2,,20\n"
    raw = files.scan_archive_csv(spark.read, landed(tmp_path, text))
    typed = typing.type_archive_demand(raw)
    assert typed.columns == schemas.ARCHIVE_DEMAND_COLUMNS
    assert rows(typed, "Hour") == [(date(2025, 1, 2), "1", "10", "20")]


def test_zonal_report_to_long(spark, tmp_path, instant):
    typed = typing.type_zonal(files.scan_zonal_csv(spark.read, landed(tmp_path, ZONAL)), instant)
    assert typed.first().Modified_DT == datetime(2025, 1, 2, 3, 4, 5)
    long = wide_to_long(typed)
    assert long.columns == [*schemas.ZONAL_IDS, "Zone", "Value"]
    assert long.count() == 20
    assert long.filter("Value IS NULL").select("Zone", "Hour").collect() == [("Northeast", 2)]
    wide_sum = typed.agg(sum((F.sum(z) for z in schemas.ZONES), F.lit(0.0))).first()[0]
    assert long.agg(F.sum("Value")).first()[0] == wide_sum


def test_wide_to_long_open_form_and_missing_ids(spark, tmp_path, instant):
    typed = typing.type_zonal(files.scan_zonal_csv(spark.read, landed(tmp_path, ZONAL)), instant)
    extra = typed.withColumn("Export", F.lit(1.0))
    assert wide_to_long(extra, values=None).count() == 22
    with pytest.raises(KeyError, match="Diff"):
        wide_to_long(typed.drop("Diff"))


def test_series_with_header(spark, tmp_path):
    path = landed(tmp_path, "timestamp,Ontario_Demand\n2025-01-01 01:00:00,5\n2025-01-01 00:00:00,4.5\n")
    raw = files.scan_series_csv(spark.read, path, ["timestamp", "Ontario_Demand"])
    assert rows(typing.type_series(raw, "timestamp", "Ontario_Demand"), "timestamp") == [
        (datetime(2025, 1, 1, 0), 4.5), (datetime(2025, 1, 1, 1), 5.0),
    ]


@pytest.mark.parametrize("kind", list(NAMESPACES))
def test_fuel_report(spark, tmp_path, kind):
    flat = typing.flatten_fuel(files.scan_fuel_xml(spark.read, landed(tmp_path, fuel_text(kind))))
    assert dict(flat.dtypes) == {
        "Date": "date", "hour": "int", "fuel_type": "string", "output": "bigint",
    }
    assert rows(flat, "Date", "fuel_type") == [
        (date(2025, 1, 1), 1, "GAS", None),
        (date(2025, 1, 1), 1, "NUCLEAR", 9000),
        (date(2025, 1, 2), 1, "WIND", 100),
    ]
    assert latest_slice(flat).count() == 1


def test_fuel_from_text_column(spark):
    day = "<DailyData><Day>2025-01-01</Day><HourlyData><Hour></Hour><FuelTotal><Fuel>GAS</Fuel>" \
          "<EnergyValue><Output>7</Output></EnergyValue></FuelTotal></HourlyData></DailyData>"
    parsed = spark.createDataFrame([(day,)], "x string").select(
        F.from_xml("x", schemas.FUEL_DAY).alias("d")
    )
    assert rows(typing.flatten_fuel(parsed.select("d.*")), "Date") == [
        (date(2025, 1, 1), None, "GAS", 7)
    ]


@pytest.mark.parametrize("bad", ["1.5", "", "n/a"])
def test_fuel_strict_and_tolerant(spark, tmp_path, bad):
    days = files.scan_fuel_xml(spark.read, landed(tmp_path, fuel_text(first=bad)))
    with pytest.raises(Exception, match="not an integer"):
        typing.flatten_fuel(days).collect()
    tolerant = typing.flatten_fuel(days, strict=False).filter("fuel_type = 'NUCLEAR'")
    assert [r.output for r in tolerant.collect()] == [None]


def test_reports_without_rows_fail(spark, tmp_path, store, instant):
    path = landed(tmp_path, "<IMODocument><IMODocBody/></IMODocument>")
    with pytest.raises(EmptyBatchError):
        ingest.ingest(store, "fuel", files.scan_fuel_xml(spark.read, path), instant)
    with pytest.raises(EmptyBatchError):
        ingest.full_load(store, "capability", files.scan_capability_xml(spark.read, path), instant)


@pytest.mark.parametrize("wrap", [True, False])
def test_capability_report(spark, tmp_path, wrap):
    more = f"<Capabilities><Capability><Hour>3</Hour>{mw(9)}</Capability></Capabilities>"
    text = capability_text(output(1, mw(5)) + output(1, mw(6)) + output(2), more, wrap)
    flat = typing.flatten_capability(files.scan_capability_xml(spark.read, landed(tmp_path, text)))
    day = date(2025, 1, 2)
    assert rows(flat, "Hour") == [
        (day, 1, "A1", "GAS", 6.0, 0.0, 0.0), (day, 3, "A1", "GAS", 0.0, 9.0, 0.0),
    ]


def test_capability_hours_are_numbers_and_order_is_kept(spark, tmp_path):
    text = capability_text(output("01", mw(4)) + output("1", mw(3)) + output("10", mw(1)))
    flat = typing.flatten_capability(files.scan_capability_xml(spark.read, landed(tmp_path, text)))
    assert rows(flat.select("Hour", "OutputEnergy"), "Hour") == [(1, 3.0), (10, 1.0)]


def test_capability_empty_energy_is_a_failure(spark, tmp_path):
    reports = files.scan_capability_xml(
        spark.read, landed(tmp_path, capability_text(output(1, "<EnergyMW/>")))
    )
    with pytest.raises(Exception, match="not a number"):
        typing.flatten_capability(reports).collect()
    tolerant = typing.flatten_capability(reports, strict=False)
    assert rows(tolerant.select("Hour", "OutputEnergy"), "Hour") == [(1, 0.0)]


def test_equal_generator_names_stay_apart(spark, tmp_path):
    one = capability_text(output(1, mw(5)))
    two = one.replace("B2", "A1").replace(
        "<FuelType>WIND</FuelType>", f"<FuelType>GAS</FuelType><Outputs>{output(1, mw(8))}</Outputs>"
    )
    flat = typing.flatten_capability(files.scan_capability_xml(spark.read, landed(tmp_path, two)))
    assert rows(flat.select("GeneratorName", "Hour", "OutputEnergy"), "OutputEnergy") == [
        ("A1", 1, 5.0), ("A1", 1, 8.0),
    ]


def test_broken_xml_fails_unless_tolerant(spark, tmp_path):
    path = landed(tmp_path, fuel_text()[:300])
    with pytest.raises(Exception):
        files.scan_fuel_xml(spark.read, path).collect()
    tolerant = files.scan_fuel_xml(spark.read, path, strict=False).collect()
    assert [r[files.REJECT] is not None for r in tolerant] == [False, True]


def test_full_load_keeps_all_dates_and_no_register_row(spark, tmp_path, store, instant):
    ingest.full_load(store, "fuel", files.scan_fuel_xml(spark.read, landed(tmp_path, fuel_text())), instant)
    assert store.read(schemas.FUEL_OUTPUT).count() == 3
    assert not store.exists(schemas.TABLE_REGISTER)


@pytest.mark.parametrize("prefix", ["", "x:"])
def test_a_large_document_is_parsed_by_many_tasks(spark, tmp_path, prefix):
    """Block by block, equal to the scan of the whole file."""
    p, ns = prefix, ' xmlns:x="urn:any"' if prefix else ' xmlns="urn:any"'
    entry = "<{p}Output>\n<{p}Hour>{h}</{p}Hour><{p}EnergyMW>{h}.5</{p}EnergyMW></{p}Output>"
    blocks = "".join(
        f"<{p}Generator><{p}GeneratorName>G{i} &amp; Co</{p}GeneratorName><{p}FuelType>GAS</{p}FuelType>\n"
        f"<{p}Outputs>{''.join(entry.format(p=p, h=h) for h in (1, 2, 3))}</{p}Outputs></{p}Generator>\n"
        for i in range(400)
    )
    text = f"<IMODocument{ns}><{p}IMODocBody><{p}Date>2025-01-02</{p}Date><{p}Generators>{blocks}</{p}Generators></{p}IMODocBody></IMODocument>"
    text = text.replace("<IMODocument", f"<{p}IMODocument").replace("</IMODocument", f"</{p}IMODocument")
    path = landed(tmp_path, text)
    whole = typing.flatten_capability(files.scan_capability_xml(spark.read, path))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        pieces = files.scan_generator_blocks(spark, path, prefix)
        assert spark.read.option("lineSep", f"</{prefix}Generator>").text(path).rdd.getNumPartitions() > 4
        got = rows(typing.flatten_capability(pieces), "GeneratorName", "Hour")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(got) == 1200 and got == rows(whole, "GeneratorName", "Hour")


def line_items(spark, n=3000):
    numbers = spark.range(n)
    return numbers.select(
        F.col("id").alias("l_orderkey"), (F.col("id") * 7 % 90).alias("l_partkey"),
        (F.col("id") % 60).alias("l_suppkey"), (F.col("id") % 50 + 0.0).alias("l_quantity"),
        F.element_at(F.array(*map(F.lit, "ANR")), (F.col("id") % 3 + 1).cast("int")).alias("l_returnflag"),
        F.timestamp_seconds(F.col("id") % 9 * 1_300_000).alias("l_shipdate"),
    )


@pytest.mark.parametrize("by", [None, "month"])
def test_landed_xml_files_are_bounded(spark, tmp_path, monkeypatch, by):
    monkeypatch.setattr(standins, "FILE_REPORTS", 4)
    days = standins.item_fuel_days(line_items(spark))
    column = F.substring("Day", 1, 7) if by else None
    path = standins.land_xml(days, str(tmp_path / "landing"), "DailyData", by=column)
    raw = files.scan_fuel_xml(spark.read, path).withColumn("file", F.col("_metadata.file_path"))
    assert raw.groupBy("file").count().agg(F.max("count")).first()[0] <= 4
    fields = ("Date", "fuel_type", "hour", "output")
    text = F.to_xml(F.struct("Day", "HourlyData"), {"rowTag": "DailyData"})
    parsed = days.select(F.from_xml(text, schemas.FUEL_DAY).alias("d")).select("d.*")
    got, expected = (rows(typing.flatten_fuel(x), *fields) for x in (raw, parsed))
    assert len(got) > 100 and got == expected


def test_a_documents_lines_are_brought_together_once(spark):
    plan = standins.item_fuel_days(line_items(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1


def test_a_document_in_parts_is_no_tasks_whole_work(spark, tmp_path):
    items = line_items(spark)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = standins.land_one_document(items, str(tmp_path / "landing"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = sorted((tmp_path / "landing").glob("part-*"))
    assert len(parts) > 4
    whole = tmp_path / "whole.xml"
    whole.write_text("".join(p.read_text() for p in parts))
    pieces = files.scan_generator_blocks(spark, path, parts=True)
    order = ("GeneratorName", "Hour", "FuelType")
    got = rows(typing.flatten_capability(pieces), *order)
    expected = typing.flatten_capability(files.scan_capability_xml(spark.read, str(whole)))
    assert len(got) > 100 and got == rows(expected, *order)
