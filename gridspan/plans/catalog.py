"""The registered queries: every operator, run over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspan import functions as G
from gridspan import schemas
from gridspan.operators import align, ordering, profile, quality, reshape, sketches, slices, typing
from gridspan.operators import forecast as fc
from gridspan.plans import forecasting, ingest
from gridspan.plans import standins as st
from gridspan.session import scratch
from gridspan.sinks.store import Store, latest_writes
from gridspan.sources import files
from gridspan.streaming.pickup import pick_up, quarantine, refresh_from_register, rejected_reports
from gridspan.streaming.versions import take_versions

#: Numbers at and beyond the ends of what a double holds.
EXTREMES = ["1e308", "1.5e308", "0.001e310", "1e309", "Infinity", "-inf"]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def query(make: Query) -> Query:
    QUERIES[make.__name__] = make
    return make


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return st.table(spark, sf_dir, "events")


def _store(spark: SparkSession, label: str) -> Store:
    return Store(spark, scratch(spark, label))


def _last_dates(events: DataFrame, days: int) -> DataFrame:
    """Dated events of the newest `days` dates."""
    dated = st.dated_events(events)
    first = dated.agg(F.date_sub(F.max("Date"), days - 1)).scalar()
    return dated.filter(F.col("Date") >= first)


# Slices, ranges, typing


@query
def latest_slice_events(spark, sf_dir):
    rows = slices.latest_slice(_events(spark, sf_dir), "ts")
    return rows.select("event_id", "ts", "user_id", "event_type", "value")


@query
def batch_date_range(spark, sf_dir):
    return slices.date_range(_events(spark, sf_dir), "ts", by=["event_type"])


@query
def coerce_typed(spark, sf_dir):
    """Line items as dirty text: dates in five layouts, hours and prices with bad values."""
    items = st.table(spark, sf_dir, "lineitem")
    line, price = F.col("l_linenumber"), F.col("l_extendedprice").cast("decimal(18,2)")
    day = F.to_date("l_shipdate").cast("string")
    date_text = (
        F.when(line == 2, F.replace(day, F.lit("-0"), F.lit("-")))
        .when(line == 3, F.replace(day, F.lit("-"), F.lit("")))
        .when(line == 4, F.concat(F.lit(" "), day))
        .when(line == 5, F.concat(day.substr(1, 5), F.lit("13"), day.substr(8, 3)))
        .otherwise(day)
    )
    price_text = (
        F.when(F.col("l_returnflag") == "N", F.concat(price.cast("string"), F.lit("d")))
        .when((F.col("l_returnflag") == "R") & (line == 1), F.lit("nan"))
        .when((F.col("l_returnflag") == "R") & (line == 2), F.lit("1,000"))
        .when(
            (F.col("l_returnflag") == "R") & (line == 6),
            F.get(F.array(*map(F.lit, EXTREMES)), F.col("l_partkey") % len(EXTREMES)),
        )
        .otherwise(price.cast("string"))
    )
    hour = (F.col("l_quantity") + F.col("l_discount")).cast("decimal(18,2)")
    raw = items.select(
        "l_orderkey", "l_partkey", "l_linenumber", date_text.alias("Date"),
        hour.cast("string").alias("Hour"), price_text.alias("Market_Demand"),
    )
    return raw.filter(G.is_date("Date")).select(
        "l_orderkey", "l_partkey", "l_linenumber", F.col("Date").try_cast("date").alias("Date"),
        G.coerce_hour("Hour").alias("Hour"),
        G.coerce_number("Market_Demand").alias("Market_Demand"),
    )


@query
def strict_numbers(spark, sf_dir):
    """Null-preserving strict conversion of integer and decimal text."""
    items = st.table(spark, sf_dir, "lineitem")
    units = F.col("l_quantity").cast("bigint").cast("string")
    price = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    raw = items.select(
        "l_orderkey", "l_partkey", "l_linenumber",
        F.when(F.col("l_returnflag") != "R", units).alias("units"),
        F.when(F.col("l_linestatus") == "F", price).alias("price"),
    )
    return raw.select(
        "l_orderkey", "l_partkey", "l_linenumber", G.strict_int("units").alias("output"),
        G.strict_double("price").alias("energy"),
        G.value_or_zero(G.strict_double("price")).alias("energy_or_zero"),
    )


@query
def free_form_dates(spark, sf_dir):
    """Order dates written in a different layout per priority."""
    orders = st.table(spark, sf_dir, "orders")
    layouts = ["yyyy-MM-dd", "yyyy/MM/dd", "MM/dd/yyyy", "yyyyMMdd", "MMM d, yyyy"]
    text = F.lit(None).cast("string")
    for number, layout in enumerate(layouts, start=1):
        text = F.when(
            F.col("o_orderpriority").startswith(str(number)),
            F.date_format("o_orderdate", layout),
        ).otherwise(text)
    raw = orders.select("o_orderkey", "o_orderpriority", text.alias("day"))
    return raw.select(
        "o_orderkey", "o_orderpriority", G.parse_any_date("day").alias("order_date")
    )


@query
def load_stamps(spark, sf_dir):
    """Event instants, taken as UTC, as Toronto load dates and load seconds."""
    return _events(spark, sf_dir).select(
        "event_id",
        G.load_date(F.col("ts")).alias("load_date"),
        G.load_second(F.col("ts")).alias("load_second"),
    )


@query
def text_hour_order(spark, sf_dir):
    """Hours kept as text, ranked in numeric order."""
    hours = _events(spark, sf_dir).select(F.hour("ts").cast("string").alias("hour_text"))
    distinct = profile.distinct_values(hours, "hour_text")
    number = distinct.withColumn("hour", G.strict_int("hour_text"))
    ranked = ordering.with_position(number, ["hour"])
    return ranked.select("hour_text", "row_count", F.col("pos").cast("bigint").alias("pos"))


# Reshape, alignment, de-duplication


@query
def hourly_wide(spark, sf_dir):
    return st.hourly_wide(_events(spark, sf_dir))


@query
def wide_to_long(spark, sf_dir):
    return reshape.wide_to_long(st.zonal(_events(spark, sf_dir)))


@query
def wide_to_long_items(spark, sf_dir):
    wide = st.item_zones(st.table(spark, sf_dir, "lineitem"))
    return reshape.wide_to_long(wide, ids=["l_suppkey", "Date"])


@query
def wide_to_long_missing_id(spark, sf_dir):
    """A table that lacks ids is refused by name; what it has is reshaped when asked for."""
    wide = st.zonal_items(st.table(spark, sf_dir, "lineitem")).drop("Hour", "Diff")
    try:
        return reshape.wide_to_long(wide)
    except KeyError as error:
        ids = [c for c in schemas.ZONAL_IDS if c in wide.columns]
        refused = F.lit(error.args[0]).alias("refused")
        return reshape.wide_to_long(wide, ids=ids).select("*", refused)


@query
def xml_fuel_flatten(spark, sf_dir):
    """Nested XML text per day, parsed back and flattened to rows."""
    parsed = st.fuel_xml(_events(spark, sf_dir)).select(
        F.from_xml("xml", schemas.FUEL_DAY, {"mode": "FAILFAST"}).alias("day")
    )
    return typing.flatten_fuel(parsed.select("day.*"))


@query
def align_measures(spark, sf_dir):
    items = st.table(spark, sf_dir, "lineitem")
    return align.align_measures(
        items,
        keys=["l_suppkey", "l_linenumber"],
        tag="l_returnflag",
        measures={"OutputEnergy": "A", "CapabilityEnergy": "N", "AvailCapacity": "R"},
        value="l_quantity",
        order=["l_shipdate", "l_orderkey", "l_partkey", "l_quantity"],
    )


@query
def key_union(spark, sf_dir):
    items = st.table(spark, sf_dir, "lineitem")
    listed = items.filter(F.col("l_returnflag").isin("A", "N", "R"))
    return align.key_union([listed], ["l_suppkey", "l_linenumber"])


@query
def last_wins(spark, sf_dir):
    return align.last_wins(
        _events(spark, sf_dir), ["user_id", "event_type"], ["ts", "event_id"], ["value"]
    )


# Report files, end to end


@query
def demand_csv_ingest(spark, sf_dir):
    """Headerless demand lines with headings, landed, typed and upserted."""
    store = _store(spark, "demand")
    landing = st.land_csv(st.demand(_events(spark, sf_dir)), store.path("landing"))
    ingest.ingest(store, "demand", files.scan_demand_csv(spark.read, landing), st.INSTANT)
    return store.read(schemas.DEMAND)


@query
def demand_full_load(spark, sf_dir):
    store = _store(spark, "demand-full")
    landing = st.land_csv(st.demand(_events(spark, sf_dir)), store.path("landing"))
    raw = files.scan_demand_csv(spark.read, landing)
    ingest.full_load(store, "demand", raw, st.INSTANT)
    return store.read(schemas.DEMAND)


@query
def demand_items_load(spark, sf_dir):
    """Every line item as a landed demand line, typed and loaded."""
    store = _store(spark, "demand-items")
    lines = st.item_lines(st.table(spark, sf_dir, "lineitem"))
    landing = st.land_csv(lines, store.path("landing"))
    raw = files.scan_demand_csv(spark.read, landing)
    ingest.full_load(store, "demand", raw, st.INSTANT)
    return store.read(schemas.DEMAND)


@query
def archive_csv(spark, sf_dir):
    """The older demand layout: a NULL in any column drops the row."""
    wide = st.hourly_wide(_events(spark, sf_dir))
    report = wide.select("Date", "Hour", F.col("Essa"), F.col("West"))
    landing = st.land_csv(report, scratch(spark, "archive"))
    rows = typing.type_archive_demand(files.scan_archive_csv(spark.read, landing))
    return rows.select(
        "Date", G.coerce_hour("Hour").alias("Hour"),
        G.coerce_number(F.col("`Market Demand`")).alias("Market_Demand"),
        G.coerce_number(F.col("`Ontario Demand`")).alias("Ontario_Demand"),
    )


@query
def series_csv_sorted(spark, sf_dir):
    """An exported series with a header line, typed and sorted by time."""
    series = st.hourly_series(_events(spark, sf_dir)).select("timestamp", "Ontario_Demand")
    landing = scratch(spark, "series")
    text = series.select(F.col("timestamp").cast("string").alias("timestamp"), "Ontario_Demand")
    text.write.option("header", "true").csv(landing)
    raw = files.scan_series_csv(spark.read, landing, ["timestamp", "Ontario_Demand"])
    return typing.type_series(raw, "timestamp", "Ontario_Demand").orderBy("timestamp")


@query
def zonal_csv_to_primary(spark, sf_dir):
    """Zonal lines to the raw table, then wide to long into the primary table."""
    store = _store(spark, "zonal")
    wide = st.hourly_wide(_events(spark, sf_dir)).select(schemas.ZONAL_COLUMNS)
    landing = st.land_csv(wide, store.path("landing"))
    raw = files.scan_zonal_csv(spark.read, landing)
    ingest.full_load(store, "zonal", raw, st.INSTANT)
    ingest.refresh_primary(store, st.INSTANT)
    return store.read(schemas.PRIMARY_ZONAL_DEMAND)


@query
def fuel_xml_ingest(spark, sf_dir):
    """Nested fuel reports as files; the newest date is upserted."""
    store = _store(spark, "fuel")
    days = st.fuel_days(_events(spark, sf_dir))
    landing = st.land_xml(days, store.path("landing"), "DailyData")
    raw = files.scan_fuel_xml(spark.read, landing)
    ingest.ingest(store, "fuel", raw, st.INSTANT)
    return store.read(schemas.FUEL_OUTPUT)


@query
def capability_xml_scan(spark, sf_dir):
    """Generator reports as files: three hour lists per generator, aligned."""
    reports = st.capability_reports(st.table(spark, sf_dir, "lineitem"))
    landing = st.land_xml(reports, scratch(spark, "capability"), "IMODocBody")
    return typing.flatten_capability(files.scan_capability_xml(spark.read, landing))


@query
def capability_ingest(spark, sf_dir):
    """All reports loaded without output, then the newest date's report replaced by its job.

    Reports land in a folder per date, so the job scans one folder.
    """
    store = _store(spark, "capability")
    reports = st.capability_reports(st.table(spark, sf_dir, "lineitem"))
    landing = st.land_xml(reports, store.path("landing"), "IMODocBody", by=F.col("Date"))
    stale = typing.flatten_capability(files.scan_capability_xml(spark.read, landing))
    store.replace_table(stale.withColumn("OutputEnergy", F.lit(0.0)), schemas.CAPABILITY)
    newest = store.read(schemas.CAPABILITY).agg(F.max("Date").cast("string")).first()[0]
    raw = files.scan_capability_xml(spark.read, f"{landing}/report={newest}")
    ingest.replace_report(store, "capability", raw, newest, st.INSTANT)
    return store.read(schemas.CAPABILITY)


@query
def capability_one_document(spark, sf_dir):
    """A single large report, cut at its generators and parsed block by block."""
    path = scratch(spark, "document")
    landing = st.land_one_document(st.table(spark, sf_dir, "lineitem"), path)
    return typing.flatten_capability(files.scan_generator_blocks(spark, landing, parts=True))


@query
def zonal_items_to_primary(spark, sf_dir):
    """A zonal line per supplier and month to the raw table, then wide to long."""
    store = _store(spark, "zonal-items")
    lines = st.zonal_items(st.table(spark, sf_dir, "lineitem"))
    landing = st.land_csv(lines, store.path("landing"))
    ingest.full_load(store, "zonal", files.scan_zonal_csv(spark.read, landing), st.INSTANT)
    ingest.refresh_primary(store, st.INSTANT)
    return store.read(schemas.PRIMARY_ZONAL_DEMAND)


@query
def series_csv_items(spark, sf_dir):
    """An exported series per supplier and return flag, typed and sorted by time."""
    series = st.item_series(st.table(spark, sf_dir, "lineitem"))
    text = series.select("series", F.col("timestamp").cast("string").alias("timestamp"), "Ontario_Demand")
    landing = scratch(spark, "series-items")
    text.write.option("header", "true").csv(landing)
    raw = files.scan_series_csv(spark.read, landing, ["series", "timestamp", "Ontario_Demand"])
    typed = typing.type_series(raw, "timestamp", "Ontario_Demand", ["series"])
    return typed.orderBy("series", "timestamp")


@query
def fuel_items_load(spark, sf_dir):
    """A fuel document per month and supplier, all loaded."""
    store = _store(spark, "fuel-items")
    days = st.item_fuel_days(st.table(spark, sf_dir, "lineitem"))
    landing = st.land_xml(days, store.path("landing"), "DailyData")
    ingest.full_load(store, "fuel", files.scan_fuel_xml(spark.read, landing), st.INSTANT)
    return store.read(schemas.FUEL_OUTPUT)


@query
def demand_validated(spark, sf_dir):
    """Hourly jobs with their checks: no table, a report with wrong hours, a good one."""
    store = _store(spark, "validated")
    lines = st.daily_items(st.table(spark, sf_dir, "lineitem"))
    wrong = lines.withColumn("Hour", F.col("Hour") + 24)
    stopped = []
    for i, rows in enumerate((None, wrong, lines)):
        try:
            if rows is None:
                quality.check_demand(None)
            else:
                landing = st.land_csv(rows, store.path(f"landing-{i}"))
                raw = files.scan_demand_csv(spark.read, landing)
                ingest.ingest(store, "demand", raw, st.INSTANT, "all_dates_in_batch", validate=True)
        except quality.DataCheckError as error:
            stopped.append(str(error).split(":")[0])
    return store.read(schemas.DEMAND).select("*", F.lit("; ".join(stopped)).alias("stopped"))


# Rejects


def _with_rejects(rows: DataFrame, rejects: DataFrame, keys: list[str], schema: str) -> DataFrame:
    """Table rows beside the wrong values that the quarantine table keeps of them."""
    found = rejects.select(F.from_json("row", schema).alias("r"), "field", "text")
    found = found.select(*[f"r.{k}" for k in keys], "field", "text")
    return rows.join(found, keys, "left")


@query
def fuel_rejects(spark, sf_dir):
    """Outputs that are no integers or empty: the others are taken in, these are kept apart."""
    store = _store(spark, "fuel-rejects")
    days = st.item_fuel_days(st.table(spark, sf_dir, "lineitem"), faulty=F.lit(True))
    landing = st.land_xml(days, store.path("landing"), "DailyData")
    raw = files.scan_fuel_xml(spark.read, landing, strict=False)
    ingest.ingest(store, "fuel", raw, st.INSTANT, "all_dates_in_batch", strict=False)
    keys = ["Date", "hour", "fuel_type"]
    schema = "`Date` DATE, hour INT, fuel_type STRING"
    return _with_rejects(store.read(schemas.FUEL_OUTPUT), quarantine(store), keys, schema)


@query
def capability_rejects(spark, sf_dir):
    """Energies that are empty or no number count as 0 and are kept apart, by generator."""
    store = _store(spark, "capability-rejects")
    reports = st.capability_reports(st.table(spark, sf_dir, "lineitem"), faulty=True)
    landing = st.land_xml(reports, store.path("landing"), "IMODocBody")
    raw = files.scan_capability_xml(spark.read, landing, strict=False)
    ingest.ingest(store, "capability", raw, st.INSTANT, "all_dates_in_batch", strict=False)
    keys = ["Date", "GeneratorName"]
    wrong = quarantine(store).select(
        F.from_json("row", "`Date` DATE, GeneratorName STRING").alias("r"), "field"
    )
    wrong = wrong.groupBy(*[F.col(f"r.{k}").alias(k) for k in keys]).agg(
        F.count(F.lit(1)).alias("wrong_values")
    )
    return store.read(schemas.CAPABILITY).join(wrong, keys, "left")


@query
def demand_rejects(spark, sf_dir):
    """Lines with a field too many are kept apart, the others are loaded."""
    store = _store(spark, "demand-rejects")
    lines = st.daily_items(st.table(spark, sf_dir, "lineitem"))
    surplus = F.when(F.col("Ontario_Demand") % 10 == 0, F.concat_ws(",", "Market_Demand", F.lit("x")))
    lines = lines.withColumn("Market_Demand", F.coalesce(surplus, F.col("Market_Demand").cast("string")))
    landing = st.land_csv(lines, store.path("landing"))
    raw = files.scan_demand_csv(spark.read, landing)
    ingest.ingest(store, "demand", raw, st.INSTANT, "all_dates_in_batch", strict=False)
    taken = store.read(schemas.DEMAND).groupBy("Date").agg(
        F.count(F.lit(1)).alias("taken"), F.round(F.sum("Market_Demand"), 2).alias("Market_Demand")
    )
    month = F.to_date(F.substring_index("text", ",", 1))
    apart = quarantine(store).groupBy(month.alias("Date")).agg(F.count(F.lit(1)).alias("apart"))
    return taken.join(apart, "Date", "left")


# Tables and register


def _history_and_correction(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All events with a stale newest date, and a batch correcting the newest two dates."""
    events = _events(spark, sf_dir)
    history = st.dated_events(events)
    newest = history.agg(F.max("Date")).scalar()
    stale = F.when(F.col("Date") == newest, F.lit(0.0)).otherwise(F.col("value"))
    batch = _last_dates(events, 2).withColumn("value", F.round(F.col("value") + 1, 2))
    return history.withColumn("value", stale), batch


@query
def upsert_latest(spark, sf_dir):
    """Table written, then its newest date replaced; the older corrected date is ignored."""
    store = _store(spark, "upsert")
    history, batch = _history_and_correction(spark, sf_dir)
    store.replace_table(history, "raw/events")
    store.upsert(batch, "raw/events")
    return store.read("raw/events")


@query
def upsert_all_dates(spark, sf_dir):
    """The same with every date of the batch taken in."""
    store = _store(spark, "upsert-all")
    history, batch = _history_and_correction(spark, sf_dir)
    store.replace_table(history, "raw/events")
    store.upsert(batch, "raw/events", mode="all_dates_in_batch")
    return store.read("raw/events")


@query
def upsert_as_query(spark, sf_dir):
    """Delete-then-insert as a query that writes nothing."""
    history, batch = _history_and_correction(spark, sf_dir)
    return slices.upserted(history, batch, mode="all_dates_in_batch")


@query
def upsert_as_query_latest(spark, sf_dir):
    """The same with the batch's newest date only."""
    history, batch = _history_and_correction(spark, sf_dir)
    return slices.upserted(history, batch)


def _undated(rows: DataFrame, every: int) -> DataFrame:
    """Some rows have no date."""
    return rows.withColumn("Date", F.when(F.col("event_id") % every != 0, F.col("Date")))


@query
def upsert_undated(spark, sf_dir):
    """Rows without a date in the table stay; those in the batch aren't written."""
    store = _store(spark, "upsert-undated")
    history, batch = _history_and_correction(spark, sf_dir)
    store.replace_table(_undated(history, 10), "raw/events")
    store.upsert(_undated(batch, 7), "raw/events", mode="all_dates_in_batch")
    return store.read("raw/events")


@query
def upsert_undated_as_query(spark, sf_dir):
    history, batch = _history_and_correction(spark, sf_dir)
    return slices.upserted(_undated(history, 10), _undated(batch, 7), mode="all_dates_in_batch")


@query
def replace_slice(spark, sf_dir):
    """One explicit date replaced."""
    store = _store(spark, "slice")
    history, batch = _history_and_correction(spark, sf_dir)
    store.replace_table(history, "raw/events")
    newest = slices.latest_slice(batch)
    key = newest.agg(F.max("Date").cast("string")).first()[0]
    store.replace_slice(newest, "raw/events", key)
    return store.read("raw/events")


@query
def register_append(spark, sf_dir):
    """A full load and a later upsert, each registered with the whole table's row count."""
    store = _store(spark, "register")
    history, batch = _history_and_correction(spark, sf_dir)
    store.replace_table(history, "raw/events")
    store.append_register("raw/events", st.INSTANT)
    store.upsert(batch, "raw/events")
    store.append_register("raw/events", st.INSTANT + timedelta(hours=1))
    return store.register()


@query
def register_snapshot(spark, sf_dir):
    """Row counts of all tables as register rows; the ten latest of them."""
    rows = None
    for i, name in enumerate(TABLES):
        instant = st.INSTANT + timedelta(minutes=i)
        row = st.table(spark, sf_dir, name).agg(F.count(F.lit(1)).alias("ROW_COUNT")).select(
            F.lit(i + 1).cast("bigint").alias("id"),
            F.lit(name).alias("TABLE_NAME"),
            F.lit("raw").alias("TABLE_SCHEMA"),
            G.load_date(instant).alias("MODIFIED_DT"),
            G.wall_clock(instant).alias("MODIFIED_TIME"),
            "ROW_COUNT",
        )
        rows = row if rows is None else rows.unionByName(row)
    return latest_writes(rows)


# Checks and profiles


def _faulty_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours 0..23, values shifted below zero and missing values as planted faults."""
    return _events(spark, sf_dir).select(
        F.to_date("ts").alias("Date"),
        F.hour("ts").alias("Hour"),
        F.round(F.col("value") - 20, 2).alias("Market_Demand"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("Ontario_Demand"),
    )


@query
def validate_demand(spark, sf_dir):
    return quality.check_demand(_faulty_demand(spark, sf_dir))


@query
def validate_failing(spark, sf_dir):
    """The same without its hour and with more rows asked for than there are."""
    rows = _faulty_demand(spark, sf_dir).drop("Hour")
    return quality.check_demand(rows, min_rows=10**12)


@query
def validate_zonal(spark, sf_dir):
    events = _events(spark, sf_dir)
    rows = events.select(
        F.when(F.col("event_type") != "signup", F.to_date("ts")).alias("Date"),
        (F.hour("ts") + 3).alias("Hour"),
        "value",
    )
    return quality.check_zonal(rows)


@query
def validate_generator(spark, sf_dir):
    """Blank and missing fuels, and whole-row duplicates."""
    events = _events(spark, sf_dir)
    fuel = (
        F.when(F.col("event_type") == "click", F.lit(""))
        .when(F.col("event_type") == "view", F.lit("  "))
        .when(F.col("event_type") != "error", F.col("event_type"))
    )
    rows = events.select(*st.slot(), fuel.alias("fuel_type"))
    return quality.check_generator(rows, check_duplicates=True)


@query
def duplicate_rows(spark, sf_dir):
    documents = st.table(spark, sf_dir, "documents").select("text")
    return quality.duplicate_rows(documents, long_text=["text"])


@query
def profile_nulls(spark, sf_dir):
    """Documents, whole texts included, with their labels, if any."""
    documents = st.table(spark, sf_dir, "documents")
    labels = st.table(spark, sf_dir, "labels")
    return profile.profile(documents.join(labels, "doc_id", "left"))


@query
def profile_distinct(spark, sf_dir):
    events = _events(spark, sf_dir).select("*", F.to_date("ts").alias("Date"))
    return profile.distinct_counts(events, ["user_id", "Date", "props"], by=["event_type"])


@query
def profile_sketches(spark, sf_dir):
    """Profiles of two ranges of dates out of stored sketches, after two dates have changed."""
    store = _store(spark, "sketches")
    history, batch = _history_and_correction(spark, sf_dir)
    columns = ["event_type", "user", "value_class"]

    def shaped(rows: DataFrame) -> DataFrame:
        return rows.select(
            "Date", F.nullif("event_type", F.lit("error")).alias("event_type"),
            (F.col("user_id") % 100).alias("user"), (F.col("event_id") % 7).alias("value_class"),
        )

    store.replace_table(shaped(history), "raw/events")
    sketches.refresh(store, "raw/events", columns)
    fewer = shaped(batch.filter("event_id % 2 = 0"))
    store.upsert(fewer, "raw/events", mode="all_dates_in_batch")
    name = sketches.refresh(store, "raw/events", columns, fewer.select("Date"))
    half = F.when(F.dayofmonth("Date") <= 15, "first").otherwise("second").alias("half")
    found = sketches.merged(store.read(name).withColumn("half", half), ["half"])
    return found.withColumn("top", F.element_at("top", 1)["count"])


@query
def distinct_fuels(spark, sf_dir):
    """Distinct values, a missing one included."""
    fuel = F.when(F.col("event_type") != "error", F.col("event_type")).alias("fuel_type")
    return profile.distinct_values(_events(spark, sf_dir).select(fuel), "fuel_type")


@query
def head_tail(spark, sf_dir):
    orders = st.table(spark, sf_dir, "orders")
    return ordering.head_tail(orders, ["o_orderdate", "o_orderkey"]).select(
        "part", "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"
    )


# Series


@query
def time_split(spark, sf_dir):
    series = st.hourly_series(_events(spark, sf_dir), by_type=True)
    return ordering.time_split(series, ["timestamp"], by=["series"])


@query
def lag_features(spark, sf_dir):
    series = st.hourly_series(_events(spark, sf_dir))
    rows = ordering.lag_features(series, "Ontario_Demand", ["timestamp"], 5, by=["series"])
    changes = ["diff", *[f"lag_{k}" for k in range(1, 6)]]
    return rows.select(
        "series", "timestamp", "pos", *[F.round(c, 4).alias(c) for c in changes]
    )


@query
def time_split_many(spark, sf_dir):
    series = st.item_series(st.table(spark, sf_dir, "lineitem"))
    return ordering.time_split(series, ["timestamp"], by=["series"])


@query
def lag_features_many(spark, sf_dir):
    series = st.item_series(st.table(spark, sf_dir, "lineitem"))
    rows = ordering.lag_features(series, "Ontario_Demand", ["timestamp"], 1, by=["series"])
    return rows.select(
        "series", "timestamp", "pos", *[F.round(c, 4).alias(c) for c in ("diff", "lag_1")]
    )


def _rounded(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.select(
        *[F.round(c, 4).alias(c) if c in columns else F.col(c) for c in rows.columns]
    )


def _placed(spark: SparkSession, sf_dir: str, by_type: bool) -> DataFrame:
    series = st.hourly_series(_events(spark, sf_dir), by_type)
    return forecasting.placed(series, "Ontario_Demand", ["series"])


@query
def forecast_ar1(spark, sf_dir):
    placed = _placed(spark, sf_dir, by_type=False)
    rows = forecasting.holdout_forecast(placed, "Ontario_Demand", ["series"], (1, 1, 0))
    return _rounded(rows, "yhat")


@query
def forecast_ar5(spark, sf_dir):
    """The default order, one model per event type."""
    placed = _placed(spark, sf_dir, by_type=True)
    rows = forecasting.holdout_forecast(placed, "Ontario_Demand", ["series"])
    return _rounded(rows, "yhat")


@query
def forecast_error(spark, sf_dir):
    placed = _placed(spark, sf_dir, by_type=True)
    rows = forecasting.holdout_forecast(placed, "Ontario_Demand", ["series"], (1, 1, 0))
    errors = fc.forecast_error(rows, "Ontario_Demand", "yhat", by=["series"])
    return _rounded(errors, "mse", "rmse")


@query
def forecast_runs(spark, sf_dir):
    """Order, sizes and error of a run per series, logged to a table."""
    store = _store(spark, "runs")
    placed = _placed(spark, sf_dir, by_type=True)
    forecasting.log_runs(
        store, forecasting.score(placed, "Ontario_Demand", ["series"], st.INSTANT)
    )
    runs = store.read(schemas.FORECAST_RUNS, schemas.FORECAST_RUN_SCHEMA)
    return _rounded(runs.drop("run_at"), "mse", "rmse")


@query
def model_coefficients(spark, sf_dir):
    """Fitted models, stored and read back as a coefficient table."""
    store = _store(spark, "models")
    placed = _placed(spark, sf_dir, by_type=True)
    models = forecasting.train_models(placed, "Ontario_Demand", ["series"], schemas.SHORT_ORDER)
    forecasting.save_models(store, models)
    terms = fc.coefficients(forecasting.load_models(store), ["series"])
    return terms.select("series", "term", "lag", F.round("value", 6).alias("value"))


@query
def forecast_arma_weekly(spark, sf_dir):
    """Weekly lags and one MA term, predicting the held-out range."""
    placed = _placed(spark, sf_dir, by_type=False)
    rows = forecasting.holdout_forecast(
        placed, "Ontario_Demand", ["series"], schemas.WEEKLY_ORDER
    )
    return _rounded(rows, "yhat")


@query
def forecast_720(spark, sf_dir):
    """The stored weekly model, 720 hours ahead of the last observed hour."""
    store = _store(spark, "ahead")
    placed = _placed(spark, sf_dir, by_type=False)
    forecasting.save_models(store, forecasting.train_models(placed, "Ontario_Demand", ["series"]))
    rows = forecasting.forecast_ahead(forecasting.load_models(store), placed, ["series"])
    return _rounded(rows, "yhat")


@query
def future_hours(spark, sf_dir):
    series = st.hourly_series(_events(spark, sf_dir), by_type=True)
    return fc.future_hours(series, "timestamp", schemas.HORIZON, by=["series"])


@query
def actual_vs_forecast(spark, sf_dir):
    """Observed test hours and the forecast beyond them, one under the other."""
    by, value = ["series"], "Ontario_Demand"
    placed = _placed(spark, sf_dir, by_type=False)
    test = forecasting.test_part(placed)
    models = forecasting.train_models(placed, value, by, (1, 1, 0))
    ahead = forecasting.forecast_ahead(models, placed, by)
    return _rounded(fc.actual_vs_forecast(test, ahead, by, "timestamp", value), value)


@query
def forecast_many(spark, sf_dir):
    """A lag-1 model per supplier and return flag over its line items by date."""
    series = st.item_series(st.table(spark, sf_dir, "lineitem"))
    placed = forecasting.placed(series, "Ontario_Demand", ["series"])
    rows = forecasting.holdout_forecast(placed, "Ontario_Demand", ["series"], (1, 1, 0))
    return _rounded(rows, "yhat")


@query
def forecast_recursive(spark, sf_dir):
    """A day's lags and one MA term, fitted by recursion over chunks of one long series."""
    series = st.order_series(st.table(spark, sf_dir, "orders"))
    placed = forecasting.placed(series, "Ontario_Demand", ["series"])
    rows = forecasting.recursive_forecast(placed, "Ontario_Demand", ["series"], (24, 1, 1))
    return _rounded(rows, "yhat")


@query
def forecast_exact(spark, sf_dir):
    """Exact likelihood over hours with gaps, a series per group of users."""
    series = st.user_series(_events(spark, sf_dir))
    placed = forecasting.placed(series, "Ontario_Demand", ["series"])
    rows = forecasting.exact_forecast(placed, "Ontario_Demand", ["series"], p=2)
    return _rounded(rows, "yhat")


# Streams


def _run_stream(store: Store, feed: str, mode: str, **options) -> None:
    landing, checkpoint = store.path("landing"), store.path("checkpoint")
    run = pick_up(store, feed, landing, checkpoint, lambda: st.INSTANT, mode, **options)
    run.awaitTermination()


def _fuel_months(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Column]:
    """Line items, and whether a month's fuel report is faulty at first."""
    return st.table(spark, sf_dir, "lineitem"), F.month("l_shipdate") % 3 == 0


@query
def stream_bad_numbers(spark, sf_dir):
    """Every third month's report has wrong values and is set aside; one lands again, mended."""
    store = _store(spark, "stream-wrong")
    items, third = _fuel_months(spark, sf_dir)
    landing = store.path("landing")
    days = st.item_fuel_days(items, faulty=F.month("Date") % 3 == 0)
    st.land_xml(days, f"{landing}/fetch=1", "DailyData", by=F.substring("Day", 1, 7))
    _run_stream(store, "fuel", "all_dates_in_batch")
    again = items.filter(third & (F.year("l_shipdate") == 1995))
    st.land_xml(st.item_fuel_days(again), f"{landing}/fetch=2", "DailyData", by=F.substring("Day", 1, 7))
    _run_stream(store, "fuel", "all_dates_in_batch")
    rejected = rejected_reports(store).filter("reason = 'wrong value'")
    count = rejected.agg(F.count(F.lit(1)).alias("rejected")).scalar()
    return store.read(schemas.FUEL_OUTPUT).withColumn("rejected", count)


@query
def stream_empty_report(spark, sf_dir):
    """A lone report without hours is recorded; the ones that land after it are taken in."""
    store = _store(spark, "stream-empty")
    items = st.table(spark, sf_dir, "lineitem")
    landing = store.path("landing")
    days = st.item_fuel_days(items)
    empty = days.agg(F.max("Day").alias("Day"))
    st.land_xml(empty, f"{landing}/fetch=1", "DailyData", by=F.lit("none"))
    _run_stream(store, "fuel", "all_dates_in_batch")
    st.land_xml(days, f"{landing}/fetch=2", "DailyData", by=F.substring("Day", 1, 4))
    _run_stream(store, "fuel", "all_dates_in_batch")
    rejected = rejected_reports(store).filter("reason = 'too few rows'")
    count = rejected.agg(F.count(F.lit(1)).alias("rejected")).scalar()
    return store.read(schemas.FUEL_OUTPUT).withColumn("rejected", count)


@query
def stream_tolerant(spark, sf_dir):
    """A pickup that isn't strict takes wrong values in as NULL and keeps them apart."""
    store = _store(spark, "stream-tolerant")
    items, _ = _fuel_months(spark, sf_dir)
    days = st.item_fuel_days(items, faulty=F.month("Date") % 3 == 0)
    st.land_xml(days, f"{store.path('landing')}/fetch=1", "DailyData", by=F.substring("Day", 1, 7))
    _run_stream(store, "fuel", "all_dates_in_batch", strict=False)
    keys = ["Date", "hour", "fuel_type"]
    schema = "`Date` DATE, hour INT, fuel_type STRING"
    return _with_rejects(store.read(schemas.FUEL_OUTPUT), quarantine(store), keys, schema)


@query
def stream_rewritten_report(spark, sf_dir):
    """A file per month, written anew under its name three times, taken in over three runs."""
    store = _store(spark, "stream-rewritten")
    report = st.daily_items(st.table(spark, sf_dir, "lineitem"))
    landing, versions = store.path("fetched"), store.path("landing")
    last_year = report.filter(F.year("Date") == report.agg(F.year(F.max("Date"))).scalar())
    newest = report.filter(F.col("Date") == report.agg(F.max("Date")).scalar())
    fetches = [(report, 0), (last_year, 1000), (newest, 2000)]
    for i, (rows, more) in enumerate(fetches):
        raised = rows.withColumn("Market_Demand", F.col("Market_Demand") + more)
        st.land_under_one_name(raised, landing, store.path(f"fetch-{i}"))
        take_versions(store, landing, versions)
        _run_stream(store, "demand", "all_dates_in_batch")
    # Nothing has been written anew since, so nothing is taken.
    if take_versions(store, landing, versions):
        raise ValueError("a version was taken twice")
    _run_stream(store, "demand", "all_dates_in_batch")
    return store.read(schemas.DEMAND)


@query
def stream_primary_from_register(spark, sf_dir):
    """Raw zonal reports are taken in; the primary table follows by a stream over the register.

    The second run's refresh makes up for the raw write whose own didn't come about.
    """
    store = _store(spark, "stream-follow")
    lines = st.zonal_items(st.table(spark, sf_dir, "lineitem"))
    landing = store.path("landing")

    def raised(rows: DataFrame, fetch: int) -> None:
        rows = rows.withColumn("Zone_Total", F.col("Zone_Total") + 1000 * fetch)
        st.land_csv(rows, f"{landing}/fetch={fetch}")
        _run_stream(store, "zonal", "all_dates_in_batch", primary=False)

    def refresh() -> None:
        checkpoint = store.path("checkpoint-primary")
        refresh_from_register(store, checkpoint, lambda: st.INSTANT).awaitTermination()

    raised(lines, 1)
    refresh()
    raised(lines.filter(F.year("Date") == 1996), 2)
    raised(lines.filter(F.year("Date") == 1997), 3)
    refresh()
    return store.read(schemas.PRIMARY_ZONAL_DEMAND)


@query
def stream_items(spark, sf_dir):
    """Every line item in a report by month; the last year's land again, corrected."""
    store = _store(spark, "stream-items")
    report = st.daily_items(st.table(spark, sf_dir, "lineitem"))
    newest = report.agg(F.year(F.max("Date"))).scalar()
    for fetch, rows in ((1, report), (2, _corrected(report.filter(F.year("Date") == newest)))):
        st.land_months(rows, store.path("landing"), fetch)
        _run_stream(store, "demand", "all_dates_in_batch")
    return store.read(schemas.DEMAND)


@query
def date_counts(spark, sf_dir):
    """Rows by date as registered writes have left them: a load, a replaced date, an unknown write."""
    store = _store(spark, "counts")
    history, batch = _history_and_correction(spark, sf_dir)
    store.replace_table(history, "raw/events")
    store.append_register("raw/events", st.INSTANT)
    fewer = batch.filter("event_id % 2 = 0")
    for write in ("again", "again", "last"):  # the second is a replay
        store.upsert(fewer, "raw/events", mode="all_dates_in_batch", registered=True)
        store.append_register("raw/events", st.INSTANT, write, fewer.select("Date"))
        fewer = fewer.filter("event_id % 4 = 0")
    return store.date_counts("raw/events")


def _corrected(report: DataFrame) -> DataFrame:
    return report.withColumn("Market_Demand", F.col("Market_Demand") + 1000)


@query
def stream_pickup(spark, sf_dir):
    """Half-day fetches, whole-day fetches, a run, corrected fetches, a second run."""
    store = _store(spark, "stream")
    landing = store.path("landing")
    report = st.demand(_events(spark, sf_dir))
    newest = report.agg(F.max("Date")).scalar()

    st.land_reports(report.filter("Hour <= 12"), landing, 1)
    st.land_reports(report.filter(F.col("Date") < newest), landing, 2)
    _run_stream(store, "demand", "latest")
    late = report.filter(F.col("Date") >= F.date_sub(newest, 1))
    st.land_reports(_corrected(late), landing, 3)
    _run_stream(store, "demand", "latest")
    return store.read(schemas.DEMAND)


@query
def stream_multipart_reports(spark, sf_dir):
    """Two fetches of all days, each a folder of many files, taken in at once."""
    store = _store(spark, "stream-parts")
    report = st.demand(_events(spark, sf_dir))
    for fetch, rows in (("fetch=1", report), ("fetch=2", _corrected(report))):
        spread = rows.repartition(3, "Date", "Hour")
        st.land_csv(spread, f"{store.path('landing')}/{fetch}")
    _run_stream(store, "demand", "all_dates_in_batch")
    return store.read(schemas.DEMAND)


@query
def stream_bad_file(spark, sf_dir):
    """A report of one line with a field too many among good ones, then another good fetch."""
    store = _store(spark, "stream-bad")
    report = st.demand(_events(spark, sf_dir))
    landing = store.path("landing")
    odd = F.dayofmonth("Date") % 2 == 1
    st.land_reports(report.filter(odd), landing, 1)
    surplus = F.when(F.col("Hour") == 5, F.lit("1,2")).otherwise(F.lit("1"))
    broken = report.filter(~odd).withColumn("Ontario_Demand", surplus)
    broken = broken.select("Date", "Hour", "Market_Demand", "Ontario_Demand")
    st.land_csv(broken, f"{landing}/fetch=2")
    _run_stream(store, "demand", "all_dates_in_batch")
    newest = report.agg(F.max("Date")).scalar()
    st.land_reports(report.filter(F.col("Date") == newest), landing, 3)
    _run_stream(store, "demand", "all_dates_in_batch")
    rejected = rejected_reports(store).agg(F.count(F.lit(1)).alias("rejected"))
    return store.read(schemas.DEMAND).join(F.broadcast(rejected))


@query
def stream_fuel(spark, sf_dir):
    """Nested fuel reports picked up as they land; every date is taken in."""
    store = _store(spark, "stream-fuel")
    landing = f"{store.path('landing')}/fetch=1"
    st.land_xml(st.fuel_days(_events(spark, sf_dir)), landing, "DailyData")
    _run_stream(store, "fuel", "all_dates_in_batch")
    return store.read(schemas.FUEL_OUTPUT)


@query
def stream_capability(spark, sf_dir):
    """Capability reports picked up as they land; every month is taken in."""
    store = _store(spark, "stream-capability")
    reports = st.capability_reports(st.table(spark, sf_dir, "lineitem"))
    st.land_xml(reports, f"{store.path('landing')}/fetch=1", "IMODocBody")
    _run_stream(store, "capability", "all_dates_in_batch")
    return store.read(schemas.CAPABILITY)


@query
def stream_late_dates(spark, sf_dir):
    """Two-day reports after one-day ones; the corrections of both their days are taken in."""
    store = _store(spark, "stream-late")
    report = st.demand(_events(spark, sf_dir))
    st.land_reports(report, store.path("landing"), 1)
    _run_stream(store, "demand", "all_dates_in_batch")
    st.land_reports(_corrected(report), store.path("landing"), 2, days=2)
    _run_stream(store, "demand", "all_dates_in_batch")
    return store.read(schemas.DEMAND)


@query
def stream_latest_to_primary(spark, sf_dir):
    """Two-day zonal reports; the later day of each goes to the raw and the primary table."""
    store = _store(spark, "stream-zonal")
    wide = st.hourly_wide(_events(spark, sf_dir)).select(schemas.ZONAL_COLUMNS)
    st.land_reports(wide, store.path("landing"), 1, days=2)
    _run_stream(store, "zonal", "latest")
    return store.read(schemas.PRIMARY_ZONAL_DEMAND)
