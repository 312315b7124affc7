"""Grid-shaped inputs derived from the driver's tables.

The tables hold no grid data, so each registered query gets its input from them by a
Spark job over the whole table: events summed by hour stand for hourly demand with ten
zones, line items by ship date and supplier stand for generator reports. Whatever has
to arrive as a file is written to the shared scratch folder first.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspan import functions as G
from gridspan import schemas

INSTANT = datetime(2025, 1, 2, 8, 4, 5, 678000, tzinfo=timezone.utc)
#: Documents that a landed XML file holds at most.
FILE_REPORTS = 10_000
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slot(ts: str = "ts") -> list[Column]:
    """The (Date, Hour 1..24) slot of a timestamp."""
    return [F.to_date(ts).alias("Date"), (F.hour(ts) + 1).alias("Hour")]


def hourly_wide(events: DataFrame) -> DataFrame:
    """Events per hour slot in the zonal layout: sums and counts per type fill ten zones."""
    def when(event_type: str) -> Column:
        return F.when(F.col("event_type") == event_type, F.col("value"))

    sums = [F.round(F.sum(when(t)), 4) for t in EVENT_TYPES]
    counts = [F.nullif(F.count(when(t)), F.lit(0)).cast("double") for t in EVENT_TYPES]
    total = F.sum("value") + F.count("value")
    demand = F.coalesce(
        F.sum(F.when(F.col("event_type") != "error", F.col("value"))), F.lit(0.0)
    )
    slots = events.groupBy(*slot()).agg(
        F.round(demand, 4).alias("Ontario_Demand"),
        *[c.alias(zone) for zone, c in zip(schemas.ZONES, sums + counts)],
        F.round(total, 4).alias("Zone_Total"),
    )
    return slots.withColumn("Diff", F.round(F.col("Zone_Total") - F.col("Ontario_Demand"), 4))


def zonal(events: DataFrame) -> DataFrame:
    """The stored zonal table: the wide layout plus its load stamp."""
    return hourly_wide(events).withColumn("Modified_DT", G.load_second(INSTANT))


def demand(events: DataFrame) -> DataFrame:
    """The demand report's four columns."""
    wide = hourly_wide(events)
    return wide.select("Date", "Hour", F.col("Zone_Total").alias("Market_Demand"), "Ontario_Demand")


def hourly_series(events: DataFrame, by_type: bool = False) -> DataFrame:
    """(series, timestamp, Ontario_Demand): one series in all, or one per event type."""
    series = F.col("event_type") if by_type else F.lit("total")
    sums = events.groupBy(series.alias("series"), *slot()).agg(
        F.round(F.sum("value"), 4).alias("Ontario_Demand")
    )
    return sums.select("series", G.hour_start().alias("timestamp"), "Ontario_Demand")


def user_series(events: DataFrame) -> DataFrame:
    """(series, timestamp, Ontario_Demand): hourly sums of 20 users each, with many empty hours."""
    users = F.concat(F.lit("u"), F.floor(F.col("user_id") / 20).cast("string"))
    sums = events.groupBy(users.alias("series"), *slot()).agg(
        F.round(F.sum("value"), 4).alias("Ontario_Demand")
    )
    return sums.select("series", G.hour_start().alias("timestamp"), "Ontario_Demand")


def order_series(orders: DataFrame) -> DataFrame:
    """(series, timestamp, Ontario_Demand): one long series, an hour for each order's price."""
    hours = F.make_dt_interval(F.lit(0), F.col("o_orderkey").cast("int"))
    return orders.select(
        F.lit("orders").alias("series"), (F.lit("2000-01-01").cast("timestamp_ntz") + hours).alias("timestamp"),
        (F.col("o_totalprice") / 1000).alias("Ontario_Demand"),
    )


def item_lines(lineitem: DataFrame) -> DataFrame:
    """Line items as demand lines: months as dates, some of them wrong, some values no number."""
    month = F.trunc("l_shipdate", "month").cast("string")
    wrong = F.concat(month.substr(1, 5), F.lit("13-01"))
    price = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    return lineitem.select(
        F.when(F.col("l_linenumber") == 7, wrong).otherwise(month).alias("Date"),
        (F.col("l_suppkey") % 24 + 1).alias("Hour"),
        F.when(F.col("l_partkey") % 11 != 0, price).otherwise("bad").alias("Market_Demand"),
        F.col("l_quantity").alias("Ontario_Demand"),
    )


def item_series(lineitem: DataFrame) -> DataFrame:
    """(series, timestamp, Ontario_Demand): quantities by date of each supplier and return flag."""
    series = F.concat_ws("-", F.col("l_suppkey"), F.col("l_returnflag")).alias("series")
    return lineitem.groupBy(series, F.col("l_shipdate").alias("timestamp")).agg(
        F.round(F.sum("l_quantity"), 4).alias("Ontario_Demand")
    )


def item_zones(lineitem: DataFrame) -> DataFrame:
    """Line items by supplier and month in the zonal layout, parts' last digits as zones."""
    digit = F.col("l_partkey") % len(schemas.ZONES)
    zones = [
        F.sum(F.when(digit == i, F.col("l_quantity"))).alias(zone)
        for i, zone in enumerate(schemas.ZONES)
    ]
    return lineitem.groupBy("l_suppkey", F.trunc("l_shipdate", "month").alias("Date")).agg(*zones)


def zonal_items(lineitem: DataFrame) -> DataFrame:
    """Zonal report lines, one per supplier and month, so they grow with the table."""
    total = sum((F.coalesce(z, F.lit(0.0)) for z in schemas.ZONES), F.lit(0.0))
    supplier = F.col("l_suppkey").cast("double")
    return item_zones(lineitem).select(
        "Date", (F.col("l_suppkey") % 24 + 1).alias("Hour"), supplier.alias("Ontario_Demand"),
        *schemas.ZONES, total.alias("Zone_Total"), (total - supplier).alias("Diff"),
    )


def daily_items(lineitem: DataFrame) -> DataFrame:
    """Line items as demand rows: month, supplier's hour, price and quantity."""
    return lineitem.select(
        F.trunc("l_shipdate", "month").alias("Date"),
        (F.col("l_suppkey") % 24 + 1).alias("Hour"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("Market_Demand"),
        F.col("l_quantity").alias("Ontario_Demand"),
    )


def dated_events(events: DataFrame) -> DataFrame:
    return events.select(
        F.to_date("ts").alias("Date"), "event_id", "user_id", "event_type", "value"
    )


def _lines(df: DataFrame) -> Column:
    fields = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in df.columns]
    return F.concat_ws(",", *fields).alias("line")


def land_csv(df: DataFrame, path: str) -> str:
    """Writes one report, with two heading lines that carry no date, as text files."""
    heading = F.explode(F.array(F.lit("\\\\Hourly Report"), F.lit(",".join(df.columns))))
    top = df.sparkSession.range(1).select(heading.alias("line"))
    top.unionByName(df.select(_lines(df))).write.mode("append").text(path)
    return path


def land_reports(df: DataFrame, path: str, fetch: int, days: int = 1) -> str:
    """Lands one report per `days` dates of hourly rows, in a folder named by the fetch.

    A report holds at most 24 rows per date, so gathering one in a task is bounded.
    """
    report = F.floor(F.datediff("Date", F.lit("1970-01-01")) / days).alias("report")
    lines = df.select(report, _lines(df)).repartition("report")
    lines.write.partitionBy("report").text(f"{path}/fetch={fetch}")
    return path


def land_months(df: DataFrame, path: str, fetch: int) -> str:
    """Lands a report per month of `df`, in a folder named by the fetch."""
    lines = df.select(F.date_format("Date", "yyyy-MM").alias("report"), _lines(df))
    lines.repartition("report").write.partitionBy("report").text(f"{path}/fetch={fetch}")
    return path


def land_under_one_name(df: DataFrame, landing: str, path: str) -> str:
    """Lands a report file per month of `df`, under the name that month's file always has.

    Written to the scratch folder `path` first; each file then takes the place of the last.
    """
    lines = df.select(F.date_format("Date", "yyyy-MM").alias("report"), _lines(df))
    lines.repartition("report").write.partitionBy("report").text(path)
    jvm = df.sparkSession._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration())
    target = jvm.org.apache.hadoop.fs.Path(landing)
    fs.mkdirs(target)
    for report in fs.globStatus(jvm.org.apache.hadoop.fs.Path(folder, "report=*/part-*")):
        name = report.getPath().getParent().getName().removeprefix("report=")
        file = jvm.org.apache.hadoop.fs.Path(target, f"{name}.csv")
        fs.delete(file, False)
        fs.rename(report.getPath(), file)
    return landing


def item_fuel_days(lineitem: DataFrame, faulty: Column | None = None) -> DataFrame:
    """A nested fuel document per month and supplier, of at most 24 hours of three fuels.

    Where `faulty` holds, some outputs are no integers: halves in hour 4, empty in hour 6. In
    every fifth hour one fuel has none. A document's lines are brought together once, and summed,
    listed by hour and by document where they are.
    """
    lines = lineitem.select(
        F.trunc("l_shipdate", "month").alias("Date"), "l_suppkey",
        (F.col("l_partkey") % 24 + 1).alias("Hour"), "l_returnflag",
        F.round(F.col("l_quantity") * 100).cast("bigint").alias("hundredths"),
    ).repartition("Date", "l_suppkey")
    total = F.sum("hundredths").cast("string").alias("total")
    rows = lines.groupBy("Date", "l_suppkey", "Hour", "l_returnflag").agg(total)
    hour, flag = F.col("Hour"), F.col("l_returnflag")
    output = F.when((hour % 5 == 0) & (flag == "N"), F.lit(None)).otherwise(F.col("total"))
    if faulty is not None:
        wrong = F.when((hour == 4) & (flag == "A"), F.concat("total", F.lit(".5")))
        wrong = wrong.when((hour == 6) & (flag == "R"), F.lit(""))
        output = F.when(faulty & wrong.isNotNull(), wrong).otherwise(output)
    fuel = F.struct(
        F.concat_ws("-", "l_returnflag", "l_suppkey").alias("Fuel"),
        F.struct(output.alias("Output")).alias("EnergyValue"),
    )
    hours = rows.groupBy("Date", "l_suppkey", "Hour").agg(
        F.array_sort(F.collect_list(fuel)).alias("FuelTotal")
    )
    days = hours.groupBy("Date", "l_suppkey").agg(
        F.array_sort(F.collect_list(F.struct("Hour", "FuelTotal"))).alias("HourlyData")
    )
    return days.select(F.col("Date").cast("string").alias("Day"), "HourlyData")


def fuel_days(events: DataFrame) -> DataFrame:
    """One nested Day > Hour > Fuel struct per date; at most 24 hours of five fuels each.

    Output is in hundredths, so it is an exact integer; errors report none.
    """
    cents = F.sum(F.round(F.col("value") * 100).cast("bigint"))
    totals = events.groupBy(*slot(), "event_type").agg(cents.alias("Output")).withColumn(
        "Output", F.when(F.col("event_type") != "error", F.col("Output"))
    )
    fuel = F.struct(
        F.col("event_type").alias("Fuel"), F.struct("Output").alias("EnergyValue")
    )
    hours = totals.groupBy("Date", "Hour").agg(
        F.array_sort(F.collect_list(fuel)).alias("FuelTotal")
    )
    return hours.groupBy(F.col("Date").cast("string").alias("Day")).agg(
        F.array_sort(F.collect_list(F.struct("Hour", "FuelTotal"))).alias("HourlyData")
    )


def fuel_xml(events: DataFrame) -> DataFrame:
    """The same days as a column of XML text."""
    return fuel_days(events).select(
        F.to_xml(F.struct("Day", "HourlyData"), {"rowTag": "DailyData"}).alias("xml")
    )


def land_xml(df: DataFrame, path: str, row_tag: str, by: Column | None = None) -> str:
    """Writes report documents in a default namespace, in a folder for each value of `by`.

    An XML file is one task's work to read, so each writing task lands files of its own, of at
    most FILE_REPORTS documents, without blanks between tags. A folder is dealt to as many tasks
    as its size takes.
    """
    root = 'IMODocument xmlns="urn:hourly-reports"'
    if by is not None:
        df = df.withColumn("report", by).hint("rebalance", "report")
    writer = df.write.format("xml").mode("append").options(rowTag=row_tag, rootTag=root)
    writer = writer.options(maxRecordsPerFile=FILE_REPORTS, indent="")
    (writer if by is None else writer.partitionBy("report")).save(path)
    return path


def capability_reports(lineitem: DataFrame, faulty: bool = False) -> DataFrame:
    """A report by shipping month and supplier, with hours by part.

    The three return flags are the three lists, with every line item as an entry, in order
    of order, part and quantity. Every tenth part's entry has no energy, and every second
    supplier's hours are written with two digits. Reports grow in number with the table; one
    holds what a supplier ships in a month, some six items at any scale. `faulty` makes the
    energies of parts by number empty or no number.
    """
    entry = F.struct("l_orderkey", "l_partkey", "l_quantity", "l_returnflag")
    month = F.trunc("l_shipdate", "month").alias("Date")
    reports = lineitem.groupBy(month, "l_suppkey").agg(
        F.array_sort(F.collect_list(entry)).alias("entries")
    )

    def entries(flag: str) -> Column:
        def node(x: Column) -> Column:
            hour = (x["l_partkey"] % 24 + 1).cast("string")
            hour = F.when(F.col("l_suppkey") % 2 == 0, F.lpad(hour, 2, "0")).otherwise(hour)
            energy = F.when(x["l_partkey"] % 10 != 0, x["l_quantity"].cast("string"))
            if faulty:
                energy = F.when(x["l_partkey"] % 10 == 3, "").when(x["l_partkey"] % 10 == 7, "n/a").otherwise(energy)
            return F.struct(hour.alias("Hour"), energy.alias("EnergyMW"))

        return F.transform(F.filter("entries", lambda x: x["l_returnflag"] == flag), node)

    generator = F.struct(
        F.concat(F.lit("G"), F.col("l_suppkey")).alias("GeneratorName"),
        F.concat(F.lit("F"), F.col("l_suppkey") % 5).alias("FuelType"),
        F.struct(entries("A").alias("Output")).alias("Outputs"),
        F.struct(entries("N").alias("Capability")).alias("Capabilities"),
        F.struct(entries("R").alias("AvailCapacity")).alias("Capacities"),
    )
    return reports.select(
        F.col("Date").cast("string").alias("Date"),
        F.struct(generator.alias("Generator")).alias("Generators"),
    )


def land_one_document(lineitem: DataFrame, path: str) -> str:
    """One capability report of the newest month with all generators, in the folder `path`.

    Generators are suppliers by month. The document is cut behind generators into the files that
    tasks write, the heading in the first and the foot in the last, so no task sees all of it.
    """
    reports = capability_reports(lineitem)
    own = F.col("Generators.Generator")
    month = F.concat(F.lit("-"), F.substring("Date", 1, 7))
    generator = own.withField("GeneratorName", F.concat(own["GeneratorName"], month))
    blocks = reports.select(F.to_xml(generator, {"rowTag": "Generator"}).alias("line"))
    newest = lineitem.agg(F.trunc(F.max("l_shipdate"), "month").cast("string").alias("d"))
    head = newest.select(
        F.concat(
            F.lit('<IMODocument xmlns="urn:hourly-reports"><IMODocBody><Date>'), "d", F.lit("</Date><Generators>")
        ).alias("line"),
    )
    foot = lineitem.sparkSession.range(1).select(
        F.lit("</Generators></IMODocBody></IMODocument>").alias("line")
    )
    head.unionByName(blocks).unionByName(foot).write.text(path)
    return path
