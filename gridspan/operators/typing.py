"""Typed tables out of raw text scans. Every function here is a narrow projection.

A scan that says which rows are broken (`sources.files.with_broken`) is typed tolerantly, and
nothing that was wrong with it is lost: broken rows stay, ERRORS lists the texts that are no
values, and a document without any row, or with errors that belong to none, leaves a row that
IS_ROW marks as none of the table's.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspan import functions as G
from gridspan import schemas
from gridspan.sources.files import BROKEN, LANDING

ERRORS, IS_ROW = "_errors", "_is_row"
_NO_ERRORS = "array<struct<field:string,text:string>>"


def _carried(df: DataFrame) -> list[str]:
    """Columns about a row's report that are passed on where a scan has them."""
    return [c for c in (LANDING, BROKEN) if c in df.columns]


def _errors(**columns: Column) -> Column:
    """The (field, text) of each (value, error) that is an error."""
    found = [
        F.when(c["error"].isNotNull(), F.struct(F.lit(name).alias("field"), c["error"].alias("text")))
        for name, c in columns.items()
    ]
    return F.array_compact(F.array(*found))


def _typed_report(raw: DataFrame, names: list[str], stamp: Column) -> DataFrame:
    """Heading and banner lines have no parsable date, so the date filter removes them.

    The filter tests the text, not the parsed column: Spark moves a filter on a column
    below the projection and would then parse the date there once per mention.
    """
    values = [n for n in names if n not in ("Date", "Hour")]
    kept, checks = G.is_date("Date"), []
    if BROKEN in raw.columns:
        # Text that is no number is a missing value by this report's rules, no error.
        whole = F.col(BROKEN).isNull()
        kept |= ~whole
        checks = [F.array().cast(_NO_ERRORS).alias(ERRORS), whole.alias(IS_ROW)]
    return raw.filter(kept).select(
        F.col("Date").try_cast("date").alias("Date"),
        G.coerce_hour("Hour").alias("Hour"),
        *[G.coerce_number(n).alias(n) for n in values],
        stamp.alias("Modified_DT"),
        *_carried(raw),
        *checks,
    )


def type_demand(raw: DataFrame, instant: datetime) -> DataFrame:
    return _typed_report(raw, schemas.DEMAND_COLUMNS, G.load_date(instant))


def type_zonal(raw: DataFrame, instant: datetime) -> DataFrame:
    return _typed_report(raw, schemas.ZONAL_COLUMNS, G.load_second(instant))


def type_archive_demand(raw: DataFrame) -> DataFrame:
    """The older rule: only dates are parsed, and a NULL anywhere drops the row.

    The numbers were whatever the reader inferred per column, so they are text here
    whenever a column holds any text; a typed copy is what `type_demand` gives.
    """
    date, *rest = schemas.ARCHIVE_DEMAND_COLUMNS
    return raw.filter(G.is_date(date)).select(
        F.col(date).try_cast("date").alias(date), *[F.col(f"`{n}`") for n in rest]
    ).dropna(how="any")


def type_series(
    raw: DataFrame, timestamp: str, value: str, by: Sequence[str] = ()
) -> DataFrame:
    return raw.select(
        *by, G.parse_any_timestamp(timestamp).alias(timestamp), G.strict_double(value).alias(value)
    )


def flatten_fuel(days: DataFrame, strict: bool = True) -> DataFrame:
    """Day > Hour > Fuel to rows. A day without hours, or an hour without fuels, has none.

    Strict typing fails on a bad number; otherwise it becomes NULL.
    """
    checked = BROKEN in days.columns
    explode = F.explode_outer if checked else F.explode
    ids = ["Day", *_carried(days)]
    hours = days.select(*ids, explode("HourlyData").alias("h"))
    fuels = hours.select(*ids, F.col("h.Hour").alias("Hour"), explode("h.FuelTotal").alias("f"))
    flat = fuels.select(
        *ids,
        F.nullif(F.col("Hour"), F.lit("")).alias("Hour"),
        F.col("f.Fuel").alias("fuel_type"),
        F.col("f.EnergyValue.Output").alias("Output"),
        *([F.col("f").isNotNull().alias(IS_ROW)] if checked else []),
    )
    if not checked:
        number = G.strict_int if strict else G.integer_or_null
        hour = G.strict_int("Hour").cast("int") if strict else _hour_or_null(F.col("Hour"))
        return flat.select(
            G.parse_any_date("Day", strict).alias("Date"),
            hour.alias("hour"),
            "fuel_type",
            number("Output").alias("output"),
            *_carried(days),
        )
    typed = flat.select(
        G.value_or_error("Day", G.parse_any_date("Day", strict=False)).alias("Date"),
        G.value_or_error("Hour", _hour_or_null(F.col("Hour"))).alias("hour"),
        "fuel_type",
        G.value_or_error("Output", G.integer_or_null("Output")).alias("output"),
        *_carried(days),
        IS_ROW,
    )
    fields = ("Date", "hour", "output")
    return typed.select(
        *[F.col(f"{c}.value").alias(c) if c in fields else F.col(c) for c in typed.columns],
        _errors(**{c: F.col(c) for c in fields}).alias(ERRORS),
    )


LISTS = {
    "OutputEnergy": "g.Outputs.Output",
    "CapabilityEnergy": "g.Capabilities.Capability",
    "AvailCapacity": "g.Capacities.AvailCapacity",
}


def flatten_capability(reports: DataFrame, strict: bool = True) -> DataFrame:
    """One row per generator block and hour that any of its three lists names.

    A generator block arrives as one row with its three short lists, so they are
    aligned inside the row: no shuffle, and no hour list leaves its block. Per list
    the last entry of an hour wins and an absent hour is 0.
    """
    checked, carried = BROKEN in reports.columns, _carried(reports)
    strict &= not checked
    explode = F.explode_outer if checked else F.explode
    generators = reports.select(
        "Date",
        *carried,
        explode(
            F.concat(
                F.coalesce("Generators.Generator", F.array()), F.coalesce("Generator", F.array())
            )
        ).alias("g"),
    )
    day = G.parse_any_date("Date", strict)
    errors = [F.concat(_errors(Date=G.value_or_error("Date", day)), *[
        F.coalesce(_hourly_errors(path, name), F.array().cast(_NO_ERRORS)) for name, path in LISTS.items()
    ]).alias(ERRORS)] if checked else []
    blocks = generators.select(
        *carried,
        day.alias("Date"),
        F.col("g.GeneratorName").alias("GeneratorName"),
        F.col("g.FuelType").alias("FuelType"),
        *[_hourly_values(path, strict).alias(name) for name, path in LISTS.items()],
        *errors,
    )
    slots = [F.transform(name, lambda x: x["hour"]) for name in LISTS]
    hours = F.transform(
        F.array_union(F.array_union(slots[0], slots[1]), slots[2]),
        lambda hour: F.struct(
            hour.alias("Hour"),
            *[G.value_or_zero(_last_of_hour(name, hour)).alias(name) for name in LISTS],
        ),
    )
    if checked:
        # A block's errors, or a report without blocks, get a row of their own.
        own = F.when((F.size(hours) == 0) | (F.size(ERRORS) > 0), F.array(F.lit(None)))
        hours = F.concat(hours, F.coalesce(own, F.array()))
    rows = blocks.withColumn("h", F.explode(hours))
    is_row = F.col("h").isNotNull()
    checks = [F.when(~is_row, F.col(ERRORS)).otherwise(F.array().cast(_NO_ERRORS)).alias(ERRORS),
              is_row.alias(IS_ROW)] if checked else []
    return rows.select(
        "Date",
        "h.Hour",
        "GeneratorName",
        "FuelType",
        *[f"h.{name}" for name in LISTS],
        *carried,
        *checks,
    )


def _complete(path: str) -> Column:
    """Entries that have both an hour and an energy node."""
    return F.filter(path, lambda x: x["Hour"].isNotNull() & x["EnergyMW"].isNotNull())


def _hour_or_null(text: Column) -> Column:
    return G.integer_or_null(text).try_cast("int")


def _hourly_errors(path: str, name: str) -> Column:
    """Complete entries whose hour or energy is no number, as (field, text)."""
    wrong = F.filter(
        _complete(path),
        lambda x: _hour_or_null(x["Hour"]).isNull() | G.coerce_number(x["EnergyMW"]).isNull(),
    )
    text = lambda x: F.concat(x["EnergyMW"], F.lit(" at hour "), x["Hour"])
    return F.transform(wrong, lambda x: F.struct(F.lit(name).alias("field"), text(x).alias("text")))


def _hourly_values(path: str, strict: bool) -> Column:
    """Complete entries, typed, in document order."""
    if strict:
        hour, energy = (lambda c: G.strict_int(c).cast("int")), G.strict_double
    else:
        hour, energy = _hour_or_null, G.coerce_number
    typed = F.transform(
        _complete(path),
        lambda x: F.struct(hour(x["Hour"]).alias("hour"), energy(x["EnergyMW"]).alias("mw")),
    )
    return F.coalesce(F.filter(typed, lambda x: x["hour"].isNotNull()), F.array())


def _last_of_hour(name: str, hour: Column) -> Column:
    same_hour = F.filter(name, lambda x: x["hour"] == hour)
    return F.try_element_at(same_hour, F.lit(-1))["mw"]
