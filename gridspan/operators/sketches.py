"""Profiles that merge: per date, sketches of distinct and of frequent values.

A date's sketches are worked out once. Profiles of any range of dates come from merging them,
without the rows, and after a write only the dates it has changed are worked out anew. Numbers
of rows and missing values are exact. Numbers of distinct values are exact up to some hundred
and within about 2 % (one standard deviation) beyond; counts of frequent values are exact up
to ITEMS / 2 different ones, and beyond that too low by at most a share of 3.5 / ITEMS of all.

A value is told from others by its text. Rows without a date belong to no date and are left
out. NaN counts as missing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspan.functions import is_missing
from gridspan.operators.slices import on_dates
from gridspan.sinks.store import Store

#: Logarithm of the registers of a distinct sketch, and items that a frequency sketch tracks.
REGISTERS, ITEMS = 12, 1024
#: Frequent values of a profile.
TOP = 10


def date_sketches(df: DataFrame, columns: Sequence[str], date: str = "Date") -> DataFrame:
    """(date, column_name, row_count, null_count, distinct, frequent), a row a date and column.

    All columns are sketched in one pass; sketches combine before the shuffle.
    """
    types = dict(df.dtypes)
    text = {c: F.when(~is_missing(c, types[c]), F.col(c).cast("string")) for c in columns}
    named = df.filter(F.col(date).isNotNull()).select(
        date, *[x.alias(f"_c{i}") for i, x in enumerate(text.values())]
    )
    measures = [F.count(F.lit(1)).alias("row_count")]
    for i in range(len(columns)):
        measures += [
            F.count_if(F.isnull(f"_c{i}")).alias(f"_n{i}"),
            F.hll_sketch_agg(f"_c{i}", REGISTERS).alias(f"_d{i}"),
            F.expr(f"approx_top_k_accumulate(_c{i}, {ITEMS})").alias(f"_f{i}"),
        ]
    found = named.groupBy(date).agg(*measures)
    rows = [
        F.struct(
            F.lit(c).alias("column_name"), "row_count", F.col(f"_n{i}").alias("null_count"),
            F.col(f"_d{i}").alias("distinct"), F.col(f"_f{i}").alias("frequent"),
        )
        for i, c in enumerate(columns)
    ]
    return found.select(date, F.inline(F.array(*rows)))


def merged(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, column_name, row_count, null_count, distinct, top) of all dates in `sketches`.

    `top` has the most frequent values with their counts, at most TOP.
    """
    # A missing value is an item of its own in the sketch.
    top = F.expr(f"approx_top_k_estimate(approx_top_k_combine(frequent, {ITEMS}), {TOP + 1})")
    known = F.slice(F.filter(top, lambda x: x["item"].isNotNull()), 1, TOP)
    return sketches.groupBy(*by, "column_name").agg(
        F.sum("row_count").alias("row_count"),
        F.sum("null_count").alias("null_count"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("distinct"),
        known.alias("top"),
    )


def refresh(store: Store, table: str, columns: Sequence[str], changed: DataFrame | None = None) -> str:
    """Brings the table's stored sketches up to date; the name of their table.

    With a frame of changed dates only those partitions are read and rewritten.
    """
    name, rows = f"{table}_sketches", store.read(table)
    if changed is None:
        store.replace_table(date_sketches(rows, columns), name)
    else:
        sketches = date_sketches(on_dates(rows, changed), columns)
        store.upsert(sketches, name, mode="all_dates_in_batch", registered=True)
    return name
