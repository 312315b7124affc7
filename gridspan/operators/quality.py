"""Data checks: all rules of a table in one aggregate pass, one result row per rule."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspan.functions import hour_out_of_range, is_blank, is_missing, is_negative
from gridspan.operators.reshape import missing_columns


class DataCheckError(ValueError):
    """An error rule failed."""


@dataclass(frozen=True)
class Rule:
    """A named predicate whose true rows are violations."""

    name: str
    severity: str
    column: str
    violates: Column


def hour_rule(column: str = "Hour") -> Rule:
    return Rule("hour_range", "error", column, hour_out_of_range(column))


def non_negative_rule(column: str) -> Rule:
    return Rule("non_negative", "error", column, is_negative(column))


def blank_rule(column: str) -> Rule:
    return Rule("not_blank", "warning", column, is_blank(column))


def digest_key(df: DataFrame, long_text: Sequence[str] = ()) -> list[Column]:
    """Grouping columns for whole-row equality.

    Columns named in `long_text` are compared by SHA-256, so a shuffle moves 32 bytes
    in place of a document. NULL stays NULL and equals NULL in a grouping.
    """
    return [
        F.unhex(F.sha2(F.col(f"`{c}`"), 256)).alias(c) if c in long_text else F.col(f"`{c}`")
        for c in df.columns
    ]


def duplicate_rows(df: DataFrame, long_text: Sequence[str] = ()) -> DataFrame:
    """Rows beyond the first of each group of equal rows, as a one-row result."""
    groups = df.select(*digest_key(df, long_text)).groupBy(*[f"`{c}`" for c in df.columns])
    copies = groups.agg(F.count(F.lit(1)).alias("_copies"))
    return copies.agg(
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).cast("bigint").alias("duplicates"),
        F.coalesce(F.sum("_copies"), F.lit(0)).cast("bigint").alias("row_count"),
    )


def check(
    df: DataFrame | None,
    required: Sequence[str],
    rules: Sequence[Rule] = (),
    min_rows: int = 1,
    check_nulls: bool = True,
    check_duplicates: bool = False,
    long_text: Sequence[str] = (),
) -> DataFrame:
    """Rows of (step, rule, severity, column, violations, passed), in evaluation order.

    Rules on a column the table lacks are left out; the missing column is itself a
    failed rule. Only the duplicate check needs a pass of its own.
    """
    if df is None:
        raise DataCheckError("no table to check")
    missing = missing_columns(df, required)
    types = dict(df.dtypes)
    min_rows_gap = F.greatest(F.lit(min_rows) - F.count(F.lit(1)), F.lit(0))

    measured = [
        ("min_rows", "error", "*", min_rows_gap),
        ("required_columns", "error", ",".join(missing) or "*", len(missing)),
    ]
    if check_nulls:
        measured += [
            ("not_null", "warning", c, F.count_if(is_missing(c, types[c])))
            for c in required
            if c in types
        ]
    duplicates_step = len(measured) + 1
    steps = list(range(1, len(measured) + 1))
    known = [r for r in rules if r.column in types]
    measured += [(r.name, r.severity, r.column, F.count_if(r.violates)) for r in known]
    steps += list(range(duplicates_step + 1, duplicates_step + 1 + len(known)))

    report = _report(df, steps, measured)
    if check_duplicates:
        found = [("no_duplicates", "warning", "*", F.max("duplicates"))]
        report = report.unionByName(
            _report(duplicate_rows(df, long_text), [duplicates_step], found)
        )
    return report


def _report(df: DataFrame, steps: Sequence[int], measured: Sequence[tuple]) -> DataFrame:
    """One aggregate row, turned into one row per measured rule.

    A rule measures either an aggregate or a number known from the schema alone.
    """
    aggregates = {
        f"v{step}": measure
        for step, (_, _, _, measure) in zip(steps, measured)
        if isinstance(measure, Column)
    }
    counts = df.agg(*[measure.alias(name) for name, measure in aggregates.items()])
    rows = []
    for step, (rule, severity, column, measure) in zip(steps, measured):
        violations = F.col(f"v{step}") if f"v{step}" in aggregates else F.lit(measure)
        rows.append(
            F.struct(
                F.lit(step).alias("step"),
                F.lit(rule).alias("rule"),
                F.lit(severity).alias("severity"),
                F.lit(column).alias("column"),
                violations.cast("bigint").alias("violations"),
                (violations == 0).alias("passed"),
            )
        )
    return counts.select(F.inline(F.array(*rows)))


def enforce(report: DataFrame) -> list:
    """Raises on the first failed error rule; returns the failed warnings.

    The report has one row per rule, so fetching it is bounded by the rule list.
    """
    failed = report.filter("NOT passed").orderBy("step").collect()
    for r in failed:
        if r.severity == "error":
            raise DataCheckError(f"{r.rule} failed on {r.column}: {r.violations} violations")
    return failed


def check_demand(df: DataFrame, **options) -> DataFrame:
    return check(
        df,
        ["Date", "Hour", "Market_Demand", "Ontario_Demand"],
        [hour_rule(), non_negative_rule("Market_Demand"), non_negative_rule("Ontario_Demand")],
        **options,
    )


def check_zonal(df: DataFrame, **options) -> DataFrame:
    return check(df, ["Date", "Hour"], [hour_rule()], **options)


def check_generator(df: DataFrame, fuel: str = "fuel_type", **options) -> DataFrame:
    return check(df, ["Date", fuel], [blank_rule(fuel)], **options)
