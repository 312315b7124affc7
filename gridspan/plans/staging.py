"""Typed batches with what was wrong in them, stored once for all that a job does with them.

A batch is scanned and typed in a single pass, into a table in the shared scratch folder.
What the job has to know before it goes on (rows, broken rows, wrong values) is observed by
that same write, so nothing is read again to count it.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from gridspan import schemas
from gridspan.operators.typing import ERRORS, IS_ROW
from gridspan.session import scratch
from gridspan.sinks.store import Store
from gridspan.sources.files import BROKEN, LANDING, with_broken

_FLAGS = (BROKEN, ERRORS, IS_ROW)


def _is_row() -> Column:
    return F.col(BROKEN).isNull() & F.col(IS_ROW)


@dataclass(frozen=True)
class Staged:
    """A stored typed batch, flags and landing column included, and what its write observed."""

    df: DataFrame
    scanned: int
    rows: int
    broken: int
    wrong: int

    def table_rows(self) -> DataFrame:
        """What belongs into the table: wrong values are NULL, or 0 where the table has no NULL."""
        return self.df.filter(_is_row()).drop(*_FLAGS)

    def without(self, reports: DataFrame) -> Staged:
        """The batch less the reports that a stored table names."""
        names = reports.select(F.col("report").alias("_report"))
        same = F.col(f"{LANDING}.report") == F.col("_report")
        return Staged(self.df.join(names, same, "left_anti"), self.scanned, self.rows, 0, 0)


def stage(raw: DataFrame, fields: list[str] | None, shape, instant: datetime) -> Staged:
    """Types a tolerant scan by `shape`, in one pass; `fields` are the columns of a CSV layout."""
    scanned, typed = Observation(), Observation()
    checked = with_broken(raw, fields).observe(scanned, F.count(F.lit(1)).alias("n"))
    df = shape(checked, instant)

    def number(which: Column) -> Column:
        return F.coalesce(F.sum(which.cast("bigint")), F.lit(0))

    observed = df.observe(
        typed, number(_is_row()).alias("rows"), number(F.col(BROKEN).isNotNull()).alias("broken"),
        number(F.size(ERRORS)).alias("wrong"),
    )
    path = scratch(raw.sparkSession, "staged")
    observed.write.parquet(path)
    stored = raw.sparkSession.read.schema(df.schema).parquet(path)
    return Staged(stored, scanned.get["n"], **typed.get)


def _report(df: DataFrame) -> Column:
    """The report a row is from; a batch without landing column is one without a name."""
    return F.col(f"{LANDING}.report") if LANDING in df.columns else F.lit(None).cast("string")


def bad_reports(staged: Staged, table: str, strict: bool, min_rows: int) -> DataFrame:
    """(report, counts, reason, example) of reports that can't be taken in.

    A report with a broken row can't, nor one with fewer rows than it must deliver, nor,
    if strict, one with a wrong value.
    """
    wrong = F.get(ERRORS, F.lit(0))
    found = staged.df.groupBy(_report(staged.df).alias("report")).agg(
        F.count(BROKEN).alias("broken_rows"),
        F.sum(F.size(ERRORS)).cast("bigint").alias("wrong_values"),
        F.sum(_is_row().cast("bigint")).alias("table_rows"),
        F.min(BROKEN).alias("_broken_text"),
        F.min(F.concat_ws(": ", wrong["field"], wrong["text"])).alias("_wrong_text"),
    )
    reason = F.when(F.col("broken_rows") > 0, "broken")
    if strict:
        reason = reason.when(F.col("wrong_values") > 0, "wrong value")
    reason = reason.when(F.col("table_rows") < min_rows, "too few rows")
    example = F.when(F.col("reason") == "broken", F.col("_broken_text")).otherwise(
        F.nullif(F.col("_wrong_text"), F.lit(""))
    )
    return found.withColumn("reason", reason).filter("reason IS NOT NULL").select(
        "report", "broken_rows", "wrong_values", "table_rows", "reason",
        example.alias("example"), F.lit(table).alias("table"),
    )


def write_quarantine(store: Store, staged: Staged, table: str, write: str) -> None:
    """Keeps each broken row and each wrong value of a batch, with the row it stood in.

    A repeated write replaces its own rows.
    """
    row = F.to_json(F.struct([c for c in staged.df.columns if c not in (*_FLAGS, LANDING)]))
    broken = F.struct(F.lit("row").alias("field"), F.col(BROKEN).alias("text"))
    errors = F.when(F.col(BROKEN).isNotNull(), F.array(broken)).otherwise(F.col(ERRORS))
    rows = staged.df.filter(F.col(BROKEN).isNotNull() | (F.size(ERRORS) > 0)).select(
        _report(staged.df).alias("report"), F.explode(errors).alias("e"),
        F.when(F.col(BROKEN).isNull(), row).alias("row"), F.lit(table).alias("table"),
    )
    path = f"{store.path(schemas.QUARANTINE)}/{table}/{write}"
    rows.select("report", "e.field", "e.text", "row", "table").write.mode("overwrite").parquet(path)


def quarantine(store: Store) -> DataFrame:
    """All rows and values set aside: (report, field, text, row, table)."""
    return store.read_log(schemas.QUARANTINE, schemas.QUARANTINE_SCHEMA)


def rejected_reports(store: Store) -> DataFrame:
    """All reports set aside, with why."""
    return store.read_log(schemas.REJECTED_REPORTS, schemas.REJECTED_SCHEMA)
