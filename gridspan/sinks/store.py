"""Parquet tables partitioned by date below one root folder, and their audit register.

Writes are idempotent overwrites of whole date partitions, so a retried task or a
repeated batch gives the same table. There is one writer per table: a plain Parquet
folder has no transactions between writers.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspan import schemas
from gridspan.functions import load_date, wall_clock
from gridspan.operators.slices import latest_slice, on_dates


class EmptyBatchError(ValueError):
    """A batch has fewer rows than its source must deliver."""


def require_rows(df: DataFrame, min_rows: int) -> DataFrame:
    """Fails if `df` has fewer rows; reads a few partitions at a time until it has enough."""
    if min_rows and len(df.select(F.lit(1)).take(min_rows)) < min_rows:
        raise EmptyBatchError(f"batch has fewer than {min_rows} rows")
    return df


@dataclass(frozen=True)
class Store:
    spark: SparkSession
    root: str

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def read(self, table: str, schema: str | None = None) -> DataFrame:
        reader = self.spark.read.schema(schema) if schema else self.spark.read
        return reader.parquet(self.path(table))

    def exists(self, table: str) -> bool:
        try:
            self.read(table, "_ INT")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return False
        return True

    def replace_table(self, df: DataFrame, table: str, date: str | None = "Date") -> None:
        """Drops what the table held and writes `df` with its own schema."""
        writer = self._evened(df, date).write.mode("overwrite")
        writer = writer.option("partitionOverwriteMode", "static")
        (writer.partitionBy(date) if date else writer).parquet(self.path(table))
        self._log_unknown(table)

    def upsert(
        self,
        batch: DataFrame,
        table: str,
        date: str = "Date",
        mode: str = "latest",
        registered: bool = False,
    ) -> None:
        """Replaces the batch's dates in the table; an empty batch changes nothing.

        mode 'latest' writes the batch's newest date only, 'all_dates_in_batch' each. Rows
        without a date belong to no slice and aren't written. `registered` says that the
        caller registers the write with its dates; else the next registered write counts
        the whole table.
        """
        batch = batch.filter(F.col(date).isNotNull())
        if mode == "latest":
            batch = latest_slice(batch, date)
        elif mode != "all_dates_in_batch":
            raise ValueError(f"unknown upsert mode: {mode}")
        self._overwrite_dates(batch, table, date, registered)

    def replace_slice(
        self,
        batch: DataFrame,
        table: str,
        key: str,
        date: str = "Date",
        min_rows: int = 1,
        registered: bool = False,
    ) -> None:
        """Replaces the one date `key` ('yyyy-MM-dd'); a row of another date fails the job."""
        wanted = F.lit(key).cast("date")
        stray = F.raise_error(F.concat(F.lit(f"row outside slice {key}: "), F.col(date)))
        guarded = batch.withColumn(
            date, F.when(F.col(date).eqNullSafe(wanted), F.col(date)).otherwise(stray)
        )
        self._overwrite_dates(require_rows(guarded, min_rows), table, date, registered)

    def _overwrite_dates(self, batch: DataFrame, table: str, date: str, registered: bool) -> None:
        (
            self._evened(batch, date)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(date)
            .parquet(self.path(table))
        )
        if not registered:
            self._log_unknown(table)

    @staticmethod
    def _evened(df: DataFrame, date: str | None) -> DataFrame:
        """Rows of a date together in files of even size.

        The rebalance splits a date that holds most of the rows over several tasks and
        merges small ones, so neither one task nor a flood of tiny files results.
        """
        return df.hint("rebalance", date) if date else df.hint("rebalance")

    def read_log(self, log: str, schema: str) -> DataFrame:
        """All rows of a log, which has a folder for each table and write; empty without any."""
        if not self.exists(log):
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("recursiveFileLookup", "true")
        return reader.parquet(self.path(log))

    def date_counts(self, table: str) -> DataFrame:
        """(Date, row_count) of the table, by the counts its registered writes left.

        Of a date, the last write that wrote it counts, and none before the last write of the
        whole table does. Only the log is read.
        """
        log = self._counts(table)
        from_turn = log.filter("whole").agg(F.coalesce(F.max("turn"), F.lit(0))).scalar()
        last = log.filter(F.col("turn") >= from_turn).groupBy("Date").agg(
            F.max_by("row_count", "turn").alias("row_count")
        )
        return last.filter("row_count > 0")

    def _counts(self, table: str) -> DataFrame:
        return self.read_log(f"{schemas.DATE_COUNTS}/{table}", schemas.DATE_COUNTS_SCHEMA)

    def _log_dates(self, table: str, write: str, turn: int, whole: bool, counts: DataFrame) -> None:
        rows = counts.select(
            F.lit(write).alias("write"), F.lit(turn).cast("bigint").alias("turn"),
            F.lit(whole).alias("whole"), "Date", "row_count",
        )
        path = f"{self.path(schemas.DATE_COUNTS)}/{table}/{write}"
        rows.coalesce(1).write.mode("overwrite").parquet(path)

    def _no_date(self, row_count: int | None) -> DataFrame:
        return self.spark.range(1).select(
            F.lit(None).cast("date").alias("Date"), F.lit(row_count).cast("bigint").alias("row_count")
        )

    def _log_unknown(self, table: str) -> None:
        """Notes, where counts are kept, that a write has left them out of date."""
        if self.exists(f"{schemas.DATE_COUNTS}/{table}"):
            turn = self._counts(table).agg(F.max("turn")).first()[0] + 1
            self._log_dates(table, f"unknown-{turn}", turn, True, self._no_date(None))

    def _log_counts(self, table: str, write: str, changed: DataFrame | None) -> None:
        """Logs how many rows the dates of `changed`, or all dates, now have in the table.

        Only the partitions of these dates are read, for the row counts of their files.
        """
        others = self._counts(table).filter(F.col("write") != write)
        turns = [F.coalesce(F.max(F.when(c, F.col("turn"))), F.lit(0)) for c in (
            F.lit(True), F.col("whole") & F.col("row_count").isNull(),
            F.col("whole") & F.col("row_count").isNotNull(),
        )]
        last, unknown, known = others.agg(*turns).first()
        rows = self.read(table)
        whole = changed is None or known <= unknown
        if not whole:
            rows = on_dates(rows, changed)
        date = F.col("Date") if "Date" in rows.columns else F.lit(None).cast("date")
        counts = rows.groupBy(date.alias("Date")).agg(F.count(F.lit(1)).alias("row_count"))
        if whole:  # a row that stands for the write, even if it left an empty table
            counts = counts.unionByName(self._no_date(0)).groupBy("Date")
            counts = counts.agg(F.sum("row_count").alias("row_count"))
        self._log_dates(table, write, last + 1, whole, counts)

    def append_register(
        self, table: str, instant: datetime, write: str | None = None, changed: DataFrame | None = None
    ) -> None:
        """One audit row with the row count of the whole table after a write.

        The count is the sum over dates that `date_counts` knows; `changed` has the dates the
        write has written, and without it all dates are counted anew. Each table has a register
        folder of its own and each write a folder in it, so feeds that write at once don't meet
        and a repeated write replaces its own row. A write is known by `write`, which a stream
        derives from its batch, or else by its instant. The id is the instant in microseconds.
        """
        layer, name = table.rsplit("/", 1)
        since = instant - datetime.fromtimestamp(0, timezone.utc)
        number = since // timedelta(microseconds=1)
        write = write or str(number)
        self._log_counts(table, write, changed)
        counted = self.date_counts(table).agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("ROW_COUNT"))
        path = f"{self.path(schemas.TABLE_REGISTER)}/{table}/{write}"
        counted.select(
            F.lit(number).cast("bigint").alias("id"),
            F.lit(name).alias("TABLE_NAME"),
            F.lit(layer).alias("TABLE_SCHEMA"),
            load_date(instant).alias("MODIFIED_DT"),
            wall_clock(instant).alias("MODIFIED_TIME"),
            "ROW_COUNT",
            wall_clock(instant).alias("created_at"),
        ).coalesce(1).write.mode("overwrite").parquet(path)

    def register(self) -> DataFrame:
        return self.read_log(schemas.TABLE_REGISTER, schemas.REGISTER_SCHEMA)

    def latest_writes(self, n: int = 10) -> DataFrame:
        return latest_writes(self.register(), n)


def latest_writes(register: DataFrame, n: int = 10) -> DataFrame:
    """The `n` newest register rows."""
    return (
        register.orderBy(F.desc("MODIFIED_TIME"), F.desc("id"))
        .limit(n)
        .select("TABLE_NAME", "TABLE_SCHEMA", "MODIFIED_DT", "ROW_COUNT")
    )
