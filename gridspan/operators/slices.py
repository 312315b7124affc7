"""Latest-date slices, date ranges and the two forms of the upsert as queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

MODES = ("latest", "all_dates_in_batch")


def _newest(df: DataFrame, date: str) -> Column:
    """Start of the newest date, as a scalar subquery that scans the one column."""
    data_type = df.schema[date].dataType
    newest = F.max(date)
    if isinstance(data_type, (TimestampNTZType, TimestampType)):
        newest = F.to_date(newest).cast(data_type)
    return df.agg(newest.alias("newest")).scalar()


def latest_slice(df: DataFrame, date: str = "Date") -> DataFrame:
    """Rows of the newest date in `df`.

    The comparison is on the bare column: it prunes partitions of a stored table and
    reaches the Parquet scan as a range filter for a timestamp column.
    """
    if isinstance(df.schema[date].dataType, (TimestampNTZType, TimestampType)):
        return df.filter(F.col(date) >= _newest(df, date))
    return df.filter(F.col(date) == _newest(df, date))


def date_range(df: DataFrame, date: str = "Date", by: list[str] | None = None) -> DataFrame:
    return df.groupBy(*(by or [])).agg(
        F.min(date).alias("first_date"),
        F.max(date).alias("last_date"),
        F.count(F.lit(1)).alias("row_count"),
    )


def calendar_dates(df: DataFrame, date: str = "Date") -> DataFrame:
    """The distinct dates of `df`, to be broadcast to a join.

    Parsed dates lie within some 214,000 days, a few megabytes whatever the data's size;
    joining on them then never shuffles a table by date, where one date may hold most rows.
    """
    if not isinstance(df.schema[date].dataType, DateType):
        raise TypeError(f"{date} is not a DATE column")
    return F.broadcast(df.select(date).distinct())


def on_dates(df: DataFrame, changed: DataFrame, date: str = "Date") -> DataFrame:
    """Rows of `df` on the dates that `changed` has.

    The bounds of the dates are scalar subqueries, which prune a stored table's partitions;
    the semi-join then drops dates in between.
    """
    first, last = (changed.agg(f(date)).scalar() for f in (F.min, F.max))
    dates = calendar_dates(changed, date)
    return df.filter(F.col(date).between(first, last)).join(dates, date, "left_semi")


def newest_reports(
    df: DataFrame, landing: str, date: str = "Date", mode: str = "latest"
) -> DataFrame:
    """What taking in several landed reports one after the other would leave.

    Reports overlap: each fetch of a day repeats its earlier hours. Of a date, only the
    rows of the last report that writes it are kept, where a report writes its newest
    date (mode 'latest') or every date it holds ('all_dates_in_batch'). All files of a
    report count as one; it has landed when its last file has, and of reports that landed
    at once the one whose name sorts last is the later.
    """
    if mode not in MODES:
        raise ValueError(f"unknown upsert mode: {mode}")
    if not isinstance(df.schema[date].dataType, DateType):
        raise TypeError(f"{date} is not a DATE column")
    report = F.col(f"{landing}.report")
    files = df.select(report.alias("_report"), f"{landing}.landed_at", date).distinct()
    newest = F.max(date).over(Window.partitionBy("_report")) if mode == "latest" else F.col(date)
    landed = F.max("landed_at").over(Window.partitionBy("_report"))
    writes = files.select("_report", landed.alias("landed_at"), date, newest.alias("newest"))
    writes = writes.filter(F.col(date) == F.col("newest"))
    last = writes.groupBy(date).agg(F.max(F.struct("landed_at", "_report")).alias("last"))
    # At most one row per calendar date, as in `calendar_dates`.
    last = last.select(F.col(date).alias("_date"), F.col("last._report").alias("_report"))
    same = (F.col(date) == F.col("_date")) & (report == F.col("_report"))
    return df.join(F.broadcast(last), same).select(*[c for c in df.columns if c != landing])


def upserted(
    target: DataFrame, batch: DataFrame, date: str = "Date", mode: str = "latest"
) -> DataFrame:
    """What the table holds after an upsert, as a query that writes nothing.

    mode 'latest' takes the batch's newest date only, 'all_dates_in_batch' every one. Rows
    without a date belong to no slice: the target keeps its own, the batch's aren't taken.
    """
    columns = target.columns
    batch = batch.filter(F.col(date).isNotNull())
    if mode == "latest":
        newest = batch.agg(F.max(date)).scalar()
        kept = target.filter((F.col(date) != newest) | F.col(date).isNull() | newest.isNull())
        return kept.unionByName(latest_slice(batch, date).select(columns))
    if mode == "all_dates_in_batch":
        dates = calendar_dates(batch, date)
        return target.join(dates, date, "left_anti").select(columns).unionByName(
            batch.select(columns)
        )
    raise ValueError(f"unknown upsert mode: {mode}")
