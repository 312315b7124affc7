"""The jobs: landed report files to raw tables, raw zonal demand to the primary table.

Each job is scan, type, slice, write, register. Hourly jobs upsert the newest date;
full loads replace the table and, like the jobs they stand for, write no register row.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspan import schemas
from gridspan.operators import quality, typing
from gridspan.operators.reshape import wide_to_long
from gridspan.operators.slices import latest_slice, newest_reports, on_dates
from gridspan.plans import staging
from gridspan.sinks.store import EmptyBatchError, Store, require_rows
from gridspan.sources import files


@dataclass(frozen=True)
class Feed:
    """A report: how it is scanned and typed, its table, and the rows it must deliver.

    `parse_once` keeps a typed batch while the job reads it several times, for XML, which
    costs more to parse than to keep.
    """

    scan: Callable
    shape: Callable[[DataFrame, datetime], DataFrame]
    table: str
    min_rows: int = 0
    fields: list[str] | None = None
    check: Callable[..., DataFrame] | None = None
    parse_once: bool = False


FEEDS = {
    "demand": Feed(
        files.scan_demand_csv, typing.type_demand, schemas.DEMAND,
        fields=schemas.DEMAND_COLUMNS, check=quality.check_demand,
    ),
    "zonal": Feed(
        files.scan_zonal_csv, typing.type_zonal, schemas.ZONAL_DEMAND,
        fields=schemas.ZONAL_COLUMNS, check=quality.check_zonal,
    ),
    "fuel": Feed(
        files.scan_fuel_xml, lambda raw, _: typing.flatten_fuel(raw), schemas.FUEL_OUTPUT,
        min_rows=1, check=quality.check_generator, parse_once=True,
    ),
    "capability": Feed(
        files.scan_capability_xml, lambda raw, _: typing.flatten_capability(raw),
        schemas.CAPABILITY, min_rows=1,
        check=partial(quality.check_generator, fuel="FuelType"), parse_once=True,
    ),
}


def reject_over_long(raw: DataFrame, names: list[str]) -> DataFrame:
    """Fails the job on a line with too many fields, instead of cutting it."""
    line = F.concat(F.lit("line has too many fields: "), F.col(files.REJECT))
    failure = F.raise_error(line).cast("boolean")
    return raw.filter(F.when(files.over_long_rows(names), failure).otherwise(F.lit(True)))


def typed_batch(feed: Feed, raw: DataFrame, instant: datetime) -> DataFrame:
    if feed.fields:
        raw = reject_over_long(raw, feed.fields)
    return feed.shape(raw, instant)


def settled(batch: DataFrame, mode: str) -> DataFrame:
    """The rows an hourly job writes: of one report, or of each landed report in turn."""
    if files.LANDING in batch.columns:
        return newest_reports(batch, files.LANDING, mode=mode)
    return latest_slice(batch) if mode == "latest" else batch


def write_settled(store: Store, feed: Feed, rows: DataFrame, instant: datetime, write: str | None) -> None:
    """Writes all dates of `rows` and registers the write."""
    store.upsert(rows, feed.table, mode="all_dates_in_batch", registered=True)
    dated = rows.filter(F.col("Date").isNotNull()).select("Date")
    store.append_register(feed.table, instant, write, dated)


def ingest(
    store: Store,
    name: str,
    raw: DataFrame,
    instant: datetime,
    mode: str = "latest",
    validate: bool = False,
    write: str | None = None,
    strict: bool = True,
) -> None:
    """The hourly job: upsert a scanned batch and register the write.

    The batch is one report, however many files it was scanned from, unless it carries
    the landing column: then each file is a report of its own. `validate` runs the
    table's checks first and stops on the first failed error rule. `write` names the write
    in the register.

    A strict job fails on a line with too many fields and on text that is no value. Otherwise
    such lines and values go into the quarantine table, and a value is NULL, or 0 where the
    table has no NULL; `raw` has to be a tolerant scan then.
    """
    feed = FEEDS[name]
    if not strict:
        staged = staging.stage(raw, feed.fields, feed.shape, instant)
        if staged.rows < feed.min_rows:
            raise EmptyBatchError(f"batch has fewer than {feed.min_rows} rows")
        if staged.broken or staged.wrong:
            name = write or f"{instant:%Y%m%dT%H%M%S%f}"
            staging.write_quarantine(store, staged, feed.table, name)
        batch = staged.table_rows()
    else:
        batch = typed_batch(feed, raw, instant)
        if feed.parse_once:
            batch = batch.persist()
    try:
        if strict:
            require_rows(batch, feed.min_rows)
        rows = settled(batch, mode)
        if validate:
            quality.enforce(feed.check(rows, min_rows=feed.min_rows))
        write_settled(store, feed, rows, instant, write)
    finally:
        batch.unpersist()


def replace_report(
    store: Store, name: str, raw: DataFrame, key: str, instant: datetime
) -> None:
    """The job of a report that holds one date: that date ('yyyy-MM-dd') is replaced."""
    feed = FEEDS[name]
    batch = typed_batch(feed, raw, instant).persist()
    try:
        store.replace_slice(batch, feed.table, key, min_rows=feed.min_rows, registered=True)
        store.append_register(feed.table, instant, changed=batch.select("Date"))
    finally:
        batch.unpersist()


def full_load(store: Store, name: str, raw: DataFrame, instant: datetime) -> None:
    """The one-time job: replace the table with everything the files hold."""
    feed = FEEDS[name]
    batch = typed_batch(feed, raw, instant)
    if feed.parse_once:
        batch = batch.persist()
    try:
        store.replace_table(require_rows(batch, feed.min_rows), feed.table)
    finally:
        if feed.parse_once:
            batch.unpersist()


def refresh_primary(
    store: Store,
    instant: datetime,
    changed: DataFrame | None = None,
    write: str | None = None,
) -> None:
    """Zonal demand, wide to long, into the primary table.

    Without `changed` the table is replaced as a whole; with a frame of changed dates
    only those partitions are read and rewritten.
    """
    raw = store.read(schemas.ZONAL_DEMAND)
    if changed is None:
        store.replace_table(wide_to_long(raw), schemas.PRIMARY_ZONAL_DEMAND)
    else:
        rows = wide_to_long(on_dates(raw, changed))
        store.upsert(
            rows, schemas.PRIMARY_ZONAL_DEMAND, mode="all_dates_in_batch", registered=True
        )
    store.append_register(schemas.PRIMARY_ZONAL_DEMAND, instant, write, changed)
