"""Incremental pickup of landed report files.

A report is fetched again every hour. Each fetch lands under a new name and the file source
picks it up once, across restarts, by its checkpoint; where fetches land under one name, a
version of each is taken first (`streaming.versions`). A fetch is one file, or a folder of
files, which then has to appear at once, by a rename. A batch may hold several fetches of a
day, and is written as if the hourly job had taken them in one by one; its partition
overwrites make a replayed batch harmless.

A batch is scanned, typed and counted in one pass. A report that the hourly job would fail on
(a line or document that cannot be read whole, text that is no value, no rows where there
must be some) is set aside and recorded, so it never holds up the ones after it; to be taken
in it has to land again. A pickup that isn't strict takes in what can be read, and keeps wrong
values and lines in the quarantine table.

Zonal batches refresh the primary table in the same step, or a stream of its own does
(`refresh_from_register`), which reads what registered writes have changed.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from zlib import crc32

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridspan import schemas
from gridspan.plans.ingest import FEEDS, Feed, refresh_primary, settled, write_settled
from gridspan.plans.staging import (
    Staged, bad_reports, quarantine, rejected_reports, stage, write_quarantine,
)
from gridspan.session import materialize
from gridspan.sinks.store import Store
from gridspan.sources.files import with_landing

__all__ = ["pick_up", "quarantine", "refresh_from_register", "rejected_reports"]


def _write_name(checkpoint: str, batch_id: int) -> str:
    """A replayed batch registers under the same name, whatever the time."""
    return f"{crc32(checkpoint.encode()):08x}-{batch_id}"


def set_aside(store: Store, feed: Feed, staged: Staged, strict: bool, write: str) -> Staged:
    """The batch without reports that can't be taken in, which are recorded."""
    bad = materialize(bad_reports(staged, feed.table, strict, feed.min_rows), "bad-reports")
    bad.write.mode("overwrite").parquet(f"{store.path(schemas.REJECTED_REPORTS)}/{feed.table}/{write}")
    return staged.without(bad)


def take_in(
    store: Store,
    feed: Feed,
    raw: DataFrame,
    instant: datetime,
    mode: str,
    write: str,
    strict: bool = True,
    primary: bool = False,
) -> None:
    """Types a batch of landed reports and writes what can be taken in."""
    staged = stage(raw, feed.fields, feed.shape, instant)
    if not staged.scanned:
        return
    # An empty report shows in the counts only if it is the only one, so reports that must
    # have rows are looked at one by one.
    if staged.broken or feed.min_rows or (strict and staged.wrong):
        taken = set_aside(store, feed, staged, strict, write)
    else:
        taken = staged
    if staged.wrong and not strict:
        write_quarantine(store, taken, feed.table, write)
    rows = taken.table_rows()
    if feed.min_rows and rows.isEmpty():
        return
    rows = settled(rows, mode)
    write_settled(store, feed, rows, instant, write)
    if primary:
        refresh_primary(store, instant, rows.select("Date"), write)


def pick_up(
    store: Store,
    name: str,
    landing: str,
    checkpoint: str,
    instant: Callable[[], datetime],
    mode: str = "latest",
    interval: str | None = None,
    max_files: int | None = None,
    strict: bool = True,
    primary: bool = True,
) -> StreamingQuery:
    """Starts the pickup of feed `name`; stops when caught up unless `interval` is given.

    `max_files` bounds a batch, so a long backlog is worked off in steps, oldest first; it
    is for reports of one file each, as it could part the files of a folder.
    `mode='all_dates_in_batch'` also takes in late and corrected dates. `instant` is
    asked once per batch for the load stamp. `primary` refreshes the primary table with
    each zonal batch.
    """
    feed = FEEDS[name]
    reader = store.spark.readStream.option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    tolerant = {} if feed.fields else {"strict": False}
    raw = with_landing(feed.scan(reader, landing, **tolerant), landing)

    def handle(batch: DataFrame, batch_id: int) -> None:
        write = _write_name(checkpoint, batch_id)
        take_in(store, feed, batch, instant(), mode, write, strict, primary and name == "zonal")

    return _started(raw, handle, checkpoint, interval)


def refresh_from_register(
    store: Store, checkpoint: str, instant: Callable[[], datetime], interval: str | None = None
) -> StreamingQuery:
    """Starts the refresh of the primary table by what registered zonal writes have changed.

    It reads the dates that each write has logged, once, across restarts: a raw write whose
    refresh didn't come about is made up for by the next run.
    """
    log = f"{store.path(schemas.DATE_COUNTS)}/{schemas.ZONAL_DEMAND}"
    reader = store.spark.readStream.schema(schemas.DATE_COUNTS_SCHEMA)
    changed = reader.option("recursiveFileLookup", "true").parquet(log)

    def handle(batch: DataFrame, batch_id: int) -> None:
        dates = materialize(batch.filter(F.col("Date").isNotNull()).select("Date").distinct(), "dates")
        if not dates.isEmpty():
            refresh_primary(store, instant(), dates, _write_name(checkpoint, batch_id))

    return _started(changed, handle, checkpoint, interval)


class UpstreamTimeout(TimeoutError):
    """Nothing arrived from upstream within the time allowed."""


def await_refresh(query: StreamingQuery, seconds: float) -> None:
    """Waits until a running refresh has taken something in; gives up after `seconds`.

    The wait is the stream's own: it is asked once a second whether a batch had rows.
    """
    for _ in range(max(1, round(seconds))):
        if any(p.numInputRows for p in query.recentProgress):
            return
        if query.awaitTermination(1):
            break
    if not any(p.numInputRows for p in query.recentProgress):
        raise UpstreamTimeout(f"nothing from upstream within {seconds} s")


def _started(
    df: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    interval: str | None,
) -> StreamingQuery:
    writer = df.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()
