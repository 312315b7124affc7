"""Load stamps. The instant is always an argument, so a rerun gives the same rows."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridspan.schemas import ZONE


def wall_clock(instant: datetime | Column, zone: str = ZONE) -> Column:
    """The zone's wall-clock reading of an instant, as TIMESTAMP_NTZ.

    A Python instant must carry its zone; a column is taken as UTC.
    """
    if isinstance(instant, datetime):
        if instant.tzinfo is None:
            raise ValueError("the load instant needs a time zone")
        utc = instant.astimezone(timezone.utc).replace(tzinfo=None)
        instant = F.lit(utc.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), instant)


def load_date(instant: datetime | Column, zone: str = ZONE) -> Column:
    return F.to_date(wall_clock(instant, zone))


def load_second(instant: datetime | Column, zone: str = ZONE) -> Column:
    """Wall clock cut to the whole second."""
    wall = wall_clock(instant, zone)
    fraction = F.extract(F.lit("second"), wall) % 1
    zero = F.lit(0)
    return wall - F.make_dt_interval(zero, zero, zero, fraction)


def hour_start(date: str = "Date", hour: str = "Hour") -> Column:
    """Start of hour slot 1..24 of a local date, as a zone-free timestamp."""
    return F.col(date).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.col(hour) - 1)
