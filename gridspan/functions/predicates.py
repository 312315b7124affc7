"""Row predicates of the data checks. A NULL is never a violation of a value rule."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hour_out_of_range(col: str = "Hour") -> Column:
    return F.coalesce(~F.col(col).between(1, 24), F.lit(False))


def is_negative(col: str) -> Column:
    return F.coalesce(F.col(col) < 0, F.lit(False))


def is_blank(col: str) -> Column:
    return F.coalesce(F.trim(F.regexp_replace(F.col(col), r"\s", " ")) == "", F.lit(False))


def is_missing(col: str, data_type: str) -> Column:
    """NULL, or NaN in a floating-point column."""
    missing = F.col(col).isNull()
    return missing | F.isnan(col) if data_type in ("double", "float") else missing


def value_or_zero(col: Column | str) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(0.0))
