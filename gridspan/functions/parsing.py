"""Text to typed columns: tolerant (bad text becomes NULL) and strict (bad text fails).

All of it is built-in expressions, so typing a scan stays inside code generation,
and none of it depends on the session's ANSI switch or time zone.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text forms that count as a finite number, as infinity, as an integer
# or a date, and the first and last date that a nanosecond clock can hold (others are
# rejected).
NUMBER = r"^\s*+[+-]?+(?:\d++(?:\.\d*+)?+|\.\d++)(?:[eE][+-]?+\d++)?+\s*+$"
INFINITE = r"^\s*+[+-]?+(?i:inf(?:inity)?)\s*+$"
INTEGER = r"^\s*[+-]?\d+\s*$"
ISO_DATE = r"^\d{4}-\d{1,2}-\d{1,2}$"
ISO_TIME = r"^\d{4}-\d{1,2}-\d{1,2}([ T]\d.*)?$"
FIRST_DATE = date(1677, 9, 22)
LAST_DATE = date(2262, 4, 11)
OTHER_DATES = {
    r"^\d{8}$": "yyyyMMdd",
    r"^\d{4}/\d{1,2}/\d{1,2}$": "yyyy/M/d",
    r"^\d{1,2}/\d{1,2}/\d{4}$": "M/d/yyyy",
    r"^[A-Z][a-z]{2} \d{1,2}, \d{4}$": "MMM d, yyyy",
    r"^\d{1,2} [A-Z][a-z]{2} \d{4}$": "d MMM yyyy",
}

# Every conversion sits behind its pattern: a failing parse raises and catches an
# exception per row inside Spark, which costs far more than the pattern does. Digits are
# matched possessively, or a long bad number would be tried in every division. And each
# mentions its column as rarely as it can: the projection of a wide report becomes one
# JVM method, and one that grows too long is never compiled to machine code.


def _col(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _known_day(day: Column) -> Column:
    """Whether a date lies in the known range, told by its distance from the middle."""
    span = (LAST_DATE - FIRST_DATE).days
    offset = F.datediff(day, F.lit(FIRST_DATE)) * 2 - span
    return F.coalesce(F.abs(offset) <= span, F.lit(False))


def is_date(col: Column | str) -> Column:
    """Whether text is a year-month-day date; with blanks around it, it is not."""
    text = _col(col)
    return _known_day(F.when(text.rlike(ISO_DATE), text.try_cast("date")))


def parse_date(col: Column | str) -> Column:
    """Year-month-day text to DATE, anything else to NULL."""
    return F.when(is_date(col), _col(col).try_cast("date"))


def parse_any_timestamp(col: Column | str, strict: bool = True) -> Column:
    """Text in one of several usual layouts to a zone-free timestamp.

    NULL stays NULL. Text in no known layout fails the job, or is NULL if not strict.
    """
    text = F.trim(_col(col))
    found = F.when(text.rlike(ISO_TIME), text.try_cast("timestamp_ntz"))
    for pattern, layout in OTHER_DATES.items():
        found = found.when(
            text.rlike(pattern), F.try_to_date(text, layout).cast("timestamp_ntz")
        )
    found = F.when(_known_day(F.to_date(found)), found)
    return _or_fail(text, found, "not a date: ") if strict else found


def parse_any_date(col: Column | str, strict: bool = True) -> Column:
    return F.to_date(parse_any_timestamp(col, strict))


def nan_to_null(col: Column | str) -> Column:
    number = _col(col)
    return F.when(~F.isnan(number), number)


def coerce_number(col: Column | str) -> Column:
    """Text to DOUBLE; what is not a number, or a finite one no double can hold, is NULL.

    The patterns keep out the type suffixes ('1d') that a cast alone would accept.
    """
    text = _col(col)
    number = text.try_cast("double")
    held = F.when(F.abs(number) < float("inf"), number)
    return F.when(text.rlike(NUMBER), held).when(text.rlike(INFINITE), number)


def coerce_hour(col: Column | str) -> Column:
    """Text to INT hour; a fractional hour is no hour slot and becomes NULL."""
    number = coerce_number(col)
    return F.when(number % 1 == 0, number.try_cast("int"))


def _or_fail(text: Column, value: Column, message: str) -> Column:
    return F.when(
        text.isNotNull(), F.coalesce(value, F.raise_error(F.concat(F.lit(message), text)))
    )


def integer_or_null(col: Column | str) -> Column:
    """Integer text to BIGINT, anything else to NULL."""
    text = _col(col)
    return F.when(text.rlike(INTEGER), text.try_cast("bigint"))


def strict_int(col: Column | str) -> Column:
    """Integer text to BIGINT; NULL stays NULL, any other text fails the job."""
    return _or_fail(_col(col), integer_or_null(col), "not an integer: ")


def value_or_error(col: Column | str, value: Column) -> Column:
    """(value, error): text that has no `value` is the error, NULL is neither."""
    text = _col(col)
    return F.struct(value.alias("value"), F.when(text.isNotNull() & value.isNull(), text).alias("error"))


def strict_double(col: Column | str) -> Column:
    """Number text to DOUBLE; NULL stays NULL, any other text fails the job."""
    return _or_fail(_col(col), coerce_number(col), "not a number: ")
