from gridspan.functions.parsing import (
    coerce_hour,
    coerce_number,
    integer_or_null,
    is_date,
    nan_to_null,
    parse_any_date,
    parse_any_timestamp,
    parse_date,
    strict_double,
    strict_int,
    value_or_error,
)
from gridspan.functions.predicates import (
    hour_out_of_range,
    is_blank,
    is_missing,
    is_negative,
    value_or_zero,
)
from gridspan.functions.stamps import hour_start, load_date, load_second, wall_clock

__all__ = [
    "coerce_hour", "coerce_number", "integer_or_null", "is_date", "nan_to_null", "parse_any_date",
    "parse_any_timestamp", "parse_date", "strict_double", "strict_int", "value_or_error",
    "hour_out_of_range", "is_blank", "is_missing", "is_negative", "value_or_zero", "hour_start",
    "load_date", "load_second", "wall_clock",
]
