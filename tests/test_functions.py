from __future__ import annotations

import math
from datetime import date, datetime, timezone

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as hs
from pyspark.sql import functions as F

from gridspan import functions as G

NUMBERS = [
    "12", " 12 ", "1.5", "1d", "1f", "1L", "nan", "NaN", "inf", "-inf", "Infinity", "1,000",
    "", "1e3", "1E+3", ".5", "5.", "+5", "0x10", "1_000", "True", "1e", "--1", "1 2", "\t7",
    "1e400", "-0", "bad", None, "1e0", "1e00", "1e-400", "2E307", "1e300", "9e299", "5.e1", ".e1",
    "68423.46d", "12e", "1.2.3", "1e308", "1.5e308", "0.001e310", "1e309", "-1e309", "1e99999", "infinit", "INFINITY", "+inf", "-.5e-1",
]
DATES = [
    "2025-01-02", "2025-1-2", "20250102", " 2025-01-02", "2025-01-02 ", "2025-13-02",
    "25-01-02", "02025-01-02", "2025-01-02T00:00", "", "2025-02-30", "0001-01-01",
    "2025-001-02", "12025-01-02", "2300-01-01", "1677-09-21", "1677-09-22", "2262-04-11",
    "2262-04-12", "Date", None,
]


def texts(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "i int, v string").coalesce(1)


def column(spark, values, expression):
    rows = texts(spark, values).select("i", expression.alias("x")).orderBy("i").collect()
    return [r.x for r in rows]


def test_numbers_agree_with_pandas(spark):
    expected = pd.to_numeric(pd.Series(NUMBERS), errors="coerce")
    actual = column(spark, NUMBERS, G.coerce_number("v"))
    assert [None if math.isnan(x) else x for x in expected] == actual


def test_dates_agree_with_pandas(spark):
    expected = pd.to_datetime(pd.Series(DATES), errors="coerce", format="%Y-%m-%d")
    actual = column(spark, DATES, G.parse_date("v"))
    assert [None if pd.isna(x) else x.date() for x in expected] == actual


def test_number_text_agrees_with_pandas_on_random_text(spark):
    seen = []

    @given(hs.text(alphabet="0123456789.eE+-dfL _,", max_size=8))
    @settings(max_examples=400, deadline=None, database=None)
    def gather(text):
        seen.append(text)

    gather()
    # Its fast parser may miss the last bit of a large exponent, so closeness is enough.
    expected = pd.to_numeric(pd.Series(seen), errors="coerce")
    actual = column(spark, seen, G.coerce_number("v"))
    wrong = [
        (t, e, a)
        for t, e, a in zip(seen, expected, actual)
        if math.isnan(e) != (a is None) or (a is not None and not math.isclose(e, a))
    ]
    assert wrong == []


def test_hour_is_integral_or_missing(spark):
    values = ["1", "24", "12.5", "12.0", "x", None, "1e1", "inf", "3000000000"]
    assert column(spark, values, G.coerce_hour("v")) == [1, 24, None, 12, None, None, 10, None, None]


def test_conversions_do_not_depend_on_ansi(spark):
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            assert column(spark, ["x", "2"], G.coerce_number("v")) == [None, 2.0]
            with pytest.raises(Exception, match="not an integer"):
                column(spark, ["1.5"], G.strict_int("v"))
        finally:
            spark.conf.set("spark.sql.ansi.enabled", "true")


@pytest.mark.parametrize("bad", ["1.5", "", "abc", "99999999999999999999"])
def test_strict_int_fails(spark, bad):
    with pytest.raises(Exception, match="not an integer"):
        column(spark, [bad], G.strict_int("v"))


def test_strict_numbers_keep_null(spark):
    assert column(spark, ["-7", " 8 ", None], G.strict_int("v")) == [-7, 8, None]
    assert column(spark, ["1.5", None], G.strict_double("v")) == [1.5, None]
    with pytest.raises(Exception, match="not a number"):
        column(spark, [""], G.strict_double("v"))


def test_free_form_dates(spark):
    values = ["2025-01-02", "2025/1/2", "1/2/2025", "20250102", "Jan 2, 2025", "2 Jan 2025",
              "2025-01-02T03:04:05", " 2025-01-02 03:04 ", None]
    expected = [date(2025, 1, 2)] * 8 + [None]
    assert column(spark, values, G.parse_any_date("v")) == expected
    assert column(spark, ["2025-01-02T03:04:05"], G.parse_any_timestamp("v")) == [
        datetime(2025, 1, 2, 3, 4, 5)
    ]
    with pytest.raises(Exception, match="not a date"):
        column(spark, ["someday"], G.parse_any_date("v"))
    assert column(spark, ["someday", "2025-13-40"], G.parse_any_date("v", strict=False)) == [
        None, None,
    ]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_stamps_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        winter = datetime(2025, 1, 2, 4, 30, 5, 678000, tzinfo=timezone.utc)
        summer = datetime(2025, 7, 2, 4, 30, 5, tzinfo=timezone.utc)
        row = spark.range(1).select(
            G.load_date(winter).alias("d"), G.load_second(winter).alias("s"),
            G.wall_clock(summer).alias("w"),
        ).first()
        assert row.d == date(2025, 1, 1)
        assert row.s == datetime(2025, 1, 1, 23, 30, 5)
        assert row.w == datetime(2025, 7, 2, 0, 30, 5)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_stamp_needs_a_zone():
    with pytest.raises(ValueError):
        G.wall_clock(datetime(2025, 1, 1))


def test_hour_start(spark):
    df = spark.sql("SELECT date'2025-03-09' AS Date, h AS Hour FROM VALUES (1), (3), (24) t(h)")
    assert [r.t for r in df.select(G.hour_start().alias("t")).collect()] == [
        datetime(2025, 3, 9, 0), datetime(2025, 3, 9, 2), datetime(2025, 3, 9, 23),
    ]


def test_predicates_pass_missing_values(spark):
    df = spark.sql("SELECT * FROM VALUES (0, -1D, ''), (25, 0D, ' \t '), (NULL, NULL, NULL), "
                   "(24, 1D, 'GAS') t(Hour, x, f)")
    row = df.select(
        F.count_if(G.hour_out_of_range()).alias("h"), F.count_if(G.is_negative("x")).alias("n"),
        F.count_if(G.is_blank("f")).alias("b"),
    ).first()
    assert (row.h, row.n, row.b) == (2, 1, 2)


def test_nan_to_null(spark):
    df = spark.sql("SELECT * FROM VALUES (1D), (double('NaN')), (NULL) t(x)")
    assert [r.x for r in df.select(G.nan_to_null("x").alias("x")).collect()] == [1.0, None, None]
