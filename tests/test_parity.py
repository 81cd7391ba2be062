"""Parity: the ANSI-safe recipes equal the plain expressions of the original
job evaluated the way it ran them (non-ANSI casts, LEGACY time parser)."""

import contextlib
import math

import pytest
from pyspark.sql import functions as F

from statflow.functions import int_trunc, parse_iso_date, parse_long_date, to_float
from tests.conftest import one_col

NUMBERS = [
    "12.5", "-3.9", "19805.0", " 7 ", ".", "2147483647.9", "3e2", "NaN", "1.5f", "--",
    "1,000", "99999999999", "", None, "+5", "-.5", "\t12\n", "12.", "-0", "0.0",
    "2147483646.99999999999999999999", "-2147483648", "-2147483649", "Infinity", "1e-3",
    "0x1A", " -12.75 ", "+.", "00012", "1 2", "1.5d", "1e39", "-Infinity", "+NaN", "12 .5",
    "1_000", "\uff11\uff12", "\u0661\u0662", "+0", "-0.0", "00012.50", ".e1", "1e", "\x0012",
    "12\x00", "\x1f7\x01", "9" * 40, "0." + "9" * 40, "-2147483648.9", "2147483648", "  ",
    "12.5\u2028", "12\u0085", "7\n", "7\r\n", "7\u2029",
]
LONG_DATES = [
    "December 30, 1984", "January 5, 1999", "Jan 5, 1999", "January 5, 1999 (x)",
    "january 05, 1999", "JANUARY 5, 1999", "January 32, 1999", " January 5, 1999", "--",
    "Feb 29, 2001", "Feb 29, 2000", None, "January 5, 99", "January 5, 0099",
    "January 5, 12345", "January 5, 1999x", "January 5,1999", "January  5, 1999",
    "Jan. 5, 1999", "JANUARY 5 , 1999", "January 05, 1999 ", "Sep 5, 1999",
    "September 5, 1999", "Janu 5, 1999", "January 0, 1999", "January 005, 1999",
    "January 5, 199", "January 1, 0", "January 1, 0000", "January 1, 00001",
]
ISO_DATES = [
    "2023-10-24", "2023-13-45", "2023-1-4", "2023-10-24T00:00:00", "20231024",
    "2023-02-30", "--", "2024-02-29", "2023-10-24 12:00", None, "23-10-24", "0023-10-24",
    "12023-10-24", "2023-010-24", "2023-10-024", "2023/10/24", "2023-10-24x", "2023-1-4 ",
    "2023-10-", "+2023-10-24", "2023-10-24.5", "0-01-01", "0000-01-01", "00001-01-01",
]


@contextlib.contextmanager
def legacy_mode(spark):
    keys = {"spark.sql.ansi.enabled": "false", "spark.sql.legacy.timeParserPolicy": "LEGACY"}
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def _same(a, b):
    if isinstance(a, float) and isinstance(b, float) and math.isnan(a) and math.isnan(b):
        return True
    return a == b


def _compare(spark, values, plain, recipe):
    df = one_col(spark, values)
    with legacy_mode(spark):
        expected = [r[0] for r in df.select(plain(F.col("v"))).collect()]
    got = [r[0] for r in df.select(recipe(F.col("v"))).collect()]
    bad = [(v, e, g) for v, e, g in zip(values, expected, got) if not _same(e, g)]
    assert not bad, bad


def test_int_cast_parity(spark):
    _compare(spark, NUMBERS, lambda c: c.cast("int"), int_trunc)


def test_float_cast_parity(spark):
    _compare(spark, NUMBERS, lambda c: c.cast("float"), to_float)


# Dates are compared as day numbers: years past 9999 occur and do not fit a
# Python date.
def test_long_date_parity(spark):
    plain = lambda c: F.unix_date(
        F.to_date(F.unix_timestamp(c, "MMMM dd, yyyy").cast("timestamp")))
    _compare(spark, LONG_DATES, plain, lambda c: F.unix_date(parse_long_date(c)))


def test_iso_date_parity(spark):
    _compare(spark, ISO_DATES, lambda c: F.unix_date(F.to_date(c, "yyyy-MM-dd")),
             lambda c: F.unix_date(parse_iso_date(c)))


def test_fill_parity(spark):
    values = ["2.5", None, "NaN", "--"]
    plain = lambda c: F.when(F.isnull(c.cast("float")), 0).otherwise(c.cast("float"))
    from statflow.functions import null_to_zero

    _compare(spark, values, plain, lambda c: null_to_zero(to_float(c)))


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_recipes_do_not_depend_on_session_mode(spark, ansi):
    df = one_col(spark, NUMBERS)
    base = [r[0] for r in df.select(int_trunc("v")).collect()]
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        assert [r[0] for r in df.select(int_trunc("v")).collect()] == base
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)
