"""Accept and reject tables of the null-on-error casts."""

from __future__ import annotations

import datetime as dt
import ipaddress
import re
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskflow.functions import casts, ip, text


def results(spark, function, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r[0] for r in df.select("i", function("s").alias("x")).orderBy("i").select("x").collect()]


FLOATS = [
    ("12.0", 12.0), ("-3", -3.0), ("0", 0.0), ("+3", None), ("1E7", None), (" 5", None), ("5.", None), (".5", None),
    ("NaN", None), ("\\NaN\\", None), ("", None), (None, None), ("7\n", None), ("9" * 400, None),
]
IDS = [("12.0", 12), ("2.5", 2), ("3.5", 4), ("-0.5", 0), ("1e3", None), ("9" * 30, None), (None, None)]
MONEY = [
    ("12.5", Decimal("12.50")), (" 12.50 ", Decimal("12.50")), ("\t7\n", Decimal("7.00")), ("-7", Decimal("-7.00")),
    ("12.345", None), ("1.0E7", None), ("NaN", None), ("99999999999999.99", None), (None, None),
]
ROUNDED = [
    ("12.345", Decimal("12.35")), ("1.0E7", Decimal("10000000.00")), ("4567.800000000001", Decimal("4567.80")),
    ("NaN", None), ("", None), ("99999999999999.99", None),
]
UTC = dt.timezone.utc
TIMES = [
    ("2025-01-02T03:04:05", dt.datetime(2025, 1, 2, 3, 4, 5, tzinfo=UTC)),
    ("2025-01-02T03:04:05.123Z", dt.datetime(2025, 1, 2, 3, 4, 5, 123000, tzinfo=UTC)),
    ("2025-01-02T03:04:05+03:00", dt.datetime(2025, 1, 2, 0, 4, 5, tzinfo=UTC)),
    ("2025-01-02T03:04:05.5-01:30", dt.datetime(2025, 1, 2, 4, 34, 5, 500000, tzinfo=UTC)),
    ("1700-05-06T00:00:00.000Z", dt.datetime(1700, 5, 6, tzinfo=UTC)),
    ("2025-01-02 03:04:05", None), ("2025-01-02", None), ("2025-13-02T00:00:00", None), ("NaT", None), (None, None),
]
DATES = [
    ("1990-05-06T00:00:00.000Z", dt.date(1990, 5, 6)), ("1990-05-06T23:30:00+03:00", dt.date(1990, 5, 6)),
    ("1990-05-06", None), ("1990-02-30T00:00:00", None), ("1990-05-06T25:00:00", None), (None, None),
]
ADDRESSES = [
    ("1.2.3.4", 16909060), ("0.0.0.0", 0), ("255.255.255.255", 2**32 - 1), ("010.001.1.1", 10 * 2**24 + 2**16 + 257),
    ("256.1.1.1", None), ("1.2.3", None), ("1.2.3.4/24", None), ("::1", None), ("999.999.999.999", None),
    ("1.2.3.4\n", None), (None, None),
]


@pytest.mark.parametrize(
    "function,table",
    [
        (casts.safe_float, FLOATS),
        (casts.safe_id, IDS),
        (casts.safe_numeric, MONEY),
        (lambda c: casts.safe_numeric(c, strict=False), ROUNDED),
        (casts.safe_date, DATES),
        (ip.ip_to_long, ADDRESSES),
    ],
)
def test_accept_and_reject(spark, function, table):
    assert results(spark, function, [v for v, _ in table]) == [r for _, r in table]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_timestamps_do_not_depend_on_the_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        seconds = results(spark, lambda c: F.unix_micros(casts.safe_timestamp(c)), [v for v, _ in TIMES])
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    epoch = dt.datetime(1970, 1, 1, tzinfo=UTC)
    assert seconds == [None if r is None else (r - epoch) // dt.timedelta(microseconds=1) for _, r in TIMES]


def test_timestamp_zone_is_a_parameter(spark):
    local = results(spark, lambda c: F.unix_seconds(casts.safe_timestamp(c, "+03:00")), ["2025-01-02T03:00:00"])
    assert local == [int(dt.datetime(2025, 1, 2, tzinfo=UTC).timestamp())]


def test_canonical_address(spark):
    assert results(spark, casts.safe_inet, ["010.001.1.1", "1.2.3.4", "1.2.3.256"]) == ["10.1.1.1", "1.2.3.4", None]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("0123456789.:-/ a", max_size=16), min_size=50, max_size=200))
def test_addresses_against_the_standard_library(spark, values):
    values = values + ["1.2.3.4", "300.2.3.4"]

    def expected(value):
        if not re.fullmatch(r"(\d{1,3}\.){3}\d{1,3}", value, re.ASCII):
            return None
        plain = ".".join(str(int(o)) for o in value.split("."))
        try:
            return int(ipaddress.IPv4Address(plain))
        except ipaddress.AddressValueError:
            return None

    assert results(spark, ip.ip_to_long, values) == [expected(v) for v in values]


def test_null_tokens(spark):
    given_, kept = ["NaN", '"NaN"', "\\NaN\\", "NaT", "", None, "nan", "x"], [None] * 6 + ["nan", "x"]
    assert results(spark, text.null_tokens, given_) == kept


def test_name_predicates_drop_nulls(spark):
    values = ["Ann", "NaN", "\\NaN\\", "BaNaNa", None]
    assert results(spark, lambda c: text.lacks(c, "NaN"), values) == [True, False, False, False, None]
    assert results(spark, lambda c: text.not_named(c, ("\\nan\\", "currency")), ["USD", "Currency", "\\NaN\\", None]) == [
        True, False, False, None,
    ]
