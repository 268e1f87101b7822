"""Marts as sorted, read-optimised copies."""

from __future__ import annotations

from pyspark.sql import DataFrame

from riskflow.functions.ip import ip_to_long
from riskflow.sources.writers import sort_ranges, write_refresh, write_sorted

# The sort key of each published mart.
SORT_KEYS = {"activity_logins": "client_id", "transactions": "transaction_date", "payments": "payment_date"}


def with_ip_numbers(mart: DataFrame) -> DataFrame:
    """Both addresses as 32-bit numbers; an address that is not valid becomes null."""
    columns = ("ip_address_activity", "ip_address_login")
    return mart.withColumns({c: ip_to_long(c) for c in columns})


def publish_activity(mart: DataFrame, path: str) -> DataFrame:
    ranges = sort_ranges(mart, SORT_KEYS["activity_logins"], spread=["activity_date", "login_date"])
    return write_refresh(with_ip_numbers(ranges), path)


def publish_transactions(mart: DataFrame, path: str) -> DataFrame:
    return write_sorted(mart, path, SORT_KEYS["transactions"], spread=["transaction_id"])


def publish_payments(mart: DataFrame, path: str) -> DataFrame:
    return write_sorted(mart, path, SORT_KEYS["payments"], spread=["payment_id", "account_number"])
