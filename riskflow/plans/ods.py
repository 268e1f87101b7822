"""Raw text to typed tables: null-on-error casts and whole-row deduplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.functions.casts import safe_date, safe_id, safe_inet, safe_numeric, safe_timestamp
from riskflow.operators.clean import distinct_rows, require_names


def _typed(raw: DataFrame, casts: dict[str, Column]) -> DataFrame:
    return distinct_rows(raw.select(*[casts.get(c, F.col(c)).alias(c) for c in raw.columns]))


def ods_clients(raw: DataFrame) -> DataFrame:
    named = require_names(raw, ["client_first_name", "client_last_name"])
    return _typed(named, {"client_id": safe_id("client_id"), "client_birthday": safe_date("client_birthday")})


def ods_activity(raw: DataFrame) -> DataFrame:
    casts = {
        "client_id": safe_id("client_id"),
        "activity_date": safe_timestamp("activity_date"),
        "ip_address": safe_inet("ip_address"),
    }
    return _typed(raw, casts)


def ods_logins(raw: DataFrame) -> DataFrame:
    casts = {
        "client_id": safe_id("client_id"),
        "login_date": safe_timestamp("login_date"),
        "ip_address": safe_inet("ip_address"),
    }
    return _typed(raw, casts)


def ods_payments(raw: DataFrame, strict: bool = True) -> DataFrame:
    casts = {
        "client_id": safe_id("client_id"),
        "payment_id": safe_id("payment_id"),
        "payment_date": safe_timestamp("payment_date"),
        "amount": safe_numeric("amount", strict),
    }
    return _typed(raw, casts)


def ods_transactions(raw: DataFrame, strict: bool = True) -> DataFrame:
    casts = {
        "client_id": safe_id("client_id"),
        "transaction_id": safe_id("transaction_id"),
        "transaction_date": safe_timestamp("transaction_date"),
        "amount": safe_numeric("amount", strict),
    }
    return _typed(raw, casts)
