"""Typed tables to a star schema: clients, four dimensions and four facts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from riskflow.functions.text import null_tokens
from riskflow.operators import rejects
from riskflow.operators.clean import in_range, keep_one, require
from riskflow.operators.dims import build_dim, lookup
from riskflow.operators.rejects import Judged, Known
from riskflow.schemas import ACTIVITY, CLIENTS, DATE_BOUNDS, LOGINS, PAYMENTS, TRANSACTIONS


def _blank_tokens(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: null_tokens(c) for c in columns})


def dds_clients(clients: DataFrame) -> DataFrame:
    kept = require(clients, ["client_id"])
    return _blank_tokens(kept, "client_email", "client_phone", "client_address")


def dim_activity_types(activity: DataFrame) -> DataFrame:
    return build_dim(activity, "activity_type", "activity_type_id", "activity_type_name")


def dim_currencies(payments: DataFrame) -> DataFrame:
    """Currencies of payments; a transaction in any other currency finds no match and is left out."""
    return build_dim(payments, "currency", "currency_id", "currency_name")


def dim_payment_methods(payments: DataFrame) -> DataFrame:
    return build_dim(payments, "payment_method", "payment_method_id", "payment_method_name")


def dim_transaction_types(transactions: DataFrame) -> DataFrame:
    return build_dim(transactions, "transaction_type", "transaction_type_id", "transaction_type_name")


def fact_activity(activity: DataFrame, types: DataFrame, bounds: tuple[str, str] = DATE_BOUNDS) -> DataFrame:
    kept = in_range(require(activity, ["client_id", "activity_date", "activity_type"]), "activity_date", bounds)
    known = lookup(kept, types, "activity_type", "activity_type_id", "activity_type_name")
    return keep_one(_blank_tokens(known, "activity_location", "device"), ["client_id", "activity_date"])


def fact_logins(logins: DataFrame, bounds: tuple[str, str] = DATE_BOUNDS) -> DataFrame:
    kept = in_range(require(logins, ["client_id", "login_date"]), "login_date", bounds)
    return keep_one(_blank_tokens(kept, "location", "device"), ["client_id", "login_date"])


def fact_payments(
    payments: DataFrame, currencies: DataFrame, methods: DataFrame, bounds: tuple[str, str] = DATE_BOUNDS
) -> DataFrame:
    kept = in_range(require(payments, ["payment_id"]), "payment_date", bounds)
    known = lookup(kept, currencies, "currency", "currency_id", "currency_name")
    known = lookup(known, methods, "payment_method", "payment_method_id", "payment_method_name")
    columns = ["payment_id", "client_id", "payment_date", "currency", "amount", "payment_method"]
    return keep_one(known.select(*columns), ["payment_id"])


def fact_transactions(
    transactions: DataFrame, currencies: DataFrame, types: DataFrame, bounds: tuple[str, str] = DATE_BOUNDS
) -> DataFrame:
    kept = in_range(require(transactions, ["transaction_id"]), "transaction_date", bounds)
    known = lookup(kept, currencies, "currency", "currency_id", "currency_name")
    known = lookup(known, types, "transaction_type", "transaction_type_id", "transaction_type_name")
    columns = [
        "transaction_id",
        "client_id",
        "transaction_date",
        "transaction_type",
        "account_number",
        "currency",
        "amount",
    ]
    return keep_one(_blank_tokens(known.select(*columns), "account_number"), ["transaction_id"])


# --- the same tables with the rows that they refuse ---------------------------------------------------------

Bounds = tuple[str, str]


def judged_clients(clients: DataFrame, unique: bool = False) -> Judged:
    """With ``unique``, the rows of a repeated client id after the first are rejected."""
    rules = rejects.not_null(["client_id"]) + rejects.max_length(CLIENTS.lengths)
    found = rejects.judge(clients, rules, key=["client_id"] if unique else [])
    return Judged(dds_clients(found.accepted), found.rejected)


def judged_activity(activity: DataFrame, types: DataFrame, bounds: Bounds = DATE_BOUNDS) -> Judged:
    rules = rejects.not_null(["client_id", "activity_date"])
    rules += rejects.in_range("activity_date", bounds, "timestamp") + rejects.max_length(ACTIVITY.lengths)
    order = ["activity_type", null_tokens("activity_location"), "ip_address", null_tokens("device")]
    known = [Known("activity_type", types, "activity_type_name")]
    found = rejects.judge(activity, rules, known, ["client_id", "activity_date"], order)
    rows = lookup(found.accepted, types, "activity_type", "activity_type_id", "activity_type_name")
    return Judged(_blank_tokens(rows, "activity_location", "device"), found.rejected)


def judged_logins(logins: DataFrame, bounds: Bounds = DATE_BOUNDS) -> Judged:
    rules = rejects.not_null(["client_id", "login_date"])
    rules += rejects.in_range("login_date", bounds, "timestamp") + rejects.max_length(LOGINS.lengths)
    order = ["ip_address", null_tokens("location"), null_tokens("device")]
    found = rejects.judge(logins, rules, key=["client_id", "login_date"], order=order)
    return Judged(_blank_tokens(found.accepted, "location", "device"), found.rejected)


def judged_payments(
    payments: DataFrame, currencies: DataFrame, methods: DataFrame, bounds: Bounds = DATE_BOUNDS
) -> Judged:
    rules = rejects.not_null(["payment_id"])
    rules += rejects.in_range("payment_date", bounds, "timestamp") + rejects.max_length(PAYMENTS.lengths)
    known = [Known("currency", currencies, "currency_name"), Known("payment_method", methods, "payment_method_name")]
    order = ["client_id", "payment_date", "currency", "amount", "payment_method"]
    found = rejects.judge(payments, rules, known, ["payment_id"], order)
    rows = lookup(found.accepted, currencies, "currency", "currency_id", "currency_name")
    rows = lookup(rows, methods, "payment_method", "payment_method_id", "payment_method_name")
    return Judged(rows.select("payment_id", *order), found.rejected)


def judged_transactions(
    transactions: DataFrame, currencies: DataFrame, types: DataFrame, bounds: Bounds = DATE_BOUNDS
) -> Judged:
    rules = rejects.not_null(["transaction_id"])
    rules += rejects.in_range("transaction_date", bounds, "timestamp") + rejects.max_length(TRANSACTIONS.lengths)
    known = [Known("currency", currencies, "currency_name"), Known("transaction_type", types, "transaction_type_name")]
    order = ["client_id", "transaction_date", "transaction_type", null_tokens("account_number"), "currency", "amount"]
    found = rejects.judge(transactions, rules, known, ["transaction_id"], order)
    rows = lookup(found.accepted, currencies, "currency", "currency_id", "currency_name")
    rows = lookup(rows, types, "transaction_type", "transaction_type_id", "transaction_type_name")
    rows = _blank_tokens(rows, "account_number")
    columns = ["client_id", "transaction_date", "transaction_type", "account_number", "currency", "amount"]
    return Judged(rows.select("transaction_id", *columns), found.rejected)


def rejected_names(typed: Mapping[str, DataFrame], dims: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The names that each dimension leaves out."""
    sources = {
        "activity_types": ("clients_activity", "activity_type", "activity_type_name"),
        "currencies": ("payments", "currency", "currency_name"),
        "payment_methods": ("payments", "payment_method", "payment_method_name"),
        "transaction_types": ("transactions", "transaction_type", "transaction_type_name"),
    }
    return {
        name: rejects.unusable_names(typed[source], column, dims[name].select(title), title)
        for name, (source, column, title) in sources.items()
    }
