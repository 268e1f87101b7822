"""Star schema to three wide marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.operators.joins import Splits, fan_out_join, unique_join

CLIENT_COLUMNS = [
    "client_id",
    "client_first_name",
    "client_last_name",
    "client_email",
    "client_phone",
    "client_address",
    "client_birthday",
]


def _named(fact: DataFrame, dim: DataFrame, column: str, key: str) -> DataFrame:
    """Rename the fact's surrogate key and add the dimension's name."""
    return fact.withColumnRenamed(column, key).join(dim, key)


def mart_activity_logins(
    activity: DataFrame, types: DataFrame, clients: DataFrame, logins: DataFrame, splits: Splits = Splits()
) -> DataFrame:
    """Every activity of a client with every login of the client; clients without logins drop out."""
    acts = _named(activity, types, "activity_type", "activity_type_id").select(
        "client_id",
        "activity_date",
        "activity_type_id",
        "activity_type_name",
        "activity_location",
        F.col("ip_address").alias("ip_address_activity"),
        F.col("device").alias("activity_device"),
    )
    visits = logins.select(
        "client_id",
        "login_date",
        F.col("ip_address").alias("ip_address_login"),
        F.col("location").alias("login_location"),
        F.col("device").alias("login_device"),
    )
    owners = clients.select(*CLIENT_COLUMNS)
    mart = fan_out_join(acts, visits, "client_id", ["activity_date"], ["login_date"], [owners], splits)
    return mart.select(*CLIENT_COLUMNS, *acts.columns[1:], *visits.columns[1:])


def mart_transactions(
    transactions: DataFrame, clients: DataFrame, currencies: DataFrame, types: DataFrame, splits: Splits = Splits()
) -> DataFrame:
    """Every transaction with its client, currency and type."""
    rows = _named(transactions, currencies, "currency", "currency_id")
    rows = _named(rows, types, "transaction_type", "transaction_type_id")
    rows = unique_join(rows, clients.select(*CLIENT_COLUMNS), "client_id", ["transaction_id"], splits)
    return rows.select(
        *CLIENT_COLUMNS,
        "account_number",
        "transaction_id",
        "transaction_date",
        "transaction_type_id",
        "transaction_type_name",
        "currency_id",
        "currency_name",
        F.col("amount").alias("total_amount"),
    )


def mart_payments(
    payments: DataFrame,
    clients: DataFrame,
    currencies: DataFrame,
    methods: DataFrame,
    transactions: DataFrame,
    splits: Splits = Splits(),
) -> DataFrame:
    """Every payment of a client with the account number of every transaction of the client."""
    rows = _named(payments, currencies, "currency", "currency_id")
    rows = _named(rows, methods, "payment_method", "payment_method_id")
    accounts = transactions.select("client_id", "transaction_id", "account_number")
    owners = clients.select(*CLIENT_COLUMNS)
    mart = fan_out_join(rows, accounts, "client_id", ["payment_id"], ["transaction_id"], [owners], splits)
    return mart.select(
        *CLIENT_COLUMNS,
        "payment_id",
        "account_number",
        "payment_date",
        "currency_id",
        "currency_name",
        F.col("amount").alias("total_amount"),
        "payment_method_id",
        "payment_method_name",
    )
