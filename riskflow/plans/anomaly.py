"""Daily client profiles and the three detectors over them.

Each detector needs its profile more than once, for the statistics and to filter. The deviation detectors
share one shuffle between both uses (``ReusedExchange`` in the plan); overall statistics come back as a scalar
subquery, not as a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.functions.casts import MONEY_TYPE
from riskflow.operators.clean import require
from riskflow.operators.eager import aggregate_fan_out
from riskflow.operators.stats import (
    approx_quantiles,
    exact_quantiles,
    mean_and_deviation,
    sampled_quantiles,
    with_day_stats,
)
from riskflow.session import materialize

SUM_TYPE = "decimal(28,6)"
COUNT, TOTAL = "daily_transaction_count", "daily_total_amount"


def daily_profile(
    df: DataFrame,
    client: str = "client_id",
    at: str = "transaction_date",
    item: str = "transaction_id",
    amount: str = "total_amount",
) -> DataFrame:
    """Count and sum per client and day. Rows are combined before the shuffle, so hot clients are harmless."""
    return df.groupBy(F.col(client).alias("client_id"), F.to_date(at).alias("transaction_day")).agg(
        F.count(item).alias(COUNT), F.sum(F.col(amount).try_cast(MONEY_TYPE)).alias(TOTAL)
    )


def payment_mart_rows(payments: DataFrame, currencies: DataFrame, methods: DataFrame) -> DataFrame:
    """The payments that have a row in the payment mart as far as their dimensions decide."""
    known = payments.join(currencies, F.col("currency") == F.col("currency_id"), "left_semi")
    return known.join(methods, F.col("payment_method") == F.col("payment_method_id"), "left_semi")


def payment_mart_profile(
    payments: DataFrame, clients: DataFrame, currencies: DataFrame, methods: DataFrame, transactions: DataFrame
) -> DataFrame:
    """``daily_profile`` of the payment mart, from the star schema and without the mart's rows."""
    return aggregate_fan_out(
        payment_mart_rows(payments, currencies, methods),
        [clients, transactions],
        "client_id",
        {"transaction_day": F.to_date("payment_date")},
        {COUNT: F.col("payment_id")},
        {TOTAL: F.col("amount").try_cast(MONEY_TYPE)},
    )


def payment_mart_days(
    payments: DataFrame, clients: DataFrame, currencies: DataFrame, methods: DataFrame, transactions: DataFrame
) -> DataFrame:
    """``client_days`` of the payment mart, from the star schema and without the mart's rows."""
    rows = require(payment_mart_rows(payments, currencies, methods), ["client_id", "payment_date", "amount"])
    days = aggregate_fan_out(
        rows,
        [clients, transactions],
        "client_id",
        {"transaction_date": F.to_date("payment_date")},
        {"transaction_count": F.col("amount")},
        {"total_transaction_amount": F.col("amount").try_cast(SUM_TYPE)},
    )
    return days.withColumn("client_id", F.col("client_id").cast("string"))


def activity_mart_profile(activity: DataFrame, types: DataFrame, clients: DataFrame, logins: DataFrame) -> DataFrame:
    """Rows of the activity mart per client and day of the activity, without the mart's rows."""
    known = activity.join(types, F.col("activity_type") == F.col("activity_type_id"), "left_semi")
    return aggregate_fan_out(
        known, [clients, logins], "client_id", {"activity_day": F.to_date("activity_date")}, {"mart_rows": F.lit(1)}, {}
    )


def zscore_global(profile: DataFrame, k: float = 3.0) -> DataFrame:
    """Client days whose count or sum is more than ``k`` sample deviations above the overall mean."""
    measures = {"n": F.col(COUNT), "total": F.col(TOTAL)}
    stats = profile.agg(F.struct(*mean_and_deviation(measures)).alias("stats")).scalar()

    def above(name: str, c: Column) -> Column:
        return c.cast("double") > stats[f"avg_{name}"] + k * stats[f"stddev_{name}"]

    return profile.where(above("n", F.col(COUNT)) | above("total", F.col(TOTAL)))


def iqr_global(profile: DataFrame, k: float = 1.5, exact: bool = True, sample: int | None = None) -> DataFrame:
    """Client days whose count or sum lies more than ``k`` quartile ranges outside the quartiles.

    With ``sample`` the quartiles are those of so many client days, interpolated; otherwise they are exact, or values
    of a sketch. The profile is written once, because the quartiles need several passes over its two measures. The
    fences are then plain numbers that push down to that table.
    """
    profile = materialize(profile, "profile")
    if sample:
        quartiles = sampled_quantiles(profile, [COUNT, TOTAL], [0.25, 0.75], ["client_id", "transaction_day"], sample)
    else:
        find = exact_quantiles if exact else approx_quantiles
        quartiles = find(profile, [COUNT, TOTAL], [0.25, 0.75])

    def outside(name: str) -> Column:
        low, high = quartiles[name]
        if low is None:
            return F.lit(False)
        reach = k * (high - low)
        value = F.col(name).cast("double")
        return (value < low - reach) | (value > high + reach)

    return profile.where(outside(COUNT) | outside(TOTAL))


def relevant_columns(df: DataFrame, client: str, at: str, amount: str) -> DataFrame:
    """Client as text, day and amount; rows lacking any of them are dropped.

    A missing id is dropped before it becomes text: as text, NaN would form one huge pseudo client.
    """
    whole = F.col(client).try_cast("bigint")
    cut = require(df, [client, at, amount]).select(
        whole.alias("client_id"),
        F.to_date(at).alias("transaction_date"),
        F.col(amount).cast("double").alias("amount"),
    )
    kept = require(cut, ["client_id", "transaction_date", "amount"])
    return kept.withColumn("client_id", F.col("client_id").cast("string"))


def client_days(df: DataFrame) -> DataFrame:
    """Count and sum per client and day of the relevant columns; sums are exact decimals, whatever the row order."""
    return df.groupBy("client_id", "transaction_date").agg(
        F.count("amount").alias("transaction_count"), F.sum(F.col("amount").try_cast(SUM_TYPE)).alias("total_transaction_amount")
    )


def zscore_by_day(
    df: DataFrame,
    client: str = "client_id",
    at: str = "transaction_date",
    amount: str = "amount",
    k: float = 2.0,
) -> DataFrame:
    """Client days above ``k`` sample deviations of the clients of that day, with the day's statistics."""
    return zscore_of_days(client_days(relevant_columns(df, client, at, amount)), k)


def zscore_of_days(days: DataFrame, k: float = 2.0) -> DataFrame:
    """As ``zscore_by_day``, from counts and sums per client and day."""
    measures = {"transaction_count": F.col("transaction_count"), "total_amount": F.col("total_transaction_amount")}
    scored = with_day_stats(days, "transaction_date", measures)

    def flag(value: str, name: str) -> Column:
        above = F.col(value) > F.col(f"avg_{name}") + k * F.col(f"stddev_{name}")
        return F.coalesce(above, F.lit(False))

    flagged = scored.withColumns(
        {
            "is_count_anomaly": flag("transaction_count", "transaction_count"),
            "is_amount_anomaly": flag("total_transaction_amount", "total_amount"),
        }
    )
    return flagged.where("is_count_anomaly or is_amount_anomaly")
