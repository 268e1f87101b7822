"""Registered queries: one per operator, each over whole given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.standins import ORDER_BOUNDS, raw, raw_tables, source_stream, table
from riskflow.functions import casts, ip, text, wire
from riskflow.operators import cascade, clean, dims, faults, joins, quality, rejects, stats
from riskflow.plans import anomaly, dds, dm, ods, publish, refresh
from riskflow.schemas import ACTIVITY, CLIENTS, ENTITIES, LOGINS, PAYMENTS, TRANSACTIONS
from riskflow.session import materialize, together, work_path
from riskflow.sources import readers, versions, writers
from riskflow.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
_registry: dict[str, Query] = {}


def _query(fn: Query) -> Query:
    _registry[fn.__name__] = fn
    return fn


def _add(name: str, fn: Query) -> None:
    _registry[name] = fn


def plain(df: DataFrame) -> DataFrame:
    """Types that both engines print alike: decimals as double, instants as UTC wall time."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        out.append(c.alias(f.name))
    return df.select(*out)


def rounded(df: DataFrame, places: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), places) for c in columns})


# --- detectors ----------------------------------------------------------------------------------------------


def events_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anomaly.daily_profile(table(spark, sf_dir, "events"), "user_id", "ts", "event_id", "value")


def orders_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anomaly.daily_profile(table(spark, sf_dir, "orders"), "o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")


def lineitem_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    return anomaly.daily_profile(items, "l_suppkey", "l_shipdate", "l_orderkey", "l_extendedprice")


_add("ano_zscore_global", lambda s, d: plain(anomaly.zscore_global(events_profile(s, d))))
_add("ano_zscore_global_orders", lambda s, d: plain(anomaly.zscore_global(orders_profile(s, d))))
_add("ano_zscore_global_lineitem", lambda s, d: plain(anomaly.zscore_global(lineitem_profile(s, d))))
_add("ano_iqr_global", lambda s, d: plain(anomaly.iqr_global(events_profile(s, d))))
_add("ano_iqr_global_orders", lambda s, d: plain(anomaly.iqr_global(orders_profile(s, d))))
_add("ano_iqr_global_lineitem", lambda s, d: plain(anomaly.iqr_global(lineitem_profile(s, d))))
_add("ano_iqr_global_sketch", lambda s, d: plain(anomaly.iqr_global(events_profile(s, d), exact=False)))
_add("ano_iqr_sampled", lambda s, d: plain(anomaly.iqr_global(orders_profile(s, d), sample=512)))
_add("ano_iqr_sampled_whole", lambda s, d: plain(anomaly.iqr_global(events_profile(s, d), sample=1 << 20)))
_add("daily_profile", lambda s, d: plain(orders_profile(s, d)))

_DAY_STATS = ("avg_transaction_count", "stddev_transaction_count", "avg_total_amount", "stddev_total_amount")


@_query
def ano_zscore_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = anomaly.zscore_by_day(table(spark, sf_dir, "events"), "user_id", "ts", "value")
    return rounded(found, 6, "total_transaction_amount", *_DAY_STATS)


@_query
def day_window_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = anomaly.relevant_columns(table(spark, sf_dir, "events"), "user_id", "ts", "value")
    measures = {"transaction_count": F.col("transaction_count"), "total_amount": F.col("total_transaction_amount")}
    scored = stats.with_day_stats(anomaly.client_days(cut), "transaction_date", measures)
    return rounded(scored, 6, "total_transaction_amount", *_DAY_STATS)


@_query
def quantiles_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staged exact quantiles, joined to every row they describe."""
    profile = events_profile(spark, sf_dir).select(anomaly.COUNT, anomaly.TOTAL)
    found = stats.exact_quantiles(profile, profile.columns, [0.25, 0.75], accuracy=20, task_rows=50)
    marks = {f"q{i}_{c}": F.lit(v) for c, values in found.items() for i, v in zip((1, 3), values)}
    return rounded(plain(profile).withColumns(marks), 6, *marks)


# --- casts and cleaning -------------------------------------------------------------------------------------


def _cast(entity: str, column: str, function: Callable[[str], Column]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = raw(spark, sf_dir, entity)
        return plain(rows.select(F.col(column).alias("given"), function(column).alias("result")))

    return run


_add("safe_float", _cast("clients_activity", "client_id", casts.safe_float))
_add("safe_id", _cast("transactions", "transaction_id", casts.safe_id))
_add("safe_numeric", _cast("payments", "amount", casts.safe_numeric))
_add("safe_numeric_rounding", _cast("payments", "amount", lambda c: casts.safe_numeric(c, strict=False)))
_add("safe_timestamp", _cast("clients_activity", "activity_date", casts.safe_timestamp))
_add("safe_date", _cast("clients", "client_birthday", casts.safe_date))
_add("safe_inet", _cast("logins", "ip_address", casts.safe_inet))
_add("ip_valid", _cast("clients_activity", "ip_address", ip.is_valid_ip))
_add("ip_to_number", _cast("clients_activity", "ip_address", ip.ip_to_long))
_add("null_token_cleanup", _cast("clients_activity", "device", text.null_tokens))


@_query
def float_id_to_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    half = F.col("l_quantity") / 2
    items = table(spark, sf_dir, "lineitem")
    return items.select("l_orderkey", "l_linenumber", casts.round_to_long(half).alias("whole"))


@_query
def drop_missing_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = raw(spark, sf_dir, "clients_activity").withColumn("client_id", F.col("client_id").try_cast("double"))
    return clean.drop_missing_key(rows, "client_id")


@_query
def required_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = ods.ods_payments(raw(spark, sf_dir, "payments"))
    return plain(clean.require(typed, ["client_id", "payment_date", "amount"]))


@_query
def name_not_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.require_names(raw(spark, sf_dir, "clients"), ["client_first_name", "client_last_name"])


@_query
def exclude_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.exclude_names(raw(spark, sf_dir, "payments"), "currency", ("\\nan\\", "currency"))


@_query
def date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = raw(spark, sf_dir, "clients_activity").withColumn("activity_date", casts.safe_timestamp("activity_date"))
    return plain(clean.in_range(rows, "activity_date", dds.DATE_BOUNDS))


@_query
def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    copied = faults.repeat_rows(events, "event_id", pick=_every(7))
    return clean.distinct_rows(copied)


@_query
def union_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    return clean.union_rows(customers, customers)


def _distinct_on(name: str, keys: list[str], order: list[str]) -> Query:
    return lambda s, d: clean.keep_one(table(s, d, name), keys, order)


_add(
    "distinct_on_activity",
    lambda s, d: clean.keep_one(table(s, d, "events"), ["user_id", F.to_date("ts")], ["ts", "event_id"]),
)
_add("distinct_on_login", _distinct_on("events", ["user_id", "event_type"], ["ts", "event_id"]))
_add("distinct_on_payment", _distinct_on("lineitem", ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"]))
_add("distinct_on_transaction", _distinct_on("orders", ["o_custkey", "o_orderstatus"], ["o_orderdate", "o_orderkey"]))


@_query
def preview_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.preview(table(spark, sf_dir, "orders"), ["o_orderkey"], 20)


# --- wire format --------------------------------------------------------------------------------------------


@_query
def json_parse_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    bodies = table(spark, sf_dir, "events").select(F.col("props").alias("raw_data"))
    return wire.decode_messages(bodies, T.StructType([T.StructField("k", T.LongType())]))


@_query
def schema_driven_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = raw(spark, sf_dir, "payments")
    return plain(rows.select(*wire.typed_columns(rows.schema, PAYMENTS.typed_schema)))


@_query
def json_encode_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    return wire.encode_messages(events.select("event_id", "ts", "day", "user_id", "event_type", "value"))


# --- layers -------------------------------------------------------------------------------------------------

_ODS = {
    "ods_clients": ("clients", ods.ods_clients),
    "ods_activity": ("clients_activity", ods.ods_activity),
    "ods_logins": ("logins", ods.ods_logins),
    "ods_payments": ("payments", ods.ods_payments),
    "ods_transactions": ("transactions", ods.ods_transactions),
}


def _typed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    entity, build = _ODS[name]
    return build(raw(spark, sf_dir, entity))


for _name in _ODS:
    _add(_name, lambda s, d, n=_name: plain(_typed(s, d, n)))


# As in a refresh, each layer is stored before the next one reads it.


def _stored(s: SparkSession, d: str, name: str) -> DataFrame:
    return materialize(_typed(s, d, name), name)


def _activity_star(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Activity types, activity."""
    typed = _stored(s, d, "ods_activity")
    types = dds.dim_activity_types(typed)
    return types, dds.fact_activity(typed, types)


def _payment_star(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Currencies, payment methods, payments."""
    typed = _stored(s, d, "ods_payments")
    currencies, methods = dds.dim_currencies(typed), dds.dim_payment_methods(typed)
    return currencies, methods, dds.fact_payments(typed, currencies, methods)


def _transaction_star(s: SparkSession, d: str, currencies: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Transaction types, transactions."""
    typed = _stored(s, d, "ods_transactions")
    kinds = dds.dim_transaction_types(typed)
    return kinds, dds.fact_transactions(typed, currencies, kinds, ORDER_BOUNDS)


def _clients(s: SparkSession, d: str) -> DataFrame:
    return dds.dds_clients(_stored(s, d, "ods_clients"))


def _logins(s: SparkSession, d: str) -> DataFrame:
    return dds.fact_logins(_stored(s, d, "ods_logins"), ORDER_BOUNDS)


def _currencies(s: SparkSession, d: str) -> DataFrame:
    return dds.dim_currencies(_typed(s, d, "ods_payments"))


_add("dds_clients", lambda s, d: plain(_clients(s, d)))
_add("dim_activity_type", lambda s, d: dds.dim_activity_types(_typed(s, d, "ods_activity")))
_add("dim_currency", _currencies)
_add("dim_payment_method", lambda s, d: dds.dim_payment_methods(_typed(s, d, "ods_payments")))
_add("dim_transaction_type", lambda s, d: dds.dim_transaction_types(_typed(s, d, "ods_transactions")))
_add("fact_activity", lambda s, d: plain(_activity_star(s, d)[-1]))
_add("fact_login", lambda s, d: plain(_logins(s, d)))
_add("fact_payment", lambda s, d: plain(_payment_star(s, d)[-1]))
_add("fact_transaction", lambda s, d: plain(_transaction_star(s, d, _currencies(s, d))[-1]))


@_query
def dim_numbered_in_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense keys for a name column with as many names as rows, numbered in sorted ranges."""
    return dims.build_dim(table(spark, sf_dir, "customer"), "c_name", "name_id", "name")


# hot keys are cut at a size that the test tables reach
_CUT = joins.Splits(rows_per_task=40, output_per_task=400)


def _fact(name: str, build: Callable[[], tuple[DataFrame, ...]]) -> tuple[DataFrame, ...]:
    *dimensions, fact = build()
    return (*dimensions, materialize(fact, name))


def _mart_activity(s: SparkSession, d: str, splits: joins.Splits = joins.Splits()) -> DataFrame:
    parts = together(
        {
            "activity": lambda: _fact("activity", lambda: _activity_star(s, d)),
            "clients": lambda: materialize(_clients(s, d), "clients"),
            "logins": lambda: materialize(_logins(s, d), "logins"),
        }
    )
    types, activity = parts["activity"]
    return dm.mart_activity_logins(activity, types, parts["clients"], parts["logins"], splits)


def _mart_transactions(s: SparkSession, d: str, splits: joins.Splits = joins.Splits()) -> DataFrame:
    currencies = _currencies(s, d)
    parts = together(
        {
            "transactions": lambda: _fact("transactions", lambda: _transaction_star(s, d, currencies)),
            "clients": lambda: materialize(_clients(s, d), "clients"),
        }
    )
    kinds, transactions = parts["transactions"]
    return dm.mart_transactions(transactions, parts["clients"], currencies, kinds, splits)


def _mart_payments(s: SparkSession, d: str, splits: joins.Splits = joins.Splits()) -> DataFrame:
    currencies = _currencies(s, d)
    parts = together(
        {
            "payments": lambda: _fact("payments", lambda: _payment_star(s, d)),
            "transactions": lambda: _fact("transactions", lambda: _transaction_star(s, d, currencies)),
            "clients": lambda: materialize(_clients(s, d), "clients"),
        }
    )
    _, methods, payments = parts["payments"]
    transactions = parts["transactions"][-1]
    return dm.mart_payments(payments, parts["clients"], currencies, methods, transactions, splits)


_add("mart_activity_logins", lambda s, d: plain(_mart_activity(s, d)))
_add("mart_transactions", lambda s, d: plain(_mart_transactions(s, d)))
_add("mart_payments", lambda s, d: plain(_mart_payments(s, d)))
_add("mart_activity_logins_cut", lambda s, d: plain(_mart_activity(s, d, _CUT)))
_add("mart_transactions_cut", lambda s, d: plain(_mart_transactions(s, d, _CUT)))
_add("mart_payments_cut", lambda s, d: plain(_mart_payments(s, d, _CUT)))

_PUBLISHED = {
    "publish_activity": (_mart_activity, publish.publish_activity),
    "publish_transactions": (_mart_transactions, publish.publish_transactions),
    "publish_payments": (_mart_payments, publish.publish_payments),
}


def _published(s: SparkSession, d: str, name: str) -> DataFrame:
    build, store = _PUBLISHED[name]
    return plain(store(materialize(build(s, d), "mart"), work_path(s, name)))


for _name in _PUBLISHED:
    _add(_name, lambda s, d, n=_name: _published(s, d, n))


def _refreshed(s: SparkSession, d: str) -> DataFrame:
    """All layers stored one after the other; the published transaction mart."""
    bounds = {"logins": ORDER_BOUNDS, "transactions": ORDER_BOUNDS}
    return refresh.refresh_all(raw_tables(s, d), work_path(s, "refresh"), bounds=bounds)["published"]["transactions"]


_add("refresh_zscore_global", lambda s, d: plain(anomaly.zscore_global(anomaly.daily_profile(_refreshed(s, d)))))
_add("refresh_iqr_global", lambda s, d: plain(anomaly.iqr_global(anomaly.daily_profile(_refreshed(s, d)))))


@_query
def mart_zscore_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = anomaly.zscore_by_day(_mart_payments(spark, sf_dir), "client_id", "payment_date", "total_amount")
    return rounded(found, 4, "total_transaction_amount", *_DAY_STATS)


def _payment_parts(s: SparkSession, d: str) -> tuple[DataFrame, ...]:
    """Payments, clients, currencies, payment methods and transactions, stored."""
    currencies = materialize(_currencies(s, d), "currencies")
    _, methods, payments = _fact("payments", lambda: _payment_star(s, d))
    transactions = materialize(_transaction_star(s, d, currencies)[-1], "transactions")
    return payments, materialize(_clients(s, d), "clients"), currencies, methods, transactions


@_query
def mart_zscore_by_day_eager(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``mart_zscore_by_day`` without the rows of the mart."""
    found = anomaly.zscore_of_days(anomaly.payment_mart_days(*_payment_parts(spark, sf_dir)))
    return rounded(found, 4, "total_transaction_amount", *_DAY_STATS)


_add("mart_profile_eager", lambda s, d: plain(anomaly.payment_mart_profile(*_payment_parts(s, d))))


@_query
def mart_activity_profile_eager(spark: SparkSession, sf_dir: str) -> DataFrame:
    types, activity = _fact("activity", lambda: _activity_star(spark, sf_dir))
    clients, logins = (materialize(f(spark, sf_dir), "side") for f in (_clients, _logins))
    return anomaly.activity_mart_profile(activity, types, clients, logins)


# --- storage ------------------------------------------------------------------------------------------------


def _csv(spark: SparkSession, sf_dir: str, entity: str) -> str:
    path = work_path(spark, f"csv_{entity}")
    writers.write_csv(raw(spark, sf_dir, entity), path)
    return path


for _name, _entity in ENTITIES.items():
    _add(
        f"raw_{_name}",
        lambda s, d, n=_name, e=_entity: readers.read_text_csv(s, _csv(s, d, n) + "/*.csv", e),
    )


@_query
def csv_typed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    types = {"client_id": T.DoubleType()}
    rows = readers.read_typed_csv(spark, _csv(spark, sf_dir, "clients"), CLIENTS, types)
    # NaN is a number to Spark and none to the typed scan of the clients
    return rows.withColumn("client_id", F.nanvl("client_id", F.lit(None).cast("double")))


@_query
def json_message_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "messages")
    orders = table(spark, sf_dir, "orders")
    writers.write_messages(orders, path)
    return readers.read_json(spark, path, orders.schema)


@_query
def json_inferred_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "messages")
    customers = table(spark, sf_dir, "customer")
    writers.write_messages(customers, path)
    return readers.read_json_inferred(spark, path, customers.schema)


@_query
def json_fallback_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies that are no objects leave nothing to infer, so every row has the fallback columns, all null."""
    path = work_path(spark, "bodies")
    table(spark, sf_dir, "customer").select("c_name").write.text(path)
    schema = T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType())])
    return readers.read_json_inferred(spark, path, schema)


@_query
def refresh_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table loaded three times, at last from itself, holds the rows of one load; the newest two versions stay."""
    path = work_path(spark, "orders")
    orders = table(spark, sf_dir, "orders")
    writers.write_refresh(orders, path)
    writers.write_refresh(table(spark, sf_dir, "orders"), path, orders.schema)
    writers.write_refresh(readers.read_table(spark, path), path)
    there = versions.versions(spark, path)
    return readers.read_table(spark, path).withColumns({"versions": F.lit(len(there)), "newest": F.lit(there[-1].number)})


@_query
def layout_distributed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return writers.write_distributed(table(spark, sf_dir, "orders"), work_path(spark, "orders"), ["o_custkey"])


@_query
def layout_distributed_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers, and how many of them have their orders in more than one file of the distributed table."""
    stored = layout_distributed(spark, sf_dir).select("o_custkey", F.input_file_name().alias("file"))
    files = stored.distinct().groupBy("o_custkey").agg(F.count("*").alias("n"))
    return files.agg(F.count("*").alias("customers"), F.count_if(F.col("n") > 1).alias("in_several_files"))


@_query
def layout_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per customer from two tables bucketed alike, joined without a shuffle."""
    stamp = uuid.uuid4().hex
    names = {n: f"{n}_{stamp}" for n in ("orders", "customer")}
    keys = {"orders": "o_custkey", "customer": "c_custkey"}
    stored = {n: writers.write_bucketed(table(spark, sf_dir, n), names[n], work_path(spark, n), keys[n], 8) for n in names}
    joined = stored["orders"].hint("merge").join(stored["customer"], F.col("o_custkey") == F.col("c_custkey"))
    found = joined.select("o_orderkey", "c_name", "o_totalprice")
    for name in names.values():  # the plan knows the files, which stay in the work folder
        spark.sql(f"DROP TABLE {name}")
    return found


@_query
def layout_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return writers.write_sorted(table(spark, sf_dir, "lineitem"), work_path(spark, "lineitem"), "l_suppkey")


@_query
def layout_sorted_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the sorted table, and how many of its files start below the end of the file before them."""
    stored = layout_sorted(spark, sf_dir).select("l_suppkey", F.input_file_name().alias("file"))
    files = stored.groupBy("file").agg(F.min("l_suppkey").alias("lo"), F.max("l_suppkey").alias("hi"), F.count("*").alias("n"))
    # one row per file
    before = F.lag("hi").over(Window.orderBy("lo", "hi"))
    return files.withColumn("before", before).agg(
        F.sum("n").alias("stored_rows"), F.count_if(F.col("lo") < F.col("before")).alias("overlaps")
    )


@_query
def anomalies_to_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagged client days written as CSV with a header, and read back."""
    found, path = ano_zscore_by_day(spark, sf_dir), work_path(spark, "anomalies")
    writers.write_csv(found, path)
    return spark.read.schema(found.schema).option("header", True).csv(path)


@_query
def stored_table_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A detector straight over a stored table read by its path."""
    orders = readers.read_table(spark, f"{sf_dir}/orders.parquet")
    days = anomaly.zscore_by_day(orders, "o_custkey", "o_orderdate", "o_totalprice", k=3.0)
    return rounded(days, 4, "total_transaction_amount", *_DAY_STATS)


# --- streaming ----------------------------------------------------------------------------------------------


def _messages(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """A stream of JSON messages as a producer sends them: ids and amounts as floats, NaN where missing."""
    rows = source_stream(spark, sf_dir, entity)
    casted = {n: F.col(n).try_cast(t) for n, t in ENTITIES[entity].wire.items() if isinstance(t, T.DoubleType)}
    return wire.encode_messages(rows.withColumns(casted))


def _ingested(entity: str, drop_keyless: bool = True) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        messages = _messages(spark, sf_dir, entity)
        return ingest.ingest(spark, messages, ENTITIES[entity], work_path(spark, "ingest"), drop_keyless)

    return run


for _e in (CLIENTS, ACTIVITY, LOGINS, PAYMENTS, TRANSACTIONS):
    _add(f"stream_ingest_{_e.name}", lambda s, d, n=_e.name: plain(_ingested(n)(s, d)))


@_query
def stream_ingest_for_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages to flagged client days: rows without an id are kept by the ingest and left out by the detector."""
    rows = _ingested("payments", drop_keyless=False)(spark, sf_dir)
    found = anomaly.zscore_by_day(rows, "client_id", "payment_date", "amount")
    return rounded(found, 4, "total_transaction_amount", *_DAY_STATS)


@_query
def stream_to_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = ingest.ingest_to_csv(spark, _messages(spark, sf_dir, "logins"), LOGINS, work_path(spark, "ingest"))
    return readers.read_text_csv(spark, path, LOGINS)


@_query
def stream_to_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole way of one entity: messages, landed JSON, CSV, text, typed."""
    messages = _messages(spark, sf_dir, "transactions")
    path = ingest.ingest_to_csv(spark, messages, TRANSACTIONS, work_path(spark, "ingest"))
    return plain(ods.ods_transactions(readers.read_text_csv(spark, path, TRANSACTIONS)))


def _payments_from_bare_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed payments whose messages hold a bare NaN for missing texts too, as a producer's JSON library writes them."""
    sent = _messages(spark, sf_dir, "payments")
    body = sent.columns[0]
    bare = F.replace(F.col(body), F.lit('"\\\\NaN\\\\"'), F.lit("NaN"))
    path = ingest.ingest_to_csv(spark, sent.select(bare.alias(body)), PAYMENTS, work_path(spark, "ingest"))
    return materialize(ods.ods_payments(readers.read_text_csv(spark, path, PAYMENTS)), "payments")


@_query
def messages_dim_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No missing-value text becomes a currency."""
    return dds.dim_currencies(_payments_from_bare_messages(spark, sf_dir))


@_query
def messages_fact_payment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments whose currency or method is missing in the message are left out."""
    typed = _payments_from_bare_messages(spark, sf_dir)
    return plain(dds.fact_payments(typed, dds.dim_currencies(typed), dds.dim_payment_methods(typed)))


@_query
def messages_to_zscore_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole way of all entities: message streams, text, typed, star, marts, flagged client days."""
    root = work_path(spark, "all")
    raw_text = ingest.raw_from_messages(spark, {e: _messages(spark, sf_dir, e) for e in ENTITIES}, root)
    bounds = {"logins": ORDER_BOUNDS, "transactions": ORDER_BOUNDS}
    marts = refresh.refresh_all(raw_text, root, bounds=bounds)["published"]
    return plain(anomaly.zscore_global(anomaly.daily_profile(marts["transactions"])))


# --- checks -------------------------------------------------------------------------------------------------


@_query
def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.not_null(_typed(spark, sf_dir, "ods_payments"), ["client_id", "payment_id", "payment_date", "amount"])


@_query
def dq_primary_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = _typed(spark, sf_dir, "ods_transactions")
    return quality.all_checks(
        quality.primary_key(typed, ["transaction_id"]),
        quality.primary_key(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]),
        quality.primary_key(table(spark, sf_dir, "orders"), ["o_orderkey"]),
    )


@_query
def dq_foreign_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    clients = _clients(spark, sf_dir)
    return quality.all_checks(
        quality.foreign_key(table(spark, sf_dir, "orders"), "o_custkey", clients, "client_id"),
        quality.foreign_key(table(spark, sf_dir, "events"), "user_id", clients, "client_id"),
        quality.foreign_key(table(spark, sf_dir, "customer"), "c_nationkey", table(spark, sf_dir, "nation"), "n_nationkey"),
    )


@_query
def dq_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.all_checks(
        quality.max_length(raw(spark, sf_dir, "clients"), CLIENTS.lengths),
        quality.max_length(raw(spark, sf_dir, "payments"), {"currency": 3}),
    )


@_query
def refresh_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys and references of every table of a refreshed star schema."""
    root = work_path(spark, "checked")
    typed = refresh.refresh_ods(raw_tables(spark, sf_dir), root)
    bounds = {"logins": ORDER_BOUNDS, "transactions": ORDER_BOUNDS}
    return refresh.star_checks(refresh.refresh_dds(typed, root, bounds))


def _judged(spark: SparkSession, sf_dir: str) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    root = work_path(spark, "judged")
    bounds = {"logins": ORDER_BOUNDS, "transactions": ORDER_BOUNDS}
    return refresh.refresh_dds_with_rejects(refresh.refresh_ods(raw_tables(spark, sf_dir), root), root, bounds)


@_query
def refresh_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows of each table were accepted, and how many broke which rule."""
    star, refused = _judged(spark, sf_dir)
    counts = rejects.reject_counts(refused)
    for name, df in star.items():
        kept = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), F.lit("").alias(rejects.RULE), "rows")
        counts = counts.unionAll(kept)
    return counts


_add("rejects_payments", lambda s, d: plain(_judged(s, d)[1]["payments"]))
_add("rejects_transactions", lambda s, d: plain(_judged(s, d)[1]["transactions"]))
_add("rejects_accepted_transactions", lambda s, d: plain(_judged(s, d)[0]["transactions"]))


def _cascaded(spark: SparkSession, sf_dir: str) -> cascade.Cascade:
    """A refreshed star schema without every seventh client and the roubles."""
    root = work_path(spark, "cascade")
    bounds = {"logins": ORDER_BOUNDS, "transactions": ORDER_BOUNDS}
    star = refresh.refresh_dds(refresh.refresh_ods(raw_tables(spark, sf_dir), root), root, bounds)
    doomed = {
        "clients": star["clients"].where("client_id % 7 = 2").select("client_id"),
        "currencies": star["currencies"].where("currency_name = 'RUB'").select("currency_id"),
    }
    return refresh.delete_from_star(star, root, doomed)[1]


@_query
def star_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows left and removed per table."""
    return cascade.delete_counts(_cascaded(spark, sf_dir))


@_query
def star_cascade_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The payments that are left."""
    return plain(_cascaded(spark, sf_dir).left["payments"])


# --- planted defects ----------------------------------------------------------------------------------------


def _every(n: int) -> faults.Picker:
    """Hit rows by key arithmetic, which SQL can repeat; the default picks by hash."""
    return lambda key, defect, share: F.pmod(key, F.lit(n)) == 1


@_query
def fi_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return faults.blank_values(orders, "o_orderkey", ["o_custkey", "o_totalprice"], pick=_every(25))


@_query
def fi_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return faults.wrong_dates(
        orders, "o_orderkey", "o_orderdate", pick=_every(20), year_of=lambda key: F.pmod(key, F.lit(4))
    )


@_query
def fi_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return faults.repeat_rows(table(spark, sf_dir, "orders"), "o_orderkey", copies=2, pick=_every(20))


@_query
def fi_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("o_totalprice", F.col("o_totalprice").cast(casts.MONEY_TYPE))
    return plain(faults.inflate_amounts(orders, "o_orderkey", "o_totalprice", pick=_every(100)))


@_query
def fi_burst(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    changes = {"o_orderkey": lambda place: F.col("o_orderkey") * 1000 + place + 10_000_000}
    return faults.add_bursts(orders, F.pmod("o_custkey", F.lit(300)) == 7, 10, changes)


@_query
def fi_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return faults.shuffle_rows(table(spark, sf_dir, "orders"))


def all_queries() -> dict[str, Query]:
    return dict(_registry)
