"""The five entities as dirty text tables, derived from the test tables in Spark SQL and in DuckDB SQL alike.

The test tables are clean, so defects are planted by a rule over the row number; all rows are kept.
clients <- customer, activity and payments <- events, logins and transactions <- orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# orders lie between 1995 and 2001; these bounds cut off both ends
ORDER_BOUNDS = ("1995-07-01", "2001-01-01")
SOURCES = {
    "clients": "customer",
    "clients_activity": "events",
    "logins": "orders",
    "payments": "events",
    "transactions": "orders",
}

_CLIENTS = """
SELECT CASE WHEN c_custkey % 14 = 3 THEN 'NaN' ELSE concat(cast(c_custkey AS {text}), '.0') END AS client_id,
  CASE WHEN c_custkey % 14 = 5 THEN {token} ELSE c_mktsegment END AS client_first_name,
  CASE WHEN c_custkey % 14 = 6 THEN NULL ELSE c_name END AS client_last_name,
  CASE WHEN c_custkey % 14 = 7 THEN {token} ELSE concat(lower(c_mktsegment), cast(c_custkey AS {text}), '@mail.test')
    END AS client_email,
  CASE WHEN c_custkey % 14 = 8 THEN {token} ELSE concat('+', cast(c_nationkey AS {text}), '-', cast(c_custkey AS {text}))
    END AS client_phone,
  CASE WHEN c_custkey % 14 = 9 THEN {token} ELSE concat('Street "', cast(c_custkey AS {text}), '", 5', chr(10), 'Town')
    END AS client_address,
  CASE WHEN c_custkey % 14 = 10 THEN 'NaT' WHEN c_custkey % 14 = 11 THEN '1990-05-06'
    ELSE concat(cast({birthday} AS {text}), 'T00:00:00.000Z') END AS client_birthday
FROM {source}
"""

_ACTIVITY = """
SELECT CASE WHEN event_id % 20 = 3 THEN 'NaN' ELSE concat(cast(user_id AS {text}), '.0') END AS client_id,
  CASE WHEN event_id % 20 = 7 THEN '1700-01-01T00:00:00.000Z' WHEN event_id % 20 = 9 THEN 'NaT' ELSE {iso_ts}
    END AS activity_date,
  CASE WHEN event_id % 20 = 5 THEN {token} ELSE event_type END AS activity_type,
  CASE WHEN event_id % 20 = 11 THEN {token} ELSE concat('path/', event_type) END AS activity_location,
  concat_ws('.', '10', cast(user_id AS {text}), cast(event_id % 300 AS {text}), '1') AS ip_address,
  CASE WHEN event_id % 20 = 13 THEN {token} ELSE concat('agent ', props) END AS device
FROM {source}
"""

_LOGINS = """
SELECT CASE WHEN o_orderkey % 20 = 3 THEN 'NaN' ELSE concat(cast(o_custkey AS {text}), '.0') END AS client_id,
  CASE WHEN o_orderkey % 20 = 7 THEN '2200-01-01T00:00:00.000Z' WHEN o_orderkey % 20 = 9 THEN 'NaT' ELSE {iso_order}
    END AS login_date,
  concat_ws('.', '010', cast(o_custkey % 300 AS {text}), cast(o_orderkey % 260 AS {text}), '7') AS ip_address,
  CASE WHEN o_orderkey % 20 = 11 THEN {token} ELSE concat('41.5, ', o_orderpriority) END AS location,
  CASE WHEN o_orderkey % 20 = 13 THEN {token} ELSE o_orderstatus END AS device
FROM {source}
"""

_PAYMENTS = """
SELECT CASE WHEN event_id % 20 = 3 THEN 'NaN' ELSE concat(cast(user_id AS {text}), '.0') END AS client_id,
  CASE WHEN event_id % 20 = 4 THEN {token} ELSE concat(cast(event_id - event_id % 2 AS {text}), '.0') END AS payment_id,
  CASE WHEN event_id % 20 = 7 THEN '1800-01-01T00:00:00.000Z' WHEN event_id % 20 = 9 THEN 'NaT' ELSE {iso_ts}
    END AS payment_date,
  CASE WHEN event_id % 20 = 11 THEN {token} WHEN event_id % 20 = 12 THEN 'Currency' WHEN event_id % 3 = 0 THEN 'RUB'
    ELSE 'USD' END AS currency,
  CASE WHEN event_id % 20 = 13 THEN concat(cast(cast(value AS decimal(15,2)) AS {text}), '5')
    WHEN event_id % 20 = 14 THEN '1.0E7' WHEN event_id % 20 = 15 THEN 'NaN'
    ELSE concat(' ', cast(cast(value AS decimal(15,2)) AS {text})) END AS amount,
  CASE WHEN event_id % 20 = 16 THEN {token} ELSE event_type END AS payment_method
FROM {source}
"""

_TRANSACTIONS = """
SELECT CASE WHEN o_orderkey % 20 = 3 THEN 'NaN' ELSE concat(cast(o_custkey AS {text}), '.0') END AS client_id,
  CASE WHEN o_orderkey % 20 = 4 THEN {token} ELSE concat(cast(o_orderkey - o_orderkey % 2 AS {text}), '.0')
    END AS transaction_id,
  CASE WHEN o_orderkey % 20 = 7 THEN '2100-01-01T00:00:00.000Z' WHEN o_orderkey % 20 = 9 THEN 'NaT' ELSE {iso_order}
    END AS transaction_date,
  CASE WHEN o_orderkey % 20 = 5 THEN {token} ELSE o_orderstatus END AS transaction_type,
  CASE WHEN o_orderkey % 20 = 11 THEN {token} ELSE concat('ACC', cast(o_custkey AS {text}), o_orderpriority)
    END AS account_number,
  CASE WHEN o_orderkey % 20 = 12 THEN 'EUR' WHEN o_orderkey % 3 = 0 THEN 'RUB' ELSE 'USD' END AS currency,
  CASE WHEN o_orderkey % 20 = 15 THEN 'NaN' ELSE cast(cast(o_totalprice AS decimal(15,2)) AS {text}) END AS amount,
  CASE WHEN o_orderkey % 20 = 16 THEN o_orderstatus END AS record_saved_at
FROM {source}
"""

_TEMPLATES = {
    "clients": _CLIENTS,
    "clients_activity": _ACTIVITY,
    "logins": _LOGINS,
    "payments": _PAYMENTS,
    "transactions": _TRANSACTIONS,
}
# every entity holds copies of some of its rows
_REPEATS = {
    "clients": "c_custkey % 25 = 1",
    "clients_activity": "event_id % 25 = 1",
    "logins": "o_orderkey % 25 = 1",
    "payments": "event_id % 25 = 1",
    "transactions": "o_orderkey % 25 = 1",
}
_SPARK = {
    "text": "string",
    "token": r"r'\NaN\'",
    "birthday": "date_add(date '1960-01-01', cast(c_custkey % 15000 AS int))",
    "iso_ts": "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\")",
    "iso_order": "date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss\")",
}
_DUCK = {
    "text": "varchar",
    "token": r"'\NaN\'",
    "birthday": "(date '1960-01-01' + cast(c_custkey % 15000 AS int))",
    "iso_ts": "strftime(ts, '%Y-%m-%dT%H:%M:%S')",
    "iso_order": "strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S')",
}


def _sql(entity: str, dialect: dict[str, str], source: str) -> str:
    body = _TEMPLATES[entity].format(source=source, **dialect)
    return f"{body} UNION ALL {body} WHERE {_REPEATS[entity]}"


def duck_sql(entity: str) -> str:
    return _sql(entity, _DUCK, SOURCES[entity])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def from_source(entity: str, source: DataFrame) -> DataFrame:
    return source.sparkSession.sql(_sql(entity, _SPARK, "{source}"), source=source)


def raw(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    return from_source(entity, table(spark, sf_dir, SOURCES[entity]))


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {entity: raw(spark, sf_dir, entity) for entity in SOURCES}


def source_stream(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """The dirty text table as a stream over the given table's file."""
    name = SOURCES[entity]
    schema = table(spark, sf_dir, name).schema
    return from_source(entity, spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}*.parquet"))
