"""The registered queries as DuckDB SQL over the same tables."""

from __future__ import annotations

from checks.standins import ORDER_BOUNDS, duck_sql
from riskflow.schemas import CLIENTS, DATE_BOUNDS, ENTITIES

TOKEN_LIST = r"""('NaN', '"NaN"', '\NaN\', 'NaT', '')"""


# --- snippets -----------------------------------------------------------------------------------------------


def _float(c: str) -> str:
    return rf"(CASE WHEN regexp_matches({c}, '^-?\d+(\.\d+)?$') THEN try_cast({c} AS double) END)"


def _id(c: str) -> str:
    return f"try_cast({_float(c)} AS bigint)"


def _numeric(c: str) -> str:
    return rf"(CASE WHEN regexp_matches({c}, '^\s*-?\d+(\.\d{{1,2}})?\s*$') THEN try_cast(trim({c}) AS decimal(15,2)) END)"


def _timestamp(c: str) -> str:
    iso = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?([+-]\d{2}:\d{2}|Z)?$"
    return f"(CASE WHEN regexp_matches({c}, '{iso}') THEN try_cast({c} AS timestamp) END)"


def _date(c: str) -> str:
    return f"(CASE WHEN {_timestamp(c)} IS NOT NULL THEN try_cast(substr({c}, 1, 10) AS date) END)"


def _octet(c: str, i: int) -> str:
    return f"try_cast(string_split({c}, '.')[{i}] AS bigint)"


def _ip_ok(c: str) -> str:
    small = " AND ".join(f"{_octet(c, i)} <= 255" for i in (1, 2, 3, 4))
    return rf"coalesce(regexp_matches({c}, '^(\d{{1,3}}\.){{3}}\d{{1,3}}$') AND {small}, false)"


def _ip(c: str) -> str:
    parts = ", ".join(f"cast({_octet(c, i)} AS varchar)" for i in (1, 2, 3, 4))
    return f"(CASE WHEN {_ip_ok(c)} THEN concat_ws('.', {parts}) END)"


def _ip_number(c: str) -> str:
    o1, o2, o3, o4 = (_octet(c, i) for i in (1, 2, 3, 4))
    return f"(CASE WHEN {_ip_ok(c)} THEN {o1} * 16777216 + {o2} * 65536 + {o3} * 256 + {o4} END)"


def _blank(c: str) -> str:
    return f"(CASE WHEN {c} IN {TOKEN_LIST} THEN NULL ELSE {c} END)"


def _first(source: str, keys: str, order: str) -> str:
    return f"SELECT * FROM ({source}) QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {order}) = 1"


def _nulls_first(*columns: str) -> str:
    return ", ".join(f"{c} NULLS FIRST" for c in columns)


def _between(column: str, bounds: tuple[str, str]) -> str:
    return f"{column} BETWEEN timestamp '{bounds[0]}' AND timestamp '{bounds[1]}'"


# --- layers as common table expressions ---------------------------------------------------------------------


def _dim(source: str, column: str, key: str, name: str) -> str:
    return (
        f"SELECT cast(row_number() OVER (ORDER BY {name}) AS integer) AS {key}, {name} FROM "
        rf"(SELECT DISTINCT {column} AS {name} FROM {source} WHERE lower({column}) NOT IN ('\nan\', '{column}'))"
    )


_CLIENT_FIELDS = (
    "c.client_id, c.client_first_name, c.client_last_name, c.client_email, c.client_phone, c.client_address, "
    "c.client_birthday"
)

_CTES: dict[str, str] = {
    **{f"raw_{name}": duck_sql(name) for name in ENTITIES},
    "ods_clients": f"""SELECT DISTINCT {_id("client_id")} AS client_id, client_first_name, client_last_name, client_email,
      client_phone, client_address, {_date("client_birthday")} AS client_birthday FROM raw_clients
      WHERE client_first_name NOT LIKE '%NaN%' AND client_last_name NOT LIKE '%NaN%'""",
    "ods_activity": f"""SELECT DISTINCT {_id("client_id")} AS client_id, {_timestamp("activity_date")} AS activity_date,
      activity_type, activity_location, {_ip("ip_address")} AS ip_address, device FROM raw_clients_activity""",
    "ods_logins": f"""SELECT DISTINCT {_id("client_id")} AS client_id, {_timestamp("login_date")} AS login_date,
      {_ip("ip_address")} AS ip_address, location, device FROM raw_logins""",
    "ods_payments": f"""SELECT DISTINCT {_id("client_id")} AS client_id, {_id("payment_id")} AS payment_id,
      {_timestamp("payment_date")} AS payment_date, currency, {_numeric("amount")} AS amount, payment_method
      FROM raw_payments""",
    "ods_transactions": f"""SELECT DISTINCT {_id("client_id")} AS client_id, {_id("transaction_id")} AS transaction_id,
      {_timestamp("transaction_date")} AS transaction_date, transaction_type, account_number, currency,
      {_numeric("amount")} AS amount, record_saved_at FROM raw_transactions""",
    "dds_clients": f"""SELECT client_id, client_first_name, client_last_name, {_blank("client_email")} AS client_email,
      {_blank("client_phone")} AS client_phone, {_blank("client_address")} AS client_address, client_birthday
      FROM ods_clients WHERE client_id IS NOT NULL""",
    "dim_activity_type": _dim("ods_activity", "activity_type", "activity_type_id", "activity_type_name"),
    "dim_currency": _dim("ods_payments", "currency", "currency_id", "currency_name"),
    "dim_payment_method": _dim("ods_payments", "payment_method", "payment_method_id", "payment_method_name"),
    "dim_transaction_type": _dim("ods_transactions", "transaction_type", "transaction_type_id", "transaction_type_name"),
    "fact_activity": _first(
        f"""SELECT client_id, activity_date, activity_type_id AS activity_type,
        {_blank("activity_location")} AS activity_location, ip_address, {_blank("device")} AS device
        FROM ods_activity JOIN dim_activity_type ON activity_type = activity_type_name
        WHERE client_id IS NOT NULL AND {_between("activity_date", DATE_BOUNDS)}""",
        "client_id, activity_date",
        _nulls_first("activity_type", "activity_location", "ip_address", "device"),
    ),
    "fact_login": _first(
        f"""SELECT client_id, login_date, ip_address, {_blank("location")} AS location, {_blank("device")} AS device
        FROM ods_logins WHERE client_id IS NOT NULL AND {_between("login_date", ORDER_BOUNDS)}""",
        "client_id, login_date",
        _nulls_first("ip_address", "location", "device"),
    ),
    "fact_payment": _first(
        f"""SELECT payment_id, client_id, payment_date, currency_id AS currency, amount,
        payment_method_id AS payment_method
        FROM ods_payments JOIN dim_currency ON currency = currency_name
        JOIN dim_payment_method ON payment_method = payment_method_name
        WHERE payment_id IS NOT NULL AND {_between("payment_date", DATE_BOUNDS)}""",
        "payment_id",
        _nulls_first("client_id", "payment_date", "currency", "amount", "payment_method"),
    ),
    "fact_transaction": _first(
        f"""SELECT transaction_id, client_id, transaction_date, transaction_type_id AS transaction_type,
        {_blank("account_number")} AS account_number, currency_id AS currency, amount
        FROM ods_transactions JOIN dim_currency ON currency = currency_name
        JOIN dim_transaction_type ON transaction_type = transaction_type_name
        WHERE transaction_id IS NOT NULL AND {_between("transaction_date", ORDER_BOUNDS)}""",
        "transaction_id",
        _nulls_first("client_id", "transaction_date", "transaction_type", "account_number", "currency", "amount"),
    ),
    "mart_activity": f"""SELECT {_CLIENT_FIELDS}, a.activity_date, a.activity_type AS activity_type_id,
      t.activity_type_name, a.activity_location, a.ip_address AS ip_address_activity, a.device AS activity_device,
      l.login_date, l.ip_address AS ip_address_login, l.location AS login_location, l.device AS login_device
      FROM fact_activity a JOIN dim_activity_type t ON a.activity_type = t.activity_type_id
      JOIN dds_clients c ON c.client_id = a.client_id JOIN fact_login l ON l.client_id = a.client_id""",
    "mart_transaction": f"""SELECT {_CLIENT_FIELDS}, t.account_number, t.transaction_id, t.transaction_date,
      t.transaction_type AS transaction_type_id, k.transaction_type_name, t.currency AS currency_id, u.currency_name,
      t.amount AS total_amount
      FROM fact_transaction t JOIN dds_clients c ON c.client_id = t.client_id
      JOIN dim_currency u ON u.currency_id = t.currency
      JOIN dim_transaction_type k ON k.transaction_type_id = t.transaction_type""",
    "mart_payment": f"""SELECT {_CLIENT_FIELDS}, p.payment_id, t.account_number, p.payment_date,
      p.currency AS currency_id, u.currency_name, p.amount AS total_amount, p.payment_method AS payment_method_id,
      m.payment_method_name
      FROM fact_payment p JOIN dds_clients c ON c.client_id = p.client_id
      JOIN dim_currency u ON u.currency_id = p.currency
      JOIN dim_payment_method m ON m.payment_method_id = p.payment_method
      JOIN fact_transaction t ON t.client_id = p.client_id""",
}


def _with_layers(body: str, keyed: bool = False) -> str:
    """Prefix the layers that ``body`` uses, directly or through others, in dependency order.

    ``keyed`` leaves out rows without a client, as an ingest of messages does.
    """
    used: list[str] = []

    def visit(sql: str) -> None:
        for name, definition in _CTES.items():
            if name not in used and name in sql and name != sql:
                visit(definition)
                if name not in used:
                    used.append(name)

    visit(body)
    if not used:
        return body
    keep = " WHERE client_id <> 'NaN'" if keyed else ""
    sources = {n: f"SELECT * FROM ({_CTES[n]}){keep}" for n in used if n.startswith("raw_")}
    ctes = ",\n".join(f"{name} AS ({sources.get(name, _CTES[name])})" for name in used)
    return f"WITH {ctes}\n{body}"


# --- detectors ----------------------------------------------------------------------------------------------


def _profile(source: str, client: str, at: str, item: str, amount: str) -> str:
    return (
        f"SELECT {client} AS client_id, cast({at} AS date) AS transaction_day, count({item}) AS daily_transaction_count, "
        f"sum(cast({amount} AS decimal(15,2))) AS daily_total_amount FROM {source} GROUP BY ALL"
    )


_OUT = (
    "client_id, transaction_day, daily_transaction_count, cast(daily_total_amount AS double) AS daily_total_amount"
)
_EVENTS = _profile("events", "user_id", "ts", "event_id", "value")
_ORDERS = _profile("orders", "o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
_ITEMS = _profile("lineitem", "l_suppkey", "l_shipdate", "l_orderkey", "l_extendedprice")
_MART = _profile("mart_transaction", "client_id", "transaction_date", "transaction_id", "total_amount")


def _zscore_global(profile: str) -> str:
    return f"""SELECT {_OUT} FROM ({profile}), (
      SELECT avg(daily_transaction_count) AS an, stddev_samp(daily_transaction_count) AS sn,
        avg(cast(daily_total_amount AS double)) AS ta, stddev_samp(cast(daily_total_amount AS double)) AS st
      FROM ({profile}))
    WHERE daily_transaction_count > an + 3 * sn OR cast(daily_total_amount AS double) > ta + 3 * st"""


def _iqr_global(profile: str, quantile: str = "quantile_cont", sample: int | None = None) -> str:
    count, total = "cast(daily_transaction_count AS double)", "cast(daily_total_amount AS double)"
    given = profile
    if sample:
        profile = f"""SELECT * FROM ({given})
          ORDER BY md5(concat_ws('|', cast(client_id AS varchar), cast(transaction_day AS varchar))) LIMIT {sample}"""
    return f"""SELECT {_OUT} FROM ({given}), (
      SELECT {quantile}({count}, 0.25) AS n1, {quantile}({count}, 0.75) AS n3,
        {quantile}({total}, 0.25) AS t1, {quantile}({total}, 0.75) AS t3 FROM ({profile}))
    WHERE {count} < n1 - 1.5 * (n3 - n1) OR {count} > n3 + 1.5 * (n3 - n1)
      OR {total} < t1 - 1.5 * (t3 - t1) OR {total} > t3 + 1.5 * (t3 - t1)"""


def _days(source: str, client: str, at: str, amount: str, places: int) -> str:
    return f"""SELECT client_id, transaction_date, transaction_count,
      round(total, {places}) AS total_transaction_amount,
      round(an, {places}) AS avg_transaction_count, round(sn, {places}) AS stddev_transaction_count,
      round(ta, {places}) AS avg_total_amount, round(st, {places}) AS stddev_total_amount, an, sn, ta, st, total
    FROM (SELECT *, avg(transaction_count) OVER w AS an, stddev_samp(transaction_count) OVER w AS sn,
        avg(exact) OVER w AS ta, stddev_samp(exact) OVER w AS st
      FROM (SELECT cast(cast({client} AS bigint) AS varchar) AS client_id, cast({at} AS date) AS transaction_date,
          count({amount}) AS transaction_count, sum(cast({amount} AS decimal(28,6))) AS exact, cast(exact AS double) AS total
        FROM ({source}) WHERE {client} IS NOT NULL AND {at} IS NOT NULL AND {amount} IS NOT NULL GROUP BY ALL)
      WINDOW w AS (PARTITION BY transaction_date))"""


def _day_stats(*args: object) -> str:
    return f"SELECT * EXCLUDE (an, sn, ta, st, total) FROM ({_days(*args)})"


def _zscore_by_day(source: str, client: str, at: str, amount: str, places: int, k: int = 2) -> str:
    return f"""SELECT * EXCLUDE (an, sn, ta, st, total), coalesce(transaction_count > an + {k} * sn, false)
        AS is_count_anomaly, coalesce(total > ta + {k} * st, false) AS is_amount_anomaly
      FROM ({_days(source, client, at, amount, places)})
      WHERE is_count_anomaly OR is_amount_anomaly"""


# --- the registry -------------------------------------------------------------------------------------------


def _cast(table: str, column: str, expression: str) -> str:
    return f"SELECT {column} AS given, {expression} AS result FROM raw_{table}"


def _wire(entity: str, drop_keyless: bool = True) -> str:
    columns = []
    for name, kind in ENTITIES[entity].wire.items():
        if "date" in name or "birthday" in name:
            columns.append(f"try_cast({name} AS timestamp) AS {name}")
        elif kind.simpleString() == "double":
            columns.append(f"try_cast({name} AS double) AS {name}")
        else:
            columns.append(name)
    sql = f"SELECT {', '.join(columns)} FROM raw_{entity}"
    key = ENTITIES[entity].key
    return f"SELECT * FROM ({sql}) WHERE {key} IS NOT NULL AND NOT isnan({key})" if drop_keyless else sql


def _plain(layer: str, *money: str) -> str:
    casts = ", ".join(f"cast({c} AS double) AS {c}" for c in money)
    return f"SELECT * REPLACE ({casts}) FROM {layer}" if money else f"SELECT * FROM {layer}"


def _dq(check: str, target: str, count: str) -> str:
    return f"SELECT '{check}' AS \"check\", '{target}' AS target, ({count}) AS violations"


_STAR = {
    "clients": ("dds_clients", "client_id"),
    "activity_types": ("dim_activity_type", "activity_type_id"),
    "currencies": ("dim_currency", "currency_id"),
    "payment_methods": ("dim_payment_method", "payment_method_id"),
    "transaction_types": ("dim_transaction_type", "transaction_type_id"),
    "clients_activity": ("fact_activity", "client_id,activity_date"),
    "logins": ("fact_login", "client_id,login_date"),
    "payments": ("fact_payment", "payment_id"),
    "transactions": ("fact_transaction", "transaction_id"),
}


def _pk(source: str, keys: str, target: str | None = None) -> str:
    missing = " OR ".join(f"{k} IS NULL" for k in keys.split(","))
    grouped = f"SELECT {keys}, count(*) AS n FROM {source} GROUP BY {keys}"
    return _dq("primary_key", target or keys, f"SELECT count(*) FROM ({grouped}) WHERE n > 1 OR {missing}")


def _fk(child: str, key: str, parent: str, parent_key: str, target: str | None = None) -> str:
    return _dq(
        "foreign_key",
        target or key,
        f"SELECT count(*) FROM {child} WHERE {key} IS NOT NULL AND NOT EXISTS "
        f"(SELECT 1 FROM {parent} p WHERE p.{parent_key} = {key})",
    )


def _too_long(source: str, column: str, length: int) -> str:
    return _dq("max_length", column, f"SELECT count(*) FROM {source} WHERE length({column}) > {length}")


# which rows of a table go with every seventh client and the roubles
_GONE_CLIENT = "coalesce(client_id % 7 = 2 AND client_id IN (SELECT client_id FROM dds_clients), false)"
_GONE_CURRENCY = "coalesce(currency IN (SELECT currency_id FROM dim_currency WHERE currency_name = 'RUB'), false)"


def _gone(name: str) -> str:
    if name == "currencies":
        return "(currency_name = 'RUB')"
    if name in ("payments", "transactions"):
        return f"({_GONE_CLIENT} OR {_GONE_CURRENCY})"
    return f"({_GONE_CLIENT})" if name in ("clients", "clients_activity", "logins") else "false"


def _rules(*cases: tuple[str, str]) -> str:
    return "CASE " + " ".join(f"WHEN {broken} THEN '{name}'" for name, broken in cases) + " END"


def _judged(name: str) -> str:
    """The typed rows of a star table with the first rule that each breaks."""

    def missing(*columns: str) -> list[tuple[str, str]]:
        return [(f"not_null:{c}", f"{c} IS NULL") for c in columns]

    def outside(column: str, bounds: tuple[str, str]) -> tuple[str, str]:
        return f"date_range:{column}", f"NOT coalesce({_between(column, bounds)}, false)"

    def long(entity: str) -> list[tuple[str, str]]:
        return [(f"max_length:{c}", f"length({c}) > {n}") for c, n in ENTITIES[entity].lengths.items()]

    def unknown(column: str, dim: str) -> tuple[str, str]:
        return f"known:{column}", f"{column} IS NULL OR {column} NOT IN (SELECT {dim}_name FROM dim_{dim})"

    def first(source: str, keys: str, order: list[str], cases: list[tuple[str, str]]) -> str:
        ranked = f"row_number() OVER (PARTITION BY {keys}, rule IS NULL ORDER BY {_nulls_first(*order)})"
        return f"""SELECT * EXCLUDE (rule), CASE WHEN rule IS NULL AND {ranked} > 1 THEN 'primary_key' ELSE rule END AS broken_rule
          FROM (SELECT *, {_rules(*cases)} AS rule FROM {source})"""

    def names(source: str, column: str, dim: str) -> str:
        return f"SELECT DISTINCT {column}, CASE WHEN {unknown(column, dim)[1]} THEN 'name:{column}' END AS broken_rule FROM {source}"

    if name == "clients":
        return f"SELECT *, {_rules(*missing('client_id'), *long('clients'))} AS broken_rule FROM ods_clients"
    if name == "clients_activity":
        cases = [*missing("client_id", "activity_date"), outside("activity_date", DATE_BOUNDS), *long(name), unknown("activity_type", "activity_type")]
        order = ["activity_type", _blank("activity_location"), "ip_address", _blank("device"), "activity_location", "device"]
        return first("ods_activity", "client_id, activity_date", order, cases)
    if name == "logins":
        cases = [*missing("client_id", "login_date"), outside("login_date", ORDER_BOUNDS), *long(name)]
        return first("ods_logins", "client_id, login_date", ["ip_address", _blank("location"), _blank("device"), "location", "device"], cases)
    if name == "payments":
        cases = [*missing("payment_id"), outside("payment_date", DATE_BOUNDS), *long(name)]
        cases += [unknown("currency", "currency"), unknown("payment_method", "payment_method")]
        return first("ods_payments", "payment_id", ["client_id", "payment_date", "currency", "amount", "payment_method"], cases)
    if name == "transactions":
        cases = [*missing("transaction_id"), outside("transaction_date", ORDER_BOUNDS), *long(name)]
        cases += [unknown("currency", "currency"), unknown("transaction_type", "transaction_type")]
        order = ["client_id", "transaction_date", "transaction_type", _blank("account_number"), "currency", "amount", "account_number", "record_saved_at"]
        return first("ods_transactions", "transaction_id", order, cases)
    source, column, dim = {
        "activity_types": ("ods_activity", "activity_type", "activity_type"),
        "currencies": ("ods_payments", "currency", "currency"),
        "payment_methods": ("ods_payments", "payment_method", "payment_method"),
        "transaction_types": ("ods_transactions", "transaction_type", "transaction_type"),
    }[name]
    return names(source, column, dim)


_LOGINS_CSV = """SELECT concat(cast(client_id AS varchar)) AS client_id,
  CASE WHEN login_date IS NOT NULL THEN strftime(login_date, '%Y-%m-%dT%H:%M:%S.') || '000Z' END AS login_date,
  ip_address, location, device"""


def _bodies() -> dict[str, str]:
    b: dict[str, str] = {
        "ano_zscore_global": _zscore_global(_EVENTS),
        "ano_zscore_global_orders": _zscore_global(_ORDERS),
        "ano_zscore_global_lineitem": _zscore_global(_ITEMS),
        "ano_iqr_global": _iqr_global(_EVENTS),
        "ano_iqr_global_orders": _iqr_global(_ORDERS),
        "ano_iqr_global_lineitem": _iqr_global(_ITEMS),
        "ano_iqr_global_sketch": _iqr_global(_EVENTS, "quantile_disc"),
        "ano_iqr_sampled": _iqr_global(_ORDERS, sample=512),
        "ano_iqr_sampled_whole": _iqr_global(_EVENTS),
        "daily_profile": f"SELECT {_OUT} FROM ({_ORDERS})",
        "ano_zscore_by_day": _zscore_by_day("FROM events", "user_id", "ts", "value", 6),
        "day_window_stats": _day_stats("FROM events", "user_id", "ts", "value", 6),
        "stored_table_query": _zscore_by_day("FROM orders", "o_custkey", "o_orderdate", "o_totalprice", 4, 3),
        "quantiles_staged": f"""SELECT daily_transaction_count, cast(daily_total_amount AS double) AS daily_total_amount,
          round(n1, 6) AS q1_daily_transaction_count, round(n3, 6) AS q3_daily_transaction_count,
          round(t1, 6) AS q1_daily_total_amount, round(t3, 6) AS q3_daily_total_amount
          FROM ({_EVENTS}), (SELECT quantile_cont(cast(daily_transaction_count AS double), 0.25) AS n1,
            quantile_cont(cast(daily_transaction_count AS double), 0.75) AS n3,
            quantile_cont(cast(daily_total_amount AS double), 0.25) AS t1,
            quantile_cont(cast(daily_total_amount AS double), 0.75) AS t3 FROM ({_EVENTS}))""",
        "safe_float": _cast("clients_activity", "client_id", _float("client_id")),
        "safe_id": _cast("transactions", "transaction_id", _id("transaction_id")),
        "safe_numeric": _cast("payments", "amount", f"cast({_numeric('amount')} AS double)"),
        "safe_numeric_rounding": _cast(
            "payments",
            "amount",
            "CASE WHEN NOT isnan(try_cast(amount AS double)) THEN "
            "cast(try_cast(trim(amount) AS decimal(15,2)) AS double) END",
        ),
        "safe_timestamp": _cast("clients_activity", "activity_date", _timestamp("activity_date")),
        "safe_date": _cast("clients", "client_birthday", _date("client_birthday")),
        "safe_inet": _cast("logins", "ip_address", _ip("ip_address")),
        "ip_valid": _cast("clients_activity", "ip_address", _ip_ok("ip_address")),
        "ip_to_number": _cast("clients_activity", "ip_address", _ip_number("ip_address")),
        "null_token_cleanup": _cast("clients_activity", "device", _blank("device")),
        "float_id_to_int": "SELECT l_orderkey, l_linenumber, cast(l_quantity / 2 AS bigint) AS whole FROM lineitem",
        "drop_missing_key": """SELECT * FROM (SELECT * REPLACE (try_cast(client_id AS double) AS client_id)
          FROM raw_clients_activity) WHERE client_id IS NOT NULL AND NOT isnan(client_id)""",
        "required_columns": """SELECT * REPLACE (cast(amount AS double) AS amount) FROM ods_payments
          WHERE client_id IS NOT NULL AND payment_date IS NOT NULL AND amount IS NOT NULL""",
        "name_not_like": """SELECT * FROM raw_clients
          WHERE client_first_name NOT LIKE '%NaN%' AND client_last_name NOT LIKE '%NaN%'""",
        "exclude_tokens": r"SELECT * FROM raw_payments WHERE lower(currency) NOT IN ('\nan\', 'currency')",
        "date_range": f"""SELECT * FROM (SELECT * REPLACE ({_timestamp("activity_date")} AS activity_date)
          FROM raw_clients_activity) WHERE {_between("activity_date", DATE_BOUNDS)}""",
        "distinct_rows": "SELECT DISTINCT * FROM (SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_id % 7 = 1)",
        "union_rows": "SELECT * FROM customer UNION ALL SELECT * FROM customer",
        "distinct_on_activity": _first("SELECT * FROM events", "user_id, cast(ts AS date)", "ts, event_id"),
        "distinct_on_login": _first("SELECT * FROM events", "user_id, event_type", "ts, event_id"),
        "distinct_on_payment": _first(
            "SELECT * FROM lineitem",
            "l_orderkey",
            "l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, "
            "l_linestatus, l_shipdate",
        ),
        "distinct_on_transaction": _first("SELECT * FROM orders", "o_custkey, o_orderstatus", "o_orderdate, o_orderkey"),
        "preview_top": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 20",
        "json_parse_flatten": "SELECT cast(json_extract_string(props, '$.k') AS bigint) AS k FROM events",
        "schema_driven_cast": _wire("payments", drop_keyless=False),
        "json_encode_rows": """SELECT cast(to_json({'event_id': event_id,
            'ts': CASE WHEN microsecond(ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
              ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END,
            'day': strftime(ts, '%Y-%m-%d'), 'user_id': user_id, 'event_type': event_type, 'value': value}) AS varchar)
          AS value FROM events""",
        "dim_numbered_in_ranges": """SELECT cast(row_number() OVER (ORDER BY c_name) AS integer) AS name_id, c_name AS name
          FROM (SELECT DISTINCT c_name FROM customer)""",
        "ods_clients": _plain("ods_clients"),
        "ods_activity": _plain("ods_activity"),
        "ods_logins": _plain("ods_logins"),
        "ods_payments": _plain("ods_payments", "amount"),
        "ods_transactions": _plain("ods_transactions", "amount"),
        "dds_clients": _plain("dds_clients"),
        "dim_activity_type": _plain("dim_activity_type"),
        "dim_currency": _plain("dim_currency"),
        "dim_payment_method": _plain("dim_payment_method"),
        "dim_transaction_type": _plain("dim_transaction_type"),
        "fact_activity": _plain("fact_activity"),
        "fact_login": _plain("fact_login"),
        "fact_payment": _plain("fact_payment", "amount"),
        "fact_transaction": _plain("fact_transaction", "amount"),
        "mart_activity_logins": _plain("mart_activity"),
        "mart_transactions": _plain("mart_transaction", "total_amount"),
        "mart_payments": _plain("mart_payment", "total_amount"),
        "mart_activity_logins_cut": _plain("mart_activity"),
        "mart_transactions_cut": _plain("mart_transaction", "total_amount"),
        "mart_payments_cut": _plain("mart_payment", "total_amount"),
        "publish_activity": f"""SELECT * REPLACE ({_ip_number("ip_address_activity")} AS ip_address_activity,
          {_ip_number("ip_address_login")} AS ip_address_login) FROM mart_activity""",
        "publish_transactions": _plain("mart_transaction", "total_amount"),
        "publish_payments": _plain("mart_payment", "total_amount"),
        "refresh_zscore_global": _zscore_global(_MART),
        "refresh_iqr_global": _iqr_global(_MART),
        "mart_zscore_by_day": _zscore_by_day("FROM mart_payment", "client_id", "payment_date", "total_amount", 4),
        "mart_zscore_by_day_eager": _zscore_by_day("FROM mart_payment", "client_id", "payment_date", "total_amount", 4),
        "mart_profile_eager": f"""SELECT {_OUT} FROM
          ({_profile("mart_payment", "client_id", "payment_date", "payment_id", "total_amount")})""",
        "mart_activity_profile_eager": """SELECT client_id, cast(activity_date AS date) AS activity_day, count(*) AS mart_rows
          FROM mart_activity GROUP BY ALL""",
        **{f"raw_{name}": f"SELECT * FROM raw_{name}" for name in ENTITIES},
        "csv_typed_scan": """SELECT * REPLACE (CASE WHEN client_id <> 'NaN' THEN cast(client_id AS double) END AS client_id)
          FROM raw_clients""",
        "json_message_files": "SELECT * FROM orders",
        "json_inferred_schema": "SELECT * FROM customer",
        "json_fallback_schema": "SELECT cast(NULL AS bigint) AS c_custkey, cast(NULL AS varchar) AS c_name FROM customer",
        "refresh_overwrite": "SELECT *, 2 AS versions, 3 AS newest FROM orders",
        "layout_distributed": "SELECT * FROM orders",
        "layout_bucketed": "SELECT o_orderkey, c_name, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey",
        "layout_sorted": "SELECT * FROM lineitem",
        "layout_distributed_keys": """SELECT count(DISTINCT o_custkey) AS customers, cast(0 AS bigint) AS in_several_files
          FROM orders""",
        "layout_sorted_ranges": "SELECT count(*) AS stored_rows, cast(0 AS bigint) AS overlaps FROM lineitem",
        "anomalies_to_csv": _zscore_by_day("FROM events", "user_id", "ts", "value", 6),
        **{f"stream_ingest_{name}": _wire(name) for name in ENTITIES},
        "stream_ingest_for_analysis": _zscore_by_day(
            f"SELECT * FROM ({_wire('payments')}) WHERE NOT isnan(amount)", "client_id", "payment_date", "amount", 4
        ),
        "stream_to_csv": f"{_LOGINS_CSV} FROM ({_wire('logins')})",
        "stream_to_typed": f"""SELECT DISTINCT {_id("client_id")} AS client_id, {_id("transaction_id")} AS transaction_id,
          try_cast(transaction_date AS timestamp) AS transaction_date, transaction_type, account_number, currency,
          cast(CASE WHEN amount <> 'NaN' THEN cast(amount AS decimal(15,2)) END AS double)
          AS amount, record_saved_at FROM raw_transactions WHERE client_id <> 'NaN'""",
        "dq_not_null": " UNION ALL ".join(
            _dq("not_null", c, f"SELECT count(*) FROM ods_payments WHERE {c} IS NULL")
            for c in ("client_id", "payment_id", "payment_date", "amount")
        ),
        "dq_primary_key": " UNION ALL ".join(
            [_pk("ods_transactions", "transaction_id"), _pk("lineitem", "l_orderkey,l_linenumber"), _pk("orders", "o_orderkey")]
        ),
        "dq_foreign_key": " UNION ALL ".join(
            [
                _fk("orders", "o_custkey", "dds_clients", "client_id"),
                _fk("events", "user_id", "dds_clients", "client_id"),
                _fk("customer", "c_nationkey", "nation", "n_nationkey"),
            ]
        ),
        "dq_length": " UNION ALL ".join(
            [_too_long("raw_clients", c, n) for c, n in CLIENTS.lengths.items()] + [_too_long("raw_payments", "currency", 3)]
        ),
        "refresh_checks": " UNION ALL ".join(
            [_pk(source, keys, f"{name}.{keys}") for name, (source, keys) in _STAR.items()]
            + [
                _fk(_STAR[name][0], f"{_STAR[name][0]}.client_id", "dds_clients", "client_id", f"{name}.client_id")
                for name in ("clients_activity", "logins", "payments", "transactions")
            ]
        ),
        "star_cascade": " UNION ALL ".join(
            f"""SELECT '{name}' AS table_name, (SELECT count(*) FROM {source} WHERE NOT {_gone(name)}) AS rows_left,
              (SELECT count(*) FROM {source} WHERE {_gone(name)}) AS rows_removed"""
            for name, (source, _) in _STAR.items()
        ),
        "star_cascade_payments": f"""SELECT * REPLACE (cast(amount AS double) AS amount) FROM fact_payment
          WHERE NOT {_gone("payments")}""",
        "refresh_rejects": " UNION ALL ".join(
            [f"SELECT '{n}' AS table_name, broken_rule, count(*) AS rows FROM ({_judged(n)}) WHERE broken_rule IS NOT NULL GROUP BY ALL" for n in _STAR]
            + [f"SELECT '{n}' AS table_name, '' AS broken_rule, count(*) AS rows FROM {source}" for n, (source, _) in _STAR.items()]
        ),
        "rejects_payments": f"SELECT * REPLACE (cast(amount AS double) AS amount) FROM ({_judged('payments')}) WHERE broken_rule IS NOT NULL",
        "rejects_transactions": f"SELECT * REPLACE (cast(amount AS double) AS amount) FROM ({_judged('transactions')}) WHERE broken_rule IS NOT NULL",
        "rejects_accepted_transactions": _plain("fact_transaction", "amount"),
        "fi_missing": """SELECT * REPLACE (CASE WHEN o_orderkey % 25 <> 1 THEN o_custkey END AS o_custkey,
          CASE WHEN o_orderkey % 25 <> 1 THEN o_totalprice END AS o_totalprice) FROM orders""",
        "fi_dates": """SELECT * REPLACE (CASE WHEN o_orderkey % 20 = 1 THEN cast(make_date(
            [1700, 1800, 2100, 2200][o_orderkey % 4 + 1], month(o_orderdate), least(day(o_orderdate), 28)) AS timestamp)
          ELSE o_orderdate END AS o_orderdate) FROM orders""",
        "fi_duplicates": """SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderkey % 20 = 1
          UNION ALL SELECT * FROM orders WHERE o_orderkey % 20 = 1""",
        "fi_amounts": """SELECT * REPLACE (cast(cast(o_totalprice AS decimal(15,2))
          * CASE WHEN o_orderkey % 100 = 1 THEN 10 ELSE 1 END AS double) AS o_totalprice) FROM orders""",
        "fi_burst": """SELECT * FROM orders UNION ALL
          SELECT * REPLACE (o_orderkey * 1000 + place + 10000000 AS o_orderkey)
          FROM (SELECT orders.*, place FROM orders, range(1, 11) r(place) WHERE o_custkey % 300 = 7)""".replace(
            "SELECT * REPLACE (o_orderkey", "SELECT * EXCLUDE (place) REPLACE (o_orderkey"
        ),
        "fi_shuffle": "SELECT * FROM orders",
    }
    return b


def all_oracles() -> dict[str, str]:
    oracles = {name: _with_layers(body) for name, body in _bodies().items()}
    from_messages = {
        "messages_to_zscore_global": _zscore_global(_MART),
        "messages_dim_currency": "SELECT * FROM dim_currency",
        "messages_fact_payment": _plain("fact_payment", "amount"),
    }
    found = {name: _with_layers(body, keyed=True) for name, body in from_messages.items()}
    # an amount in a message is a number, so it reaches the cast as the number's plain text, without blanks or exponent
    number = "cast(try_cast(amount AS double) AS varchar)"
    found["messages_fact_payment"] = found["messages_fact_payment"].replace(_numeric("amount"), _numeric(number))
    return oracles | found
