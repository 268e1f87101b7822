"""Run registered queries in Spark and their SQL in DuckDB and compare all values.

python -m tests.compare [sf] [name ...]
"""

from __future__ import annotations

import datetime
import math
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _value(v: object) -> object:
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else v
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return v


def _bag(rows: list, columns: list[str]) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(r[i]) for i in order) for r in rows)


def difference(spark, con, sf_dir: str, query, sql: str) -> str | None:
    """A description of the first difference, or none. The size of the result is put in ``difference.rows``."""
    df = query(spark, sf_dir)
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    ours, theirs = _bag(df.collect(), df.columns), _bag(result.fetchall(), names)
    difference.rows = sum(ours.values())
    if ours == theirs:
        return None
    only_ours, only_theirs = ours - theirs, theirs - ours
    return (
        f"{sum(ours.values())} rows, expected {sum(theirs.values())}; "
        f"only ours {list(only_ours)[:2]}, only theirs {list(only_theirs)[:2]}"
    )


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from riskflow.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session(spark__master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con, found, sqls = connect(sf_dir), queries(), oracle_sql()
    bad = 0
    for name in sys.argv[2:] or found:
        start = time.time()
        try:
            problem = difference(spark, con, sf_dir, found[name], sqls[name]) if name in sqls else "no SQL"
        except Exception as e:  # noqa: BLE001 - report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        print(f"{name:32s} {time.time() - start:6.2f}s {getattr(difference, 'rows', 0):8d} {problem or 'ok'}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main()
