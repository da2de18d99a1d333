"""Runs queries in Spark and their SQL in DuckDB and compares rows as multisets.

``python -m tests.compare [sf dir] [query ...]`` prints one line per query.
"""

from __future__ import annotations

import datetime
import decimal
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


def _plain(value):
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, decimal.Decimal):
        return format(value, "f")
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def multiset(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(spark, con, run, sql: str, sf_dir: str) -> tuple[str | None, int]:
    df = run(spark, sf_dir)
    got_columns, got = df.columns, df.collect()
    result = con.execute(sql)
    want_columns, want = [d[0] for d in result.description], result.fetchall()
    if sorted(got_columns) != sorted(want_columns):
        return f"columns {sorted(got_columns)} != {sorted(want_columns)}", len(got)
    a, b = multiset(got_columns, got), multiset(want_columns, want)
    if a != b:
        only_a, only_b = list((a - b).items())[:2], list((b - a).items())[:2]
        return f"rows {len(got)} vs {len(want)}; only Spark {only_a}; only SQL {only_b}", len(got)
    return None, len(got)


def main() -> None:
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from tests.session import session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    queries, oracle = entry.queries(), entry.oracle_sql()
    names = sys.argv[2:] or sorted(queries)
    spark, con = session(), connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            problem, n = difference(spark, con, queries[name], oracle[name], sf_dir)
        except Exception as exc:  # noqa: BLE001
            problem, n = f"{type(exc).__name__}: {str(exc)[:600]}", -1
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} rows={n} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print(f"{len(names)} queries, {bad} bad; without SQL: {sorted(queries.keys() - oracle.keys())}; "
          f"SQL only: {sorted(oracle.keys() - queries.keys())}")


if __name__ == "__main__":
    main()
