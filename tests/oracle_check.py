"""Compare every query with its SQL on one folder of driver tables.

Usage: python tests/oracle_check.py [folder] [name ...]
"""

from __future__ import annotations

import datetime
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as contract  # noqa: E402
from eavcube.session import make_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def norm(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


def compare(df, con, name):
    """None when equal, otherwise what differs."""
    got = [tuple(r) for r in df.collect()]
    sql = contract.oracle_sql().get(name)
    if sql is None:
        return None if got or df.columns else "no rows"
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = cursor.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    a, b = rows_of(df.columns, got), rows_of(names, want)
    if not a:
        return "empty result"
    if a != b:
        only_a, only_b = sorted(set(a) - set(b)), sorted(set(b) - set(a))
        return f"rows {len(a)} / {len(b)}; spark only {only_a[:3]}; sql only {only_b[:3]}"
    return None


def connect(folder):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


if __name__ == "__main__":
    where = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session = make_session("check", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                           spark__driver__memory="12g", spark__ui__showConsoleProgress="false")
    session.sparkContext.setLogLevel("ERROR")
    wanted = sys.argv[2:] or list(contract.queries())
    bad = 0
    for q in wanted:
        begin = time.time()
        try:
            problem = compare(contract.queries()[q](session, where), connect(where), q)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        mark = "ok  " if problem is None else "FAIL"
        kind = "sql" if q in contract.oracle_sql() else "rows-only"
        print(f"{mark} {q} [{kind}] {time.time() - begin:.2f}s {problem or ''}", flush=True)
    print(f"{len(wanted) - bad}/{len(wanted)} ok")
