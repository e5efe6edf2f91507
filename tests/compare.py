"""Run registered queries against their check SQL and report differences.

    python tests/compare.py [sf_dir] [name part ...]
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, bool):
        return ("b", value)
    if isinstance(value, dt.datetime):
        return ("t", value.replace(tzinfo=None).isoformat())
    if isinstance(value, dt.date):
        return ("d", value.isoformat())
    if isinstance(value, Decimal):
        return ("dec", float(value))
    if isinstance(value, float):
        return ("f", "nan" if math.isnan(value) else repr(value + 0.0))
    if isinstance(value, int):
        return ("i", value)
    if isinstance(value, (list, tuple)):
        return ("l", tuple(plain(v) for v in value))
    if isinstance(value, dict):
        return ("m", tuple(sorted((k, plain(v)) for k, v in value.items())))
    return ("s", value)


def difference(df, con, sql: str) -> str | None:
    """None when both sides agree in columns, row count and every value."""
    names = sorted(df.columns)
    at = [df.columns.index(c) for c in names]
    ours = sorted((tuple(plain(row[i]) for i in at) for row in df.collect()), key=repr)
    result = con.execute(sql)
    theirs_names = [d[0] for d in result.description]
    if sorted(theirs_names) != names:
        return f"columns {names} against {sorted(theirs_names)}"
    at = [theirs_names.index(c) for c in names]
    theirs = sorted((tuple(plain(row[i]) for i in at) for row in result.fetchall()), key=repr)
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b:
            bad = [(n, x, y) for n, x, y in zip(names, a, b) if x != y]
            return f"values differ: {bad[:4]}"
    return None


def main() -> int:
    import os

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from tallygrid.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con = local_session(8), connect(sf_dir)
    oracles, failed = entry.oracle_sql(), []
    for name, build in entry.queries().items():
        if sys.argv[2:] and not any(part in name for part in sys.argv[2:]):
            continue
        started = time.time()
        try:
            df = build(spark, sf_dir)
            if name in oracles:
                problem = difference(df, con, oracles[name])
            else:
                problem, rows = None, df.count()
                print(f"{name}: {rows} rows, no SQL")
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{name}: {problem or 'same'} ({time.time() - started:.1f}s)", flush=True)
        if problem:
            failed.append(name)
    print(f"{len(failed)} differ: {failed}")
    return bool(failed)


if __name__ == "__main__":
    sys.exit(main())
