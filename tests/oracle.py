"""Runs queries beside their SQL: ``python -m tests.oracle [--sf DIR] NAME...`` (none: all that have SQL)."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

ROOT = os.environ.get("TESTDATA", "/root/testdata")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for p in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM read_parquet('{p}')")
    return con


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "NaN" if v is not None else None
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if hasattr(v, "tzinfo"):
        return str(v.replace(tzinfo=None))
    return v


def rows(names: list[str], data: list) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


def compare(spark, sf_dir: str, query, sql: str) -> str:
    """'' if both give the same columns and rows."""
    df = query(spark, sf_dir)
    got = rows(df.columns, df.collect())
    cur = connect(sf_dir).execute(sql)
    names = [x[0] for x in cur.description]
    want = rows(names, cur.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    if got != want:
        a, b = set(map(repr, got)), set(map(repr, want))
        return f"{len(got)} and {len(want)} rows; only Spark: {sorted(a - b)[:3]}; only SQL: {sorted(b - a)[:3]}"
    return ""


if __name__ == "__main__":
    import __spark_entry__ as entry

    from annulet.session import local_session

    args = sys.argv[1:]
    size, args = (args[1], args[2:]) if args[:1] == ["--sf"] else ("sf0.01", args)
    sf = f"{ROOT}/{size}"
    spark = local_session()
    sql, bad = entry.oracle_sql(), 0
    for name in args or sorted(entry.queries()):
        t = time.time()
        try:
            if name in sql:
                why = compare(spark, sf, entry.queries()[name], sql[name])
            else:
                why = f"(no SQL) {entry.queries()[name](spark, sf).count()} rows"
        except Exception as e:  # noqa: BLE001
            why = f"{type(e).__name__}: {str(e)[:700]}"
        bad += bool(why) and not why.startswith("(no SQL)")
        print(f"{name}: {why or 'same'} ({time.time() - t:.1f} s)", flush=True)
    print("bad:", bad)
    os._exit(bool(bad))
