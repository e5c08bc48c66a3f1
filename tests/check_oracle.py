"""Run queries next to their DuckDB text: python tests/check_oracle.py [sf] [name prefix ...]."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry_points  # noqa: E402
from civicframe.session import local_session, stages  # noqa: E402


def duck(directory: str):
    con = duckdb.connect()
    for path in glob.glob(f"{directory}/*.parquet"):
        name = os.path.basename(path)[:-8]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if hasattr(value, "item"):
        value = value.item()
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple(str(v) for v in r))


def compare(df, con, text):
    cur = con.execute(text)
    duck_names = [c[0] for c in cur.description]
    expected = rows_of(duck_names, cur.fetchall())
    if sorted(df.columns) != sorted(duck_names):
        return f"columns {sorted(df.columns)} != {sorted(duck_names)}", 0
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if len(got) != len(expected):
        return f"rows {len(got)} != {len(expected)}\n   {got[:2]}\n   {expected[:2]}", len(got)
    bad = [(a, b) for a, b in zip(got, expected) if a != b]
    if bad:
        return f"{len(bad)}/{len(got)} rows differ, e.g.\n   {bad[0][0]}\n   {bad[0][1]}", len(got)
    kinds = [(a, b) for a, b in zip(got[:50], expected[:50])
             if [type(x) for x in a] != [type(x) for x in b]]
    if kinds:
        return f"types differ: {kinds[0]}", len(got)
    return None, len(got)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    prefixes = tuple(sys.argv[2:])
    directory = f"/root/testdata/sf{sf}"
    spark = local_session()
    con = duck(directory)
    queries, oracles = entry_points.queries(), entry_points.oracle_sql()
    failed = []
    for name, fn in queries.items():
        if prefixes and not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            with stages(spark):
                df = fn(spark, directory)
                if name in oracles:
                    problem, n = compare(df, con, oracles[name])
                else:
                    n = len(df.collect())
                    problem = None if n else "no rows"
        except Exception as error:  # report and go on
            text = str(error)
            cause = " | ".join(line for line in text.splitlines() if "Caused by" in line or "Exception:" in line)
            problem, n = f"{type(error).__name__}: {text[:300]} {cause[:600]}", -1
        kind = "sql " if name in oracles else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {kind} {name} rows={n} {time.time() - start:.2f}s"
              + (f"  {problem}" if problem else ""), flush=True)
        if problem:
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    code = main()
    sys.stdout.flush()
    os._exit(code)
