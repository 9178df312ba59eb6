"""Run registered queries against DuckDB on the same files.

python tests/compare.py [sf] [name-prefix ... | checked]
"""
from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(folder):
    con = duckdb.connect()
    con.sql("SET TimeZone='UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(v) + 0.0
    if hasattr(v, "asDict"):
        return plain(v.asDict())
    if isinstance(v, dict):
        return tuple(sorted((k, plain(x)) for k, x in v.items()))
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if hasattr(v, "as_tuple"):
        return float(v)
    if isinstance(v, int):
        return float(v) if abs(v) < 2 ** 53 else v
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(names), sorted(out, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def check(spark, con, folder, name, fn, sql):
    start = time.time()
    df = fn(spark, folder)
    got = df.collect()
    spent = time.time() - start
    left = rows_of(df.columns, got)
    if sql is None:
        return "rows", f"{len(got)} rows", spent
    res = con.execute(sql)
    right = rows_of([c[0] for c in res.description], res.fetchall())
    if left[0] != right[0]:
        return "FAIL", f"columns {left[0]} vs {right[0]}", spent
    if len(left[1]) != len(right[1]):
        return "FAIL", f"{len(left[1])} rows vs {len(right[1])}", spent
    bad = [(a, b) for a, b in zip(left[1], right[1]) if a != b]
    if bad:
        a, b = bad[0]
        diff = [(c, x, y) for c, x, y in zip(left[0], a, b) if x != y]
        return "FAIL", f"{len(bad)} of {len(left[1])} rows differ, e.g. {diff[:4]}", spent
    return "ok", f"{len(got)} rows", spent


if __name__ == "__main__":
    import __spark_entry__ as entry
    from tideline.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    wanted = sys.argv[2:]
    folder = f"/root/testdata/sf{sf}"
    spark, con = local_session(), duck(folder)
    checks, failed = entry.oracle_sql(), []
    total = 0.0
    for name, fn in entry.queries().items():
        if wanted == ["checked"]:
            if name not in checks:
                continue
        elif wanted and not any(name.startswith(w) for w in wanted):
            continue
        try:
            state, note, spent = check(spark, con, folder, name, fn, checks.get(name))
        except Exception as exc:  # report and go on with the next query
            state, note, spent = "FAIL", f"{type(exc).__name__}: {str(exc)[:700]}", 0.0
        total += spent
        if state == "FAIL":
            failed.append(name)
        print(f"{state:5s} {name:34s} {spent:6.2f}s {note}", flush=True)
    print(f"{len(failed)} failed {failed}; {total:.1f}s")
