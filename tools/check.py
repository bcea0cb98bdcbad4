"""Compare registered queries with their oracle SQL: python tools/check.py [sf] [key prefix ...]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb

from ledgerloom.catalog import collect
from ledgerloom.session import local_session
from ledgerloom.sources.tables import TABLES


def norm(v):
    if v is None:
        return "~null"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v + 0.0:.9g}"
    return f"{type(v).__name__}:{v}"


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


def compare(spark, con, root, key, fn, sql):
    t0 = time.time()
    df = fn(spark, root)
    got = [tuple(r) for r in df.collect()]
    took = time.time() - t0
    if sql is None:
        return ("rows-only", len(got), took, "")
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(names) != sorted(df.columns):
        return ("COLUMNS", len(got), took, f"{sorted(df.columns)} vs {sorted(names)}")
    a, b = rows_of(df.columns, got), rows_of(names, want)
    if a == b:
        return ("ok" if a else "ok-EMPTY", len(got), took, "")
    only_a = [x for x in a if x not in set(b)][:3]
    only_b = [x for x in b if x not in set(a)][:3]
    return ("DIFF", len(got), took, f"spark {len(a)} sql {len(b)}\n   spark {only_a}\n   sql   {only_b}")


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    wanted = sys.argv[2:]
    root = f"/root/testdata/sf{sf}"
    spark = local_session()
    spark.sparkContext.setLogLevel("OFF")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{root}/{t}.parquet'")
    queries, oracles = collect()
    bad = 0
    for key, fn in queries.items():
        if wanted and not any(key.startswith(w) for w in wanted):
            continue
        try:
            status, n, took, note = compare(spark, con, root, key, fn, oracles.get(key))
        except Exception as e:  # noqa: BLE001
            status, n, took, note = "ERROR", -1, 0.0, str(e)[:1500]
        bad += status not in ("ok", "rows-only")
        print(f"{status:10s} {key:28s} rows={n:<7d} {took:6.2f}s {note}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
