"""Run registered queries on Spark and their SQL on DuckDB and compare whole results.

    python tests/check_sql.py [name part ...] [--sf DIR]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def duck(sf: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.10g}")
    if isinstance(v, list):
        return tuple(plain(x) for x in v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, sf, query):
    """(Spark rows, difference text or None)."""
    df = query.run(spark, sf)
    got_cols, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    n = sum(got.values())
    if query.sql is None:
        return n, None
    cur = con.execute(query.sql)
    want_cols, want = rows_of([d[0] for d in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return n, f"columns {got_cols} / {want_cols}"
    if got != want:
        extra, missing = list((got - want).items())[:3], list((want - got).items())[:3]
        return n, f"{n} / {sum(want.values())} rows\n   spark only {extra}\n   sql only   {missing}"
    types = con.execute(f"DESCRIBE {query.sql}").fetchall()
    kinds = {"HUGEINT", "DECIMAL"}
    odd = [(t[0], t[1]) for t in types if t[1].split("(")[0] in kinds]
    return n, f"odd SQL types {odd}" if odd else None


if __name__ == "__main__":
    from tablefolio.plans.catalogue import load
    from tablefolio.session import local_session

    args = sys.argv[1:]
    sf = "/root/testdata/sf0.01"
    if "--sf" in args:
        sf = args[args.index("--sf") + 1]
        args = args[: args.index("--sf")]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(sf), 0
    for name, query in load().items():
        if args and not any(a in name for a in args):
            continue
        start = time.time()
        try:
            n, diff = compare(spark, con, sf, query)
        except Exception as e:  # report and go on with the next query
            n, diff = -1, f"{type(e).__name__}: {str(e)[:600]}"
        bad += diff is not None
        mark = "FAIL" if diff else ("ok  " if query.sql else "rows")
        print(f"{mark} {name:28s} rows={n:7d} {time.time() - start:6.2f}s {diff or ''}", flush=True)
    print("failures:", bad)
