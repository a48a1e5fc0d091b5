"""Run named queries on Spark and their SQL on DuckDB, and compare the rows.

    python tests/oracle.py [folder] [name or prefix ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time
import traceback

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

NAMES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
         "labels conversations").split()


EXACT = bool(os.environ.get("ORACLE_EXACT"))  # compare doubles to the last bit


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return (v if EXACT else float(f"{v:.10g}")) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def duck(folder):
    con = duckdb.connect()
    for n in NAMES:
        con.execute(f"CREATE VIEW {n} AS SELECT * FROM '{folder}/{n}.parquet'")
    return con


def compare(spark, con, folder, run, sql):
    """None when both agree, else a short reason."""
    df = run(spark, folder)
    left = [tuple(r) for r in df.collect()]
    if sql is None:
        return None if left else "no rows"
    res = con.execute(sql)
    cols = [d[0] for d in res.description]
    right = res.fetchall()
    if sorted(df.columns) != sorted(cols):
        return f"columns {sorted(set(df.columns) ^ set(cols))}"
    a, b = normal(left, df.columns), normal(right, cols)
    if len(a) != len(b):
        return f"rows {len(a)} vs {len(b)}"
    for x, y in zip(a, b):
        if x != y:
            names = sorted(cols)
            return "values " + "; ".join(f"{n}: {p!r} vs {q!r}" for n, p, q in zip(names, x, y) if p != q)
        if [type(p) for p in x] != [type(q) for q in y]:
            return f"types {[(n, type(p), type(q)) for n, p, q in zip(sorted(cols), x, y) if type(p) is not type(q)]}"
    return None if a else "empty"


def main(argv):
    from tidemark.registry.catalog import QUERIES, SQL
    from tidemark.session import build_session
    folder = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session("oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(folder), 0
    for name, run in QUERIES.items():
        if argv[1:] and not any(name.startswith(p) for p in argv[1:]):
            continue
        start = time.time()
        try:
            why = compare(spark, con, folder, run, SQL.get(name))
        except Exception as e:  # report and go on with the next query
            why = f"{type(e).__name__}: {str(e).strip()[:600]}"
            if "-v" in argv:
                traceback.print_exc()
        bad += why is not None
        print(f"{'ok ' if why is None else 'BAD'} {name} {time.time() - start:.1f}s {'' if name in SQL else '(no sql) '}{why or ''}", flush=True)
    print(f"{bad} bad")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
