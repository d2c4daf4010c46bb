"""Run queries in Spark and their SQL in DuckDB and compare whole results.

    python tests/oracle.py [sf] [query ...]
"""

import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
DATA = os.environ.get("TESTDATA", "/root/testdata")


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else ("f", round(v, 6) + 0.0)
    return (type(v).__name__, str(v)) if v is not None else None


def _rows(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def compare(spark, con, sf_dir, fn, sql):
    """None if equal, else what differs."""
    df = fn(spark, sf_dir)
    got, names = [tuple(r) for r in df.collect()], df.columns
    cur = con.execute(sql)
    wanted_names = [c[0] for c in cur.description]
    wanted = cur.fetchall()
    if sorted(names) != sorted(wanted_names):
        return f"columns {sorted(set(names) ^ set(wanted_names))}"
    if len(got) != len(wanted):
        return f"rows {len(got)} instead of {len(wanted)}"
    a, b = _rows(got, names), _rows(wanted, wanted_names)
    for x, y in zip(a, b):
        if x != y:
            return f"\n  columns {sorted(names)}\n  got    {x}\n  wanted {y}"
    return f"no rows" if not got else None


def main(argv):
    from flowtide.session import local_session
    from flowtide.workload.queries import ORACLE, QUERIES

    sf = argv[1] if len(argv) > 1 else "0.01"
    sf_dir = f"{DATA}/sf{sf}"
    spark, con = local_session(), connect(sf_dir)
    bad = 0
    for name in argv[2:] or QUERIES:
        t = time.time()
        try:
            if name in ORACLE:
                diff = compare(spark, con, sf_dir, QUERIES[name], ORACLE[name])
            else:
                diff = f"(no SQL) {QUERIES[name](spark, sf_dir).count()} rows"
        except Exception as e:
            diff = f"{type(e).__name__}: {str(e)[:400]}"
        bad += diff is not None
        print(f"{'ok  ' if diff is None else 'DIFF'} {time.time() - t:6.2f}s {name} {diff or ''}", flush=True)
    print(f"{bad} of {len(argv[2:] or QUERIES)} differ")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
