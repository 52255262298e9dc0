"""Self-check of ``queries()`` against ``oracle_sql()`` in DuckDB, the way the
driver compares them: same column names, same row count, same multiset of
rows, doubles exactly (the queries and their SQL round alike; ORACLE_EXACT=0
compares 6 significant places).

Run directly: ``python tests/oracle.py [sf_dir] [name ...]``.
"""

from __future__ import annotations

import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


EXACT = os.environ.get("ORACLE_EXACT", "1") == "1"


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if EXACT else float(f"{v:.6g}")
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def compare(spark, con, name: str, fn, sql: str, sf_dir: str) -> tuple[bool, str]:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    d_rows = rel.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={s_cols} duck={d_cols}"
    order = [s_cols.index(c) for c in sorted(s_cols)]
    dorder = [d_cols.index(c) for c in sorted(d_cols)]
    a = sorted((tuple(_norm(r[i]) for i in order) for r in s_rows), key=_key)
    b = sorted((tuple(_norm(r[i]) for i in dorder) for r in d_rows), key=_key)
    if len(a) != len(b):
        return False, f"row count differs: spark={len(a)} duck={len(b)}"
    for x, y in zip(a, b):
        if x != y:
            return False, f"first differing row: spark={x} duck={y}"
    return True, f"{len(a)} rows, spark {t1 - t0:.2f}s"


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as entry
    from trackmart.session import build_session
    import tempfile
    spark = build_session(master="local[8]", shuffle_partitions=8,
                          extra_conf={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="tm-ckpt-"),
                                      "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or list(qs):
        if name not in sqls:
            print(f"{name:24s} NO ORACLE")
            continue
        try:
            ok, msg = compare(spark, con, name, qs[name], sqls[name], sf_dir)
        except Exception as e:  # report and go on
            ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(f"{name:24s} {'OK ' if ok else 'BAD'} {msg}", flush=True)
    print(f"{bad} mismatches")
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
