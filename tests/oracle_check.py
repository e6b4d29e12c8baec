"""Run a query key in Spark and its oracle in DuckDB; compare the results.

Comparison: same column names and types, same row count, same multiset of rows after
sorting columns by name (order-insensitive), floats compared exactly after
``repr``. Usable as a script: ``python tests/oracle_check.py [sf_dir] [keys]``.
"""

from __future__ import annotations

import math
import tempfile
import sys
import time

import duckdb

STAR_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "documents", "benchmark", "embeddings"]
DUCK_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
              "boolean": "BOOLEAN"}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in STAR_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "<null>"
    if isinstance(v, float):
        if math.isnan(v):
            return "<null>"
        return repr(float(v))
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, bool):
        return str(int(v))
    return str(v)


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in records)


def compare(spark, con, key, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_types = dict(sdf.dtypes)
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    con.execute(f"CREATE OR REPLACE VIEW oracle AS {sql}")  # as the checker registers it
    res = con.execute("SELECT * FROM oracle")
    d_cols = [d[0] for d in res.description]
    d_types = {d[0]: str(d[1]) for d in res.description}
    d_rows = res.fetchall()
    out = {"key": key, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "spark_sec": round(t1 - t0, 2)}
    if sorted(s_cols) != sorted(d_cols):
        out["ok"] = False
        out["why"] = f"columns {sorted(s_cols)} vs {sorted(d_cols)}"
        return out
    wrong = {c: (s_types[c], d_types[c]) for c in s_cols
             if DUCK_TYPES.get(s_types[c], s_types[c]) != d_types[c]}
    if wrong:
        out["ok"] = False
        out["why"] = f"types {wrong}"
        return out
    a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
    out["ok"] = a == b
    if not out["ok"]:
        sa, sb = set(a), set(b)
        out["why"] = f"only spark {list(sa - sb)[:3]} | only oracle {list(sb - sa)[:3]}"
    return out


def main(argv):
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from cinespark.session import build_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from cinespark.queries import QUERIES
    keys = argv[2:] or list(QUERIES)
    spark = build_session("local[8]", 8, extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="cinespark-check-")})
    con = duck(sf_dir)
    q, o = E.queries(), E.oracle_sql()
    bad = 0
    for k in keys:
        if k not in o:
            df = q[k](spark, sf_dir)
            print({"key": k, "rows": df.count(), "oracle": None}, flush=True)
            continue
        r = compare(spark, con, k, q[k], o[k], sf_dir)
        bad += not r["ok"]
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)


if __name__ == "__main__":
    main(sys.argv)
