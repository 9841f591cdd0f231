"""Runs queries beside their SQL and compares the rows: python tests/oracle.py DIR [NAME...]"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def views(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in sorted(os.listdir(sf_dir)):
        p = os.path.join(sf_dir, f)
        con.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{p + '/*.parquet' if os.path.isdir(p) else p}'")
    return con


def canon(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, (list, tuple)) or type(v).__name__ == "ndarray":
        return str([canon(x) for x in v])
    return str(v)


def compare(got, sql: str, con) -> str:
    """Empty where rows, columns and values agree."""
    cols = sorted(got.columns)
    rows = sorted(tuple(canon(r[c]) for c in cols) for r in got.collect())
    rel = con.sql(sql)
    if sorted(rel.columns) != cols:
        return f"columns {cols} and {sorted(rel.columns)}"
    at = [rel.columns.index(c) for c in cols]
    want = sorted(tuple(canon(r[i]) for i in at) for r in rel.fetchall())
    kinds = {c: t for c, t in got.dtypes}
    theirs = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    same = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}
    if odd := [(c, kinds[c], theirs[c]) for c in cols if kinds[c] in same and same[kinds[c]] != theirs[c]]:
        return f"types {odd}"
    if rows != want:
        a, b = [x for x in rows if x not in set(want)], [x for x in want if x not in set(rows)]
        return f"{len(rows)} and {len(want)} rows; only here {a[:2]}; only there {b[:2]}"
    return "" if rows else "both empty"


if __name__ == "__main__":
    import __spark_entry__ as entry
    from normspark.session import session

    spark = session("oracle", 8, spark__sql__shuffle__partitions="8")
    spark.sparkContext.setLogLevel("ERROR")
    con = views(sys.argv[1])
    q, o = entry.queries(), entry.oracle_sql()
    for name in sys.argv[2:] or q:
        t = time.time()
        try:
            said = compare(q[name](spark, sys.argv[1]), o[name], con) if name in o else f"no SQL, {q[name](spark, sys.argv[1]).count()} rows"
        except Exception as e:
            said = "ERROR " + str(e)[:600]
        print(f"{name}: {said or 'ok'} ({time.time() - t:.1f} s)", flush=True)
