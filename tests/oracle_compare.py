"""Run acceptance queries on Spark and their oracle SQL on DuckDB, compare.

Usage: python tests/oracle_compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT",
    "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
    "smallint": "SMALLINT", "tinyint": "TINYINT",
}


def duck_connection(sf_dir: str):
    from reelstack.plans.acceptance import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (1, f"{v:.9g}")
    return (1, str(v))


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, sf_dir: str, query, sql: str | None) -> dict:
    t0 = time.time()
    df = query(spark, sf_dir)
    spark_cols = df.columns
    spark_types = [SPARK_TO_DUCK.get(t, t) for _, t in df.dtypes]
    spark_rows = [tuple(r) for r in df.collect()]
    secs = time.time() - t0
    out = {"name": name, "spark_rows": len(spark_rows), "secs": round(secs, 2)}
    if sql is None:
        out["status"] = "rows-only"
        return out
    rel = con.execute(sql)
    duck_cols = [d[0] for d in rel.description]
    duck_rows = rel.fetchall()
    duck_types = [str(t) for t in con.execute(f"DESCRIBE {sql}").fetchall() and
                  [r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()]]
    out["oracle_rows"] = len(duck_rows)
    problems = []
    if sorted(spark_cols) != sorted(duck_cols):
        problems.append(f"columns {sorted(spark_cols)} != {sorted(duck_cols)}")
    else:
        st = dict(zip(spark_cols, spark_types))
        dt = dict(zip(duck_cols, duck_types))
        bad = {c: (st[c], dt[c]) for c in st if st[c] != dt[c]}
        if bad:
            problems.append(f"types {bad}")
    if len(spark_rows) != len(duck_rows):
        problems.append(f"rows {len(spark_rows)} != {len(duck_rows)}")
    elif not problems and canonical(spark_cols, spark_rows) != canonical(duck_cols, duck_rows):
        a = canonical(spark_cols, spark_rows)
        b = canonical(duck_cols, duck_rows)
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        problems.append(f"values differ, e.g. {diff}")
    out["status"] = "match" if not problems else "MISMATCH: " + "; ".join(problems)
    return out


def main(argv):
    from reelstack.plans.acceptance import QUERIES
    from reelstack.plans.oracle import ORACLE_SQL
    from reelstack.session import build_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(QUERIES)
    spark = build_session("local[8]", 8)
    con = duck_connection(sf_dir)
    bad = 0
    for name in names:
        try:
            res = compare(spark, con, name, sf_dir, QUERIES[name], ORACLE_SQL.get(name))
        except Exception as exc:  # report and continue
            res = {"name": name, "status": f"ERROR {type(exc).__name__}: {str(exc)[:300]}"}
        bad += not (res["status"] in ("match", "rows-only"))
        print(res, flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
