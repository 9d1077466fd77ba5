"""Spark vs DuckDB comparison for every key that has oracle SQL.

Usage: python tests/oracle_check.py [sf_dir] [key ...]

Row count, column names, exact column types and an order-insensitive
multiset of normalised rows must match. Normalisation: decimals and floats to 6 decimals, dates
and timestamps to ISO text, everything else as text.
"""

from __future__ import annotations

import datetime as dt
import os
import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb  # noqa: E402

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (Decimal, float, int)):
        f = float(v)
        if f != f:
            return "nan"
        return f"{round(f, 6):.6f}"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(str(norm(x)) for x in v) + "]"
    return str(v)


def rows_multiset(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(norm(r[i]) for i in order) for r in rows)


SPARK_TO_DUCK = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN",
                 "date": "DATE", "timestamp": "TIMESTAMP"}


def type_problems(spark_schema, duck_description) -> list[str]:
    """Exact type agreement per column (decimal precision and scale included)."""
    duck_types = {d[0]: str(d[1]) for d in duck_description}
    problems = []
    for field in spark_schema.fields:
        s = field.dataType.simpleString()
        want = SPARK_TO_DUCK.get(s, s.upper())
        if duck_types.get(field.name) != want:
            problems.append(f"{field.name}: spark {s} vs duck {duck_types.get(field.name)}")
    return problems


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def compare(spark, con, key, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    cur = con.execute(sql)
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    t2 = time.time()
    problems = []
    types = type_problems(sdf.schema, cur.description)
    if types:
        problems.append("types " + "; ".join(types))
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns spark={s_cols} duck={d_cols}")
    if len(s_rows) != len(d_rows):
        problems.append(f"rows spark={len(s_rows)} duck={len(d_rows)}")
    if not problems:
        a, b = rows_multiset(s_cols, s_rows), rows_multiset(d_cols, d_rows)
        if a != b:
            only_s = list((a - b).elements())[:3]
            only_d = list((b - a).elements())[:3]
            problems.append(f"values differ ({sum((a - b).values())} rows) spark-only={only_s} duck-only={only_d}")
    status = "OK  " if not problems else "FAIL"
    print(f"{status} {key:30s} rows={len(s_rows):7d} spark={t1 - t0:5.1f}s duck={t2 - t1:5.1f}s "
          + "; ".join(problems), flush=True)
    return not problems


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    from hearthlake.session import build_session
    import __spark_entry__ as entry
    spark = build_session("local[8]", shuffle_partitions=8,
                          extra={"spark.driver.memory": os.environ.get("ORACLE_DRIVER_MEMORY", "4g")})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    ok = True
    for key, sql in sqls.items():
        if only and key not in only:
            continue
        try:
            ok &= compare(spark, con, key, qs[key], sql, sf_dir)
        except Exception as e:  # report and continue
            ok = False
            print(f"ERR  {key:30s} {type(e).__name__}: {str(e)[:800]}", flush=True)
    missing = [k for k in qs if k not in sqls]
    print("rows-only keys:", missing)
    return 0 if ok else 1


if __name__ == "__main__":
    sys.exit(main(sys.argv))
