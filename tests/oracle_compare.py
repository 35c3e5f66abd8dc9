"""Compare queries with their SQL: python tests/oracle_compare.py [--sf DIR] [NAME...]"""

from __future__ import annotations

import math
import sys
import time
from datetime import datetime
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(norm(x) for x in v.values())
    if hasattr(v, "asDict"):
        return tuple(norm(x) for x in v)
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


def duck(sf: str):
    import duckdb

    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for p in Path(sf).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from read_parquet('{p if p.is_file() else f'{p}/*.parquet'}')")
    return con


def compare(spark, con, name: str, query, sql: str | None, sf: str) -> str:
    t = time.time()
    df = query(spark, sf)
    got = df.collect()
    took = time.time() - t
    if sql is None:
        return f"rows {len(got)} {took:.1f}s"
    res = con.execute(sql)
    cols, want = [d[0] for d in res.description], res.fetchall()
    if sorted(cols) != sorted(df.columns):
        return f"MISMATCH columns {sorted(df.columns)} {sorted(cols)}"
    a, b = rows_of(df.columns, got), rows_of(cols, want)
    if a == b:
        return f"equal {len(a)} {took:.1f}s"
    sa, sb = set(map(repr, a)), set(map(repr, b))
    return f"MISMATCH {len(a)} {len(b)}\n  only spark: {[x[:400] for x in list(sa - sb)[:3]]}\n  only sql:   {[x[:400] for x in list(sb - sa)[:3]]}"


if __name__ == "__main__":
    import __spark_entry__ as e

    from tarnlake.session import build_session

    args = sys.argv[1:]
    sf = "/root/testdata/sf0.01"
    if args[:1] == ["--sf"]:
        sf, args = args[1], args[2:]
    spark = build_session(master="local[8]", spark_sql_shuffle_partitions="8", spark_driver_memory="8g", spark_ui_enabled="false", spark_ui_showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con, qs, sqls = duck(sf), e.queries(), e.oracle_sql()
    for name in args or qs:
        try:
            print(name, compare(spark, con, name, qs[name], sqls.get(name), sf), flush=True)
        except Exception as x:
            print(name, "ERROR", str(x)[:1500], flush=True)
