"""Run a Spark query and its DuckDB oracle on the same parquet tables and compare.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from riskgrid.sources.tables import TABLES  # noqa: E402


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.12g}")
    if hasattr(v, "isoformat"):
        return v.isoformat() if not hasattr(v, "hour") else v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "asDict"):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    try:
        import decimal
        if isinstance(v, decimal.Decimal):
            return float(f"{float(v):.12g}")
    except Exception:
        pass
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_names = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.sql(sql)
    d_names = res.columns
    d_rows = res.fetchall()
    t2 = time.time()
    ok_names = sorted(s_names) == sorted(d_names)
    a, b = rows_of(s_names, s_rows), rows_of(d_names, d_rows)
    same = ok_names and a == b
    detail = ""
    if not ok_names:
        detail = f"columns spark={sorted(s_names)} duck={sorted(d_names)}"
    elif len(a) != len(b):
        detail = f"rows spark={len(a)} duck={len(b)}"
    elif not same:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
        detail = f"first diffs: {diff}"
    return same, len(s_rows), t1 - t0, t2 - t1, detail


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    import __spark_entry__ as entry
    if os.environ.get("PLAIN_SESSION"):
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[*]")
                 .config("spark.sql.shuffle.partitions", "8").getOrCreate())
    else:
        from riskgrid.session import get_spark
        spark = get_spark("local[8]")
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if wanted and name not in wanted:
            continue
        if name not in sqls:
            t0 = time.time()
            n = fn(spark, sf_dir).count()
            print(f"ROWS  {name:28s} rows={n} spark={time.time() - t0:.2f}s")
            continue
        try:
            same, n, ts, td, detail = compare(spark, con, name, fn, sqls[name], sf_dir)
        except Exception as e:  # noqa: BLE001
            same, n, ts, td, detail = False, -1, 0, 0, f"ERROR {type(e).__name__}: {str(e)[:400]}"
        bad += not same
        print(f"{'OK  ' if same else 'FAIL'}  {name:28s} rows={n} spark={ts:.2f}s duck={td:.2f}s {detail}")
    print(f"failures: {bad}")


if __name__ == "__main__":
    main()
