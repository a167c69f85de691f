"""Run registered queries next to their SQL: ``python -m tests.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os
import sys
import time

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    return v


def _sorted_rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(cols), sorted(plain, key=repr)


def rows_of_spark(df):
    return _sorted_rows(df.columns, [tuple(r) for r in df.collect()])


def rows_of_sql(con, sql):
    cur = con.execute(sql)
    return _sorted_rows([d[0] for d in cur.description], cur.fetchall())


def difference(left, right) -> str:
    """Empty when equal; else what differs first."""
    (lc, lr), (rc, rr) = left, right
    if lc != rc:
        return f"columns {lc} != {rc}"
    if len(lr) != len(rr):
        return f"rows {len(lr)} != {len(rr)}"
    kinds = {c: (type(a).__name__, type(b).__name__) for c, a, b in zip(lc, lr[0], rr[0])} if lr else {}
    mixed = {c: k for c, k in kinds.items() if k[0] != k[1] and "NoneType" not in k}
    if mixed:
        return f"types {mixed}"
    bad = [(a, b) for a, b in zip(lr, rr) if a != b]
    if not bad:
        return ""
    lost = list(set(lr) - set(rr))[:2]
    extra = list(set(rr) - set(lr))[:2]
    return f"{len(set(lr) - set(rr))} rows differ, e.g. {lost} != {extra}"


def main(argv):
    from gable.plans import QUERIES, SQL
    from gable.runtime import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.001"
    names = argv[1:] or list(QUERIES)
    spark = build_session("compare", "local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    wrong = 0
    for name in names:
        start = time.time()
        try:
            got = rows_of_spark(QUERIES[name].run(spark, sf_dir))
            spent = time.time() - start
            if name in SQL:
                start = time.time()
                problem = difference(got, rows_of_sql(con, SQL[name]))
                sql_spent = f"{time.time() - start:5.2f}"
            else:
                problem, sql_spent = ("" if got[1] else "no rows"), "  -  "
        except Exception as e:  # report and go on with the next query
            problem, spent, sql_spent = f"{type(e).__name__}: {str(e)[:900]}", time.time() - start, "  -  "
            got = ([], [])
        wrong += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name:28s} rows={len(got[1]):7d} spark={spent:6.2f}s sql={sql_spent}s {problem}", flush=True)
    print(f"{len(names) - wrong} of {len(names)} good")
    return 1 if wrong else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
