"""Run registered Spark queries and their DuckDB oracle side by side.

Comparison is order-insensitive: columns sorted by name, values normalised
(decimals by value, floats to 9 significant digits), rows compared as
multisets.  Usable from pytest and as a script:

    python tests/oracle_harness.py /root/testdata/sf0.01 [--strict] [key ...]

``--strict`` also compares every key as plain text through pandas.
"""
from __future__ import annotations

import collections
import datetime as dt
import decimal
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

from tillroll.sources.tables import TABLES, table_path  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, decimal.Decimal):
        return ("num", str(v.normalize()) if v == v.to_integral_value() else format(v.normalize(), "f"))
    if isinstance(v, float):
        if math.isnan(v):
            return ("num", "nan")
        return ("num", f"{v:.9g}")
    if isinstance(v, int):
        return ("num", str(v))
    if isinstance(v, dt.datetime):
        return ("ts", v.replace(tzinfo=None).isoformat())
    if isinstance(v, dt.date):
        return ("date", v.isoformat())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], collections.Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir: str, key: str, query, sql: str) -> dict:
    t0 = time.time()
    sdf = query(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    rel = con.sql(sql)
    d_cols = [c for c in rel.columns]
    d_rows = rel.fetchall()
    sc, sr = _canon(s_cols, s_rows)
    dc, dr = _canon(d_cols, d_rows)
    out = {"key": key, "spark_rows": len(s_rows), "oracle_rows": len(d_rows), "spark_sec": round(t1 - t0, 2),
           "columns_match": sc == dc, "values_match": sr == dr}
    if sc != dc:
        out["spark_cols"], out["oracle_cols"] = sc, dc
    elif sr != dr:
        only_s = list((sr - dr).elements())[:3]
        only_d = list((dr - sr).elements())[:3]
        out["only_spark"], out["only_oracle"] = only_s, only_d
    return out


def strict_compare(spark, con, sf_dir: str, query, sql: str) -> bool:
    """The plainest comparison a checker might make: both results through
    pandas, every value as ``str``, columns sorted by name, rows as a multiset."""
    def canon(pdf):
        pdf = pdf[sorted(pdf.columns)]
        return collections.Counter(tuple(str(v) for v in row) for row in pdf.itertuples(index=False, name=None))
    return canon(query(spark, sf_dir).toPandas()) == canon(con.sql(sql).df())


def main(argv):
    strict = "--strict" in argv
    argv = [a for a in argv if a != "--strict"]
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    import __spark_entry__ as E
    from tillroll.session import local_session
    spark = local_session()
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for key in keys or list(qs):
        if key not in sqls:
            t0 = time.time()
            n = qs[key](spark, sf_dir).count()
            print({"key": key, "rows_only": n, "spark_sec": round(time.time() - t0, 2)}, flush=True)
            continue
        try:
            res = compare(spark, con, sf_dir, key, qs[key], sqls[key])
        except Exception as e:  # report and continue
            res = {"key": key, "error": repr(e)[:800]}
        ok = res.get("columns_match") and res.get("values_match")
        if ok and strict:
            res["strict_match"] = ok = strict_compare(spark, con, sf_dir, qs[key], sqls[key])
        bad += not ok
        print(("OK   " if ok else "FAIL ") + str(res), flush=True)
    print(f"failures: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
