"""Run registered queries in Spark and their SQL in DuckDB and compare.

Comparison (order-insensitive): same column names, same row count, same
type family per column, and the same multiset of rows with columns sorted by
name. Usage: ``python tests/oracle_check.py [sf_dir] [name ...]``.
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

HERE = os.path.dirname(os.path.abspath(__file__))
ROOT = os.path.dirname(HERE)
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

STRICT = bool(os.environ.get("ORACLE_STRICT"))

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


def _family_spark(t: str) -> str:
    t = t.lower()
    if t in ("int", "integer", "smallint", "tinyint"):
        return "int32"
    if t in ("bigint", "long"):
        return "int64"
    if t in ("double", "float") or t.startswith("decimal"):
        return "float"
    if t in ("string",) or t.startswith("varchar"):
        return "str"
    if t == "boolean":
        return "bool"
    if t.startswith("timestamp"):
        return "timestamp"
    if t == "date":
        return "date"
    return t


def _family_duck(t: str) -> str:
    t = t.upper()
    if t in ("INTEGER", "SMALLINT", "TINYINT"):
        return "int32"
    if t in ("BIGINT",):
        return "int64"
    if t in ("DOUBLE", "FLOAT") or t.startswith("DECIMAL"):
        return "float"
    if t == "VARCHAR":
        return "str"
    if t == "BOOLEAN":
        return "bool"
    if t.startswith("TIMESTAMP"):
        return "timestamp"
    if t == "DATE":
        return "date"
    return t


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v if STRICT else round(v, 9)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def compare(spark, con, name: str, sf_dir: str, spark_fn, sql: str | None) -> dict:
    t0 = time.perf_counter()
    sdf = spark_fn(spark, sf_dir)
    s_schema = {f.name: _family_spark(f.dataType.simpleString()) for f in sdf.schema.fields}
    s_rows = [tuple(r) for r in sdf.collect()]
    t_spark = time.perf_counter() - t0
    out = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t_spark, 2)}
    if sql is None:
        out["status"] = "no-oracle"
        return out
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    d_types = {c: _family_duck(str(t)) for c, t in zip(d_cols, [d[1] for d in res.description])}
    out["oracle_rows"] = len(d_rows)
    s_cols = list(s_schema)
    if sorted(s_cols) != sorted(d_cols):
        out["status"] = "COLUMNS"
        out["detail"] = {"spark_only": sorted(set(s_cols) - set(d_cols)), "oracle_only": sorted(set(d_cols) - set(s_cols))}
        return out
    order = sorted(s_cols)
    type_diff = {c: (s_schema[c], d_types[c]) for c in order if s_schema[c] != d_types[c]}
    si = [s_cols.index(c) for c in order]
    di = [d_cols.index(c) for c in order]
    s_set = Counter(tuple(_norm(r[i]) for i in si) for r in s_rows)
    d_set = Counter(tuple(_norm(r[i]) for i in di) for r in d_rows)
    if len(s_rows) != len(d_rows):
        out["status"] = "ROWCOUNT"
    elif s_set != d_set:
        out["status"] = "VALUES"
        only_s = list((s_set - d_set).elements())[:3]
        only_d = list((d_set - s_set).elements())[:3]
        out["detail"] = {"cols": order, "spark_only": only_s, "oracle_only": only_d}
    else:
        out["status"] = "OK"
    if type_diff:
        out["types"] = type_diff
        if out["status"] == "OK":
            out["status"] = "TYPES"
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as E
    from blotter.plans.execution import build_session
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs = E.queries()
    sqls = E.oracle_sql()
    bad = 0
    for name in names or list(qs):
        try:
            r = compare(spark, con, name, sf_dir, qs[name], sqls.get(name))
        except Exception as e:  # report and continue
            r = {"name": name, "status": "ERROR", "detail": f"{type(e).__name__}: {str(e)[:600]}"}
        if r["status"] not in ("OK", "no-oracle"):
            bad += 1
        print(r, flush=True)
    print(f"# {bad} problems", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
