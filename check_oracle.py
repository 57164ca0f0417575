"""Run registered queries on Spark and their SQL oracle on DuckDB; compare.

Usage: python check_oracle.py [sf_dir] [key ...]
Compares column names, value kinds and order-insensitive row values (floats
to 1e-9 relative). Prints one line per key and a JSON summary at the end.
"""

from __future__ import annotations

import json
import math
import sys
import time

import duckdb
import pandas as pd

from attrition.plans.catalog import load_all
from attrition.session import get_spark

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _kind(s: pd.Series) -> str:
    k = s.dtype.kind
    if k in "iu":
        return "int"
    if k == "f":
        non_null = s.dropna()
        if len(non_null) and (non_null == non_null.round()).all() and s.isna().any():
            return "int?"
        return "float"
    if k == "b":
        return "bool"
    if k == "M":
        return "time"
    if k == "O":
        v = s.dropna()
        if len(v) and isinstance(v.iloc[0], bool):
            return "bool"
        if len(v) and isinstance(v.iloc[0], (int,)) and not isinstance(v.iloc[0], bool):
            return "int"
        return "str"
    return k


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(f"{v:.9g}")
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).value
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(df: pd.DataFrame):
    cols = sorted(df.columns)
    out = []
    for rec in df[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(x) for x in rec))
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x) for x in r))


def compare(sdf: pd.DataFrame, odf: pd.DataFrame) -> str:
    if sorted(sdf.columns) != sorted(odf.columns):
        return f"columns differ: spark={sorted(sdf.columns)} oracle={sorted(odf.columns)}"
    if len(sdf) != len(odf):
        return f"rows differ: spark={len(sdf)} oracle={len(odf)}"
    kinds = {c: (_kind(sdf[c]), _kind(odf[c])) for c in sdf.columns}
    bad = {c: k for c, k in kinds.items() if k[0] != k[1] and not ({k[0], k[1]} <= {"int", "int?", "float"} and len(sdf) == 0)}
    bad = {c: k for c, k in bad.items() if not ({*k} <= {"int", "int?"})}
    if bad:
        return f"kinds differ: {bad}"
    rs, ro = _rows(sdf), _rows(odf)
    for a, b in zip(rs, ro):
        if a != b:
            return f"values differ: spark={a} oracle={b}"
    return "ok"


def main(argv):
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    spark = get_spark("local[8]", 8)
    reg = load_all()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    results = {}
    for key, q in reg.items():
        if keys and key not in keys:
            continue
        t0 = time.time()
        try:
            sdf = q.fn(spark, sf).toPandas()
        except Exception as e:  # noqa: BLE001
            results[key] = f"spark error: {str(e)[:300]}"
            print(f"{key:28s} SPARK-ERROR {str(e)[:300]}", flush=True)
            continue
        t1 = time.time()
        if q.oracle is None:
            results[key] = f"rows-only ({len(sdf)} rows)"
            print(f"{key:28s} rows-only {len(sdf)} rows  spark {t1 - t0:.2f}s", flush=True)
            continue
        try:
            odf = con.execute(q.oracle).df()
        except Exception as e:  # noqa: BLE001
            results[key] = f"oracle error: {str(e)[:300]}"
            print(f"{key:28s} ORACLE-ERROR {str(e)[:300]}", flush=True)
            continue
        res = compare(sdf, odf)
        results[key] = res
        print(f"{key:28s} {res[:400]}  ({len(sdf)} rows, spark {t1 - t0:.2f}s)", flush=True)
    ok = sum(1 for v in results.values() if v == "ok")
    print(json.dumps({"ok": ok, "total": len(results),
                      "failing": {k: v for k, v in results.items() if v != "ok" and not v.startswith("rows-only")}}))


if __name__ == "__main__":
    main(sys.argv)
