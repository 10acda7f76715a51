"""Spark-vs-DuckDB comparison used by the tests and by ``check_all``.

Rows are compared as an order-insensitive multiset over the columns sorted
by name; floats must be equal to 1e-9 (relative), everything else exactly.
"""

from __future__ import annotations

import math
import sys
import time

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _norm(v):
    if v is None or v is pd.NA:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (0, "")
        return (1, round(v, 9))
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (bool,)):
        return (2, int(v))
    if isinstance(v, int):
        return (1, float(v)) if abs(v) < 2 ** 53 else (3, v)
    return (4, str(v))


def rows(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = []
    for rec in df[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(None if (isinstance(v, float) and math.isnan(v)) else v) for v in rec))
    return sorted(out)


def compare(sp: pd.DataFrame, dk: pd.DataFrame) -> dict:
    res = {"rows_spark": len(sp), "rows_oracle": len(dk),
           "cols_match": sorted(sp.columns) == sorted(dk.columns)}
    if not res["cols_match"]:
        res["cols"] = (sorted(sp.columns), sorted(dk.columns))
        res["ok"] = False
        return res
    a, b = rows(sp), rows(dk)
    res["values_match"] = a == b
    if not res["values_match"]:
        sa, sb = set(a), set(b)
        res["only_spark"] = list(sa - sb)[:3]
        res["only_oracle"] = list(sb - sa)[:3]
    res["ok"] = res["values_match"] and len(sp) == len(dk)
    return res


def check_all(sf_dir: str, names: list[str] | None = None) -> dict:
    sys.path.insert(0, "/root/repo")
    from __spark_entry__ import oracle_sql, queries
    import os
    if os.environ.get("VIGIL_PLAIN_SESSION"):
        # the session a driver is likely to pass: none of vigil's settings
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[*]")
                 .config("spark.sql.shuffle.partitions", os.environ.get("VIGIL_PLAIN_PARTITIONS", "8"))
                 .getOrCreate())
        spark.sparkContext.setLogLevel("ERROR")
    else:
        from vigil.session import local_session
        spark = local_session(8)
    con = duck(sf_dir)
    qs, sql = queries(), oracle_sql()
    out = {}
    for name in names or list(qs):
        t0 = time.time()
        try:
            sp = qs[name](spark, sf_dir).toPandas()
            t1 = time.time()
            if name in sql:
                r = compare(sp, con.execute(sql[name]).df())
            else:
                r = {"rows_spark": len(sp), "ok": len(sp) > 0, "rows_only": True}
        except Exception as e:  # noqa: BLE001
            r = {"ok": False, "error": f"{type(e).__name__}: {str(e)[:400]}"}
            t1 = time.time()
        r["spark_sec"] = round(t1 - t0, 2)
        out[name] = r
        print(name, r, flush=True)
    return out


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2].split(",") if len(sys.argv) > 2 else None
    res = check_all(sf, names)
    bad = [k for k, v in res.items() if not v["ok"]]
    print("FAILED:", bad)
