"""Side-by-side check of a registered Spark query against its DuckDB oracle SQL.

Mirrors the driver's gate: row count, column names, and an order-insensitive hash of the
values (doubles are already rounded to 6 decimals on both sides).
"""

from __future__ import annotations

import hashlib
import math
import sys

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return c


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        r = round(v, 6) + 0.0
        return str(int(r)) if r.is_integer() else repr(r)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_norm(x)}" for k, x in sorted(v.items())) + "}"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    try:
        if float(v) == int(float(v)) and not isinstance(v, str):
            return str(int(v))
    except (TypeError, ValueError, OverflowError):
        pass
    return str(v)


def frame_hash(df: pd.DataFrame) -> tuple[int, list[str], str]:
    cols = sorted(df.columns)
    rows = sorted("|".join(_norm(r[c]) for c in cols) for r in df.to_dict("records"))
    h = hashlib.sha256("\n".join(rows).encode()).hexdigest()
    return len(rows), cols, h


def compare(spark, name: str, sf_dir: str, verbose: bool = True) -> bool:
    from candor.plans.registry import load_all

    q = load_all()[name]
    sdf = q.run(spark, sf_dir).toPandas()
    sql = q.oracle()
    if sql is None:
        if verbose:
            print(f"{name}: rows-only ({len(sdf)} rows)")
        return True
    odf = duck(sf_dir).execute(sql).df()
    a, b = frame_hash(sdf), frame_hash(odf)
    ok = a == b
    if verbose:
        print(f"{name}: spark rows={a[0]} oracle rows={b[0]} cols_equal={a[1] == b[1]} hash_equal={a[2] == b[2]}")
        if not ok:
            if a[1] != b[1]:
                print("  spark cols ", a[1])
                print("  oracle cols", b[1])
            else:
                cols = a[1]
                s1 = set("|".join(_norm(r[c]) for c in cols) for r in sdf.to_dict("records"))
                s2 = set("|".join(_norm(r[c]) for c in cols) for r in odf.to_dict("records"))
                print("  cols:", cols)
                for r in sorted(s1 - s2)[:3]:
                    print("  spark only :", r[:400])
                for r in sorted(s2 - s1)[:3]:
                    print("  oracle only:", r[:400])
    return ok


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from candor.plans.registry import load_all
    from candor.session import local_session

    sf = sys.argv[1]
    names = sys.argv[2:] or list(load_all())
    spark = local_session(8)
    bad = [n for n in names if not compare(spark, n, sf)]
    print("FAILED:", bad if bad else "none")
