"""Local stand-in for the driver's correctness gate.

Runs each registered Spark query and its DuckDB oracle on the same parquet
tables and compares row count, column names and an order-insensitive value
digest. Usage: ``python tests/oracle_harness.py [sf_dir] [name ...]``.
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time

import duckdb
import numpy as np
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, (np.floating, float)):
        return round(float(v), 6)
    if isinstance(v, (np.integer,)):
        return int(v)
    if isinstance(v, (np.bool_,)):
        return bool(v)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, pd.Timestamp):
        v = v.to_pydatetime()
    if isinstance(v, dt.datetime):
        if v.tzinfo is not None:
            v = v.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return v.isoformat()
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    if isinstance(v, np.ndarray):
        return tuple(_norm(x) for x in v.tolist())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    if v is pd.NaT:
        return None
    return v


def digest(pdf: pd.DataFrame) -> tuple[int, list[str], str]:
    cols = sorted(pdf.columns)
    rows = [repr(tuple(_norm(r[c]) for c in cols)) for _, r in pdf.iterrows()]
    rows.sort()
    h = hashlib.sha256("\n".join(rows).encode()).hexdigest()
    return len(rows), cols, h


def compare(spark, sf_dir: str, names=None, verbose=True) -> dict:
    import __spark_entry__ as entry
    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    out = {}
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            spdf = qs[name](spark, sf_dir).toPandas()
        except Exception as e:  # noqa: BLE001
            out[name] = ("SPARK_ERROR", str(e)[:400])
            if verbose:
                print(f"{name:34s} SPARK_ERROR {str(e)[:300]}")
            continue
        ts = time.time() - t0
        if name not in sqls:
            out[name] = ("ROWS_ONLY", len(spdf))
            if verbose:
                print(f"{name:34s} rows-only {len(spdf)} rows  {ts:.1f}s")
            continue
        try:
            ddf = con.execute(sqls[name]).df()
        except Exception as e:  # noqa: BLE001
            out[name] = ("SQL_ERROR", str(e)[:400])
            if verbose:
                print(f"{name:34s} SQL_ERROR {str(e)[:300]}")
            continue
        a, b = digest(spdf), digest(ddf)
        ok = a == b
        out[name] = ("OK" if ok else "MISMATCH", a[0], b[0])
        if verbose:
            msg = "OK" if ok else f"MISMATCH spark={a[:2]} oracle={b[:2]}"
            print(f"{name:34s} {msg} rows={a[0]} {ts:.1f}s")
    return out


if __name__ == "__main__":
    from bundleflow.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = build_session()
    res = compare(spark, sf, names)
    bad = {k: v for k, v in res.items() if v[0] not in ("OK", "ROWS_ONLY")}
    print(f"{len(res) - len(bad)}/{len(res)} fine; failing: {sorted(bad)}")
