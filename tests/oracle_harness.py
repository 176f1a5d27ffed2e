"""Run catalog queries in Spark and their oracle SQL in DuckDB, compare.

Usage: python tests/oracle_harness.py [sf_dir] [key ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from aerowx.sources.fixtures import TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (1, repr(round(v, 6)))
    if hasattr(v, "isoformat"):
        import pandas as pd
        return (1, pd.Timestamp(v).isoformat(sep=" "))
    return (1, str(v))


def rows_of(df_pandas, cols):
    out = []
    for rec in df_pandas[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(None if (isinstance(x, float) and math.isnan(x) and False) else x)
                         for x in rec))
    return sorted(out)


def compare(spark, sf_dir: str, keys=None, verbose=True) -> dict:
    import __spark_entry__ as E
    qs, sql = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for k in (keys or list(qs)):
        t0 = time.time()
        try:
            sdf = qs[k](spark, sf_dir)
            spd = sdf.toPandas()
        except Exception as e:  # noqa: BLE001
            results[k] = ("SPARK-ERROR", str(e).splitlines()[0][:300])
            if verbose:
                print(k, results[k], flush=True)
            continue
        ts = time.time() - t0
        if k not in sql:
            results[k] = ("rows-only", len(spd))
            if verbose:
                print(f"{k}: rows-only {len(spd)} rows ({ts:.1f}s)", flush=True)
            continue
        try:
            dpd = con.execute(sql[k]).df()
        except Exception as e:  # noqa: BLE001
            results[k] = ("SQL-ERROR", str(e).splitlines()[0][:300])
            if verbose:
                print(k, results[k], flush=True)
            continue
        sc, dc = sorted(spd.columns), sorted(dpd.columns)
        if sc != dc:
            results[k] = ("COLUMNS", sorted(set(sc) ^ set(dc))[:10])
        elif len(spd) != len(dpd):
            results[k] = ("ROWCOUNT", len(spd), len(dpd))
        else:
            a, b = rows_of(spd, sc), rows_of(dpd, sc)
            if a == b:
                results[k] = ("OK", len(spd))
            else:
                diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
                results[k] = ("VALUES", len(spd), diff)
        if verbose:
            print(f"{k}: {results[k][0]} {results[k][1:]!s:.600} ({ts:.1f}s)", flush=True)
    return results


if __name__ == "__main__":
    from aerowx.session import get_spark
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    keys = sys.argv[2:] or None
    spark = get_spark(master="local[8]", shuffle_partitions=8,
                      conf={"spark.ui.showConsoleProgress": "false"})
    res = compare(spark, sf, keys)
    bad = {k: v for k, v in res.items() if v[0] not in ("OK", "rows-only")}
    print("SUMMARY ok=%d rows-only=%d bad=%d" % (
        sum(v[0] == "OK" for v in res.values()), sum(v[0] == "rows-only" for v in res.values()), len(bad)))
    for k, v in bad.items():
        print("BAD", k, str(v)[:400])
