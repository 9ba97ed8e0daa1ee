"""Run registered queries on Spark and their DuckDB oracles; compare the results.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Comparison: same column names, same row count, and equal values after sorting
rows (floats compared exactly after both sides are rounded by the model).
"""

from __future__ import annotations

import datetime
import math
import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tickwise.sources.tables import TABLES  # noqa: E402


def duck_connection(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None or v is pd.NA:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(v)
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, datetime.date):
        return datetime.datetime(v.year, v.month, v.day)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except (ValueError, AttributeError):
            pass
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def _rows(pdf: pd.DataFrame):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(v) for v in rec))
    out.sort(key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))
    return cols, out


def spark_rows(df):
    rows = df.collect()
    pdf = pd.DataFrame([r.asDict(recursive=True) for r in rows], columns=df.columns)
    return pdf


def compare(spark, sf_dir: str, names=None, verbose=True):
    here = os.getcwd()
    sys.path.insert(0, ROOT)
    import __spark_entry__ as E  # noqa: N812
    qs, oracle = E.queries(), E.oracle_sql()
    con = duck_connection(sf_dir)
    results = {}
    for name in (names or list(qs)):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir)
            s_pdf = spark_rows(sdf)
        except Exception as exc:  # noqa: BLE001
            results[name] = f"SPARK ERROR {type(exc).__name__}: {str(exc)[:300]}"
            if verbose:
                print(f"{name:32s} {results[name]}")
            continue
        if name not in oracle:
            results[name] = f"rows-only ({len(s_pdf)} rows)"
            if verbose:
                print(f"{name:32s} {results[name]}  {time.time()-t0:.1f}s")
            continue
        try:
            d_pdf = con.execute(oracle[name]).df()
        except Exception as exc:  # noqa: BLE001
            results[name] = f"DUCKDB ERROR {str(exc)[:300]}"
            if verbose:
                print(f"{name:32s} {results[name]}")
            continue
        scols, srows = _rows(s_pdf)
        dcols, drows = _rows(d_pdf)
        if scols != dcols:
            results[name] = f"COLUMNS differ spark={scols} duck={dcols}"
        elif len(srows) != len(drows):
            results[name] = f"ROWCOUNT spark={len(srows)} duck={len(drows)}"
        else:
            bad = [(a, b) for a, b in zip(srows, drows) if a != b]
            if bad:
                a, b = bad[0]
                diffs = [(c, x, y) for c, x, y in zip(scols, a, b) if x != y]
                results[name] = f"VALUES differ in {len(bad)} rows; first: {diffs[:4]}"
            else:
                results[name] = f"OK ({len(srows)} rows)"
        if verbose:
            print(f"{name:32s} {results[name]}  {time.time()-t0:.1f}s", flush=True)
    os.chdir(here)
    return results


if __name__ == "__main__":
    from tickwise.session import local_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = local_session(8)
    res = compare(spark, sf, names)
    bad = {k: v for k, v in res.items() if not (v.startswith("OK") or v.startswith("rows-only"))}
    print(f"\n{len(res) - len(bad)}/{len(res)} ok")
    sys.exit(1 if bad else 0)
