"""Run registered queries against their SQL and report differences.

python tests/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry_module  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def tidy(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        held = df[c].dropna()
        # Spark's dates arrive as Python objects, DuckDB's as timestamps.
        if df[c].dtype == object and len(held) and held.map(lambda v: isinstance(v, datetime.date)).all():
            df[c] = pd.to_datetime(df[c])
    return df.sort_values(list(df.columns), na_position="first", kind="stable").reset_index(drop=True)


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    """None if both hold the same rows, else a short description."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} against {sorted(want.columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    got, want = tidy(got), tidy(want)
    for c in got.columns:
        if got[c].dtype.kind != want[c].dtype.kind:
            if not (got[c].isna().all() or want[c].isna().all()):
                return f"column {c}: type {got[c].dtype} against {want[c].dtype}"
        same = (got[c] == want[c]) | (got[c].isna() & want[c].isna())
        if not same.all():
            i = same.idxmin()
            return f"column {c}: {(~same).sum()} values differ, first {got.loc[i].to_dict()} against {want.loc[i].to_dict()}"
    return None


def main() -> int:
    from lexiloom.session import local_session

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = local_session(8)
    con = duck(sf_dir)
    queries, sql = entry_module.queries(), entry_module.oracle_sql()
    bad = 0
    for name in args or queries:
        t0 = time.time()
        try:
            got = queries[name](spark, sf_dir).toPandas()
            t1 = time.time()
            if name in sql:
                want = con.execute(sql[name]).fetchdf()
                note = difference(got, want) or "same"
            else:
                note = "rows only"
            print(f"{name:32s} {len(got):8d} rows {t1 - t0:6.2f}s {time.time() - t1:6.2f}s {note[:600]}", flush=True)
            bad += note not in ("same", "rows only")
        except Exception as error:  # report and go on
            bad += 1
            print(f"{name:32s} FAILED {str(error)[:900]}", flush=True)
    print("differences:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
