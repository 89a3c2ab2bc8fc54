"""Run a registered query on Spark and its SQL on DuckDB and compare the rows."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def duck(folder: str):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def canon(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)

    def cell(v):
        if v is None or v is pd.NaT or v is pd.NA:
            return ""
        if hasattr(v, "tolist"):
            v = v.tolist()
        if isinstance(v, bool):
            return str(v)
        if isinstance(v, (int, float)):
            if v != v:
                return ""
            return f"{float(v):.6g}" if isinstance(v, float) and not float(v).is_integer() else str(int(v)) if abs(v) < 1e300 else str(v)
        return str(v)

    return sorted(tuple(cell(v) for v in row) for row in pdf[cols].itertuples(index=False))


def main(names: list[str], folder: str = "/root/testdata/sf0.01") -> int:
    import __spark_entry__ as entry
    from tests.conftest import make_session

    spark = make_session()
    con = duck(folder)
    queries, oracles = entry.queries(), entry.oracle_sql()
    picked = [q for q in queries if not names or any(q.startswith(n) for n in names)]
    bad = 0
    for q in picked:
        try:
            t0 = time.time()
            got = queries[q](spark, folder).toPandas()
            t1 = time.time()
        except Exception as exc:  # report and go on
            bad += 1
            print(f"ERR   {q}: {str(exc)[:700]}")
            continue
        if q not in oracles:
            print(f"rows  {q}: {len(got)} in {t1 - t0:.1f}s")
            continue
        try:
            want = con.execute(oracles[q]).fetchdf()
        except Exception as exc:
            bad += 1
            print(f"ORERR {q}: {str(exc)[:500]}")
            continue
        if sorted(got.columns) != sorted(want.columns):
            bad += 1
            print(f"COLS  {q}: {sorted(got.columns)} vs {sorted(want.columns)}")
            continue
        a, b = canon(got), canon(want)
        kinds = {c: (got[c].dtype.kind, want[c].dtype.kind) for c in got.columns if got[c].dtype.kind != want[c].dtype.kind}
        if a == b:
            note = f" kinds {kinds}" if kinds else ""
            empty = " EMPTY" if not a else ""
            print(f"ok    {q}: {len(a)} rows spark {t1 - t0:.1f}s duck {time.time() - t1:.1f}s{note}{empty}")
        else:
            bad += 1
            da = [x for x in a if x not in set(b)][:3]
            db = [x for x in b if x not in set(a)][:3]
            print(f"DIFF  {q}: {len(a)} vs {len(b)}\n   cols {sorted(got.columns)}\n   spark {da}\n   duck  {db}")
    print(f"{len(picked)} queries, {bad} bad")
    return bad


if __name__ == "__main__":
    args = sys.argv[1:]
    folder = "/root/testdata/sf0.01"
    if args and args[0].startswith("/"):
        folder = args.pop(0)
    sys.exit(1 if main(args, folder) else 0)
