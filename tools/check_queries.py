"""Run registered queries in Spark and their SQL in DuckDB and compare the rows.

usage: check_queries.py [--sf DIR] [--only PREFIX_OR_NAME ...]
"""

from __future__ import annotations

import argparse
import sys
import time
from pathlib import Path

import duckdb
import numpy as np
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from betaloom import catalog  # noqa: E402
from betaloom.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for column in frame.columns:
        kind = frame[column].dtype.kind
        if kind in "iub":
            frame[column] = frame[column].astype(object)
        if kind == "f":
            frame[column] = frame[column].round(6) + 0.0
        frame[column] = frame[column].astype(object).where(frame[column].notna(), None)
        frame[column] = [
            "NULL" if v is None else f"{v:.6f}" if isinstance(v, (float, np.floating)) else str(v) for v in frame[column]
        ]
    return frame.sort_values(list(frame.columns), ignore_index=True)


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("--only", nargs="*")
    parser.add_argument("--verbose", action="store_true")
    args = parser.parse_args()

    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{args.sf}/{table}.parquet'")
    spark = local_session()
    bad = []
    for name, query in catalog.load().items():
        if args.only and not any(name == o or any(c == o or c[0] == o for c in query.covers.split()) for o in args.only):
            continue
        try:
            start = time.time()
            got = query.run(spark, args.sf)
            types = dict(got.dtypes)
            got = got.toPandas()
            took = time.time() - start
            if query.sql is None:
                print(f"rows {name}: {len(got)} rows, no SQL, {took:.2f}s", flush=True)
                continue
            start = time.time()
            want = db.execute(query.sql).df()
            sql_took = time.time() - start
            if sorted(got.columns) != sorted(want.columns):
                raise AssertionError(f"columns {sorted(got.columns)} vs {sorted(want.columns)}")
            left, right = canonical(got), canonical(want)
            if not left.equals(right):
                message = f"{len(left)} vs {len(right)} rows"
                if len(left) == len(right):
                    differs = (left != right).any(axis=1)
                    message += f", {differs.sum()} differ\n{left[differs].head(4)}\n{right[differs].head(4)}"
                elif args.verbose:
                    message += f"\n{left.head(5)}\n{right.head(5)}"
                raise AssertionError(message)
            note = "" if len(got) else "  EMPTY"
            print(f"ok   {name}: {len(got)} rows, {took:.2f}s (sql {sql_took:.2f}s){note}", flush=True)
            if args.verbose:
                print(types, want.dtypes.to_dict(), got.head(3), sep="\n")
        except Exception as error:  # noqa: BLE001
            bad.append(name)
            print(f"BAD  {name}: {str(error)[:1500]}", flush=True)
    print("failed:", bad)
    return bool(bad)


if __name__ == "__main__":
    sys.exit(main())
