"""Compare catalog queries with their SQL twins: python tools/check.py <folder> [names...]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb
import numpy as np
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def normal(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    keys = frame.map(lambda v: f"{v:.5g}" if isinstance(v, float) else repr(v))
    order = keys.sort_values(list(keys.columns)).index if len(frame.columns) else frame.index
    return frame.loc[order].reset_index(drop=True)


def compare(left: pd.DataFrame, right: pd.DataFrame) -> str:
    if sorted(left.columns) != sorted(right.columns):
        return f"COLUMNS {sorted(left.columns)} / {sorted(right.columns)}"
    if len(left) != len(right):
        return f"ROWS {len(left)} / {len(right)}"
    left, right = normal(left), normal(right)
    notes = []
    for name in left.columns:
        a, b = left[name], right[name]
        if str(a.dtype) != str(b.dtype):
            notes.append(f"dtype {name} {a.dtype}/{b.dtype}")
        if a.dtype.kind == "f" and b.dtype.kind == "f":
            same = (a == b) | (a.isna() & b.isna())
            if not np.isclose(a, b, rtol=1e-9, atol=1e-9, equal_nan=True).all():
                bad = ~np.isclose(a, b, rtol=1e-9, atol=1e-9, equal_nan=True)
                return f"VALUES {name}: {bad.sum()} e.g. {left[bad].head(2).to_dict('records')} / {right[bad].head(2).to_dict('records')}"
            if not same.all():
                notes.append(f"inexact {name} {(~same).sum()}")
        else:
            bad = ~((a == b) | (a.isna() & b.isna()))
            if bad.any():
                return f"VALUES {name}: {bad.sum()} e.g. {left[bad].head(2).to_dict('records')} / {right[bad].head(2).to_dict('records')}"
    return "ok " + "; ".join(notes)


def main() -> int:
    from presswork.catalog import load
    from presswork.session import local_session

    folder, names = sys.argv[1], sys.argv[2:]
    catalog = load()
    spark = local_session()
    con = connect(folder)
    failures = 0
    for name in names or catalog:
        entry = catalog[name]
        try:
            start = time.time()
            left = entry.run(spark, folder).toPandas()
            spent = time.time() - start
            if entry.sql is None:
                verdict, other = "rows only", 0.0
            else:
                start = time.time()
                right = con.execute(entry.sql).df()
                other = time.time() - start
                verdict = compare(left, right)
        except Exception as error:  # report and go on with the next query
            verdict, spent, other, left = f"ERROR {type(error).__name__} {str(error)[:700]}", 0.0, 0.0, []
        failures += not verdict.startswith(("ok", "rows"))
        print(f"{name:32s} {len(left):8d} spark {spent:6.2f} duckdb {other:6.2f}  {verdict[:900]}", flush=True)
    from presswork.plans.stage import clear

    clear(spark)
    return failures


if __name__ == "__main__":
    sys.exit(main())
