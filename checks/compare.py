"""Run a query and its SQL over the same tables and compare the rows."""

from __future__ import annotations

import os

import duckdb
import pandas as pd
from pyspark.sql import DataFrame

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck_rows(sql: str, sf_dir: str) -> pd.DataFrame:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con.execute(sql).df()


def ordered(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows[sorted(rows.columns)].astype(object).where(rows.notna(), None)
    keys = rows.map(lambda v: "" if v is None else f"{v!r}")
    return rows.loc[keys.sort_values(list(keys.columns)).index].reset_index(drop=True)


def difference(df: DataFrame, sql: str, sf_dir: str) -> str:
    """Empty when equal, else what differs."""
    got, want = df.toPandas(), duck_rows(sql, sf_dir)
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    types = {c: (str(got[c].dtype), str(want[c].dtype)) for c in got.columns
             if got[c].dtype != want[c].dtype and got[c].notna().all() and want[c].notna().all()}
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)} rows"
    a, b = ordered(got), ordered(want)
    for c in a.columns:
        bad = [(x, y) for x, y in zip(a[c], b[c]) if x != y]
        if bad:
            return f"column {c}: {len(bad)} differ, such as {bad[:3]}"
    return f"types {types}" if types else ""
