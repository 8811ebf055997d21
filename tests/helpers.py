"""Order-insensitive frame comparison shared by the tests."""

from __future__ import annotations

import math

import pandas as pd


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if hasattr(v, "tolist"):
        return norm(v.tolist())
    return v


def rows(pdf: pd.DataFrame) -> list:
    cols = sorted(pdf.columns)
    out = [tuple(norm(r[c]) for c in cols) for r in pdf.to_dict("records")]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def duck(sf_dir: str):
    import duckdb
    from brisa.plans.tables import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con
