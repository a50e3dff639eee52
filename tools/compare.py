"""Compare a Spark result with the reference SQL run in DuckDB (order-insensitive)."""

from __future__ import annotations

import math

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sql: str, sf_dir: str) -> pd.DataFrame:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con.execute(sql).fetchdf()


EXACT = False


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    try:
        if pd.isna(v):
            return None
    except (TypeError, ValueError):
        pass
    if hasattr(v, "isoformat"):
        return str(pd.Timestamp(v))
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if v == int(v) and abs(v) < 1e15:
            return int(v)
        return v if EXACT else float(f"{v:.12g}")
    if isinstance(v, bool):
        return int(v)
    return v


def rows(df: pd.DataFrame, cols) -> list[tuple]:
    return sorted((tuple(_norm(x) for x in r) for r in df[cols].astype(object).itertuples(index=False)), key=repr)


def compare(sdf, sql: str, sf_dir: str) -> tuple[bool, str]:
    a = sdf.toPandas()
    b = duck(sql, sf_dir)
    ca, cb = sorted(a.columns), sorted(b.columns)
    if ca != cb:
        return False, f"columns differ: spark={ca} sql={cb}"
    ra, rb = rows(a, ca), rows(b, ca)
    if len(ra) != len(rb):
        return False, f"row count spark={len(ra)} sql={len(rb)}"
    if ra != rb:
        sa, sb = set(ra), set(rb)
        return False, f"values differ ({len(sa - sb)} rows), e.g. spark={list(sa - sb)[:2]} sql={list(sb - sa)[:2]}"
    return True, f"{len(ra)} rows match"
