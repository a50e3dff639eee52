"""Sorts and limits with explicit tie-breakers (results are deterministic)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _ties(tie):
    return [tie] if isinstance(tie, str) else list(tie or [])


def sort_groups_desc(df: DataFrame, col: str, tie=()) -> DataFrame:
    return df.orderBy(F.desc_nulls_last(col), *[F.asc(t) for t in _ties(tie)])


def top_k(df: DataFrame, col: str, k: int, tie=()) -> DataFrame:
    """The k rows with the largest ``col`` (TakeOrderedAndProject: no full sort)."""
    return sort_groups_desc(df, col, tie).limit(k)


def preview_rows(df: DataFrame, order, n: int = 10) -> DataFrame:
    return df.orderBy(*_ties(order)).limit(n)
