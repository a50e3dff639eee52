"""Size-checked broadcast of derived dimensions.

A dimension is broadcast only after it has been materialised to the shared
checkpoint folder and counted; above the row bound it is returned as-is and
the join falls back to a shuffle join (AQE splits skewed partitions there).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transitlens.config import DEFAULT_BROADCAST_ROWS, checkpoint_root


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint to the shared folder (survives executor loss)."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                      already_materialized: bool = False) -> tuple[DataFrame, int]:
    """Return ``(df', n_rows)`` where ``df'`` carries a broadcast hint iff n_rows <= max_rows."""
    m = df if already_materialized else materialize(df)
    n = m.count()
    return (F.broadcast(m) if n <= max_rows else m), n
