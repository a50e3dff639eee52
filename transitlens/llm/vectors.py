"""Integer vectors: the common ground of the operators on embeddings.

A component ``x`` becomes ``floor(scale * x)`` with ``x`` as a double. Rows
whose vector is null or holds a null, NaN or infinite component are dropped.
Shorter vectors are filled with zeros to the longest one's length, which
changes neither distances nor products. Results are exact longs: components
are held within ``limit(width)``, the largest size at which no sum of squares
of differences leaves a long (67 million at 256 components).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transitlens.llm.common import written


def limit(width: int) -> int:
    return (1 << 30) // max(1, math.isqrt(max(width - 1, 0)) + 1)


def _finite(vector: Column) -> Column:
    def bad(x: Column) -> Column:
        d = x.cast("double")
        return d.isNull() | F.isnan(d) | (F.abs(d) == F.lit(float("inf")))

    return vector.isNotNull() & ~F.exists(vector, bad)


def integer_vectors(df: DataFrame, scale: int, keep: dict[str, Column], vector: str = "embedding",
                    multiple: int = 1) -> tuple[DataFrame, int]:
    """The kept rows as a stored table: the columns of ``keep`` and ``v`` (array<int>), all of one length, and that length.

    The length is rounded up to a multiple of ``multiple``.
    """
    v = F.col(vector)
    kept = df.where(_finite(v))
    width = kept.agg(F.max(F.size(v))).first()[0] or 0
    width = -(-width // multiple) * multiple
    top = limit(width)
    whole = F.transform(v, lambda x: F.greatest(F.lit(-top), F.least(
        F.lit(top), F.floor(x.cast("double") * F.lit(float(scale))))).cast("int"))
    filled = F.concat(whole, F.array_repeat(F.lit(0), F.lit(width) - F.size(v)))
    return written(kept.select(*[c.alias(n) for n, c in keep.items()], filled.alias("v")), "vectors"), width


def matrix(column: pa.ListArray | pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of a list column, all of length ``width``, as int64."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


def portions(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Batches joined and cut to at most ``rows`` rows, nearly all of that size."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, rows - n)
            held.append(part)
            n += part.num_rows
            batch = batch.slice(part.num_rows)
            if n == rows:
                yield pa.concat_batches(held)
                held, n = [], 0
    if n:
        yield pa.concat_batches(held)
