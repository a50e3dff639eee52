"""Exact order statistics by radix selection, without gathering a column in one task.

``percentile`` keeps every distinct value of a group in one buffer, so on a
whole large column it is unbounded. Here a double becomes a 64-bit whole number
of the same order (its own bits, negated below zero), and the number at a rank
is found 16 bits at a time, for all columns and ranks at once: a pass counts
the rows of each next prefix, inside the prefixes that hold a wanted rank, and
the rank falls into one of them. Counts merge before the shuffle, so a task
sends at most 65,536 of them for each open prefix, whatever its rows, and no
value is hot: rows with one value are one count. Four passes end every search;
a prefix whose rows are all equal ends it sooner. Only counts reach the driver.

Interpolated quantiles (linear, as pandas ``quantile`` and SQL
``quantile_cont``) use ranks floor(p), floor(p) + 1 of p = (n - 1) q. NaN counts
as missing, -0.0 as 0.0; infinite values take part.
"""

from __future__ import annotations

import math
import struct

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transitlens.functions.numeric import number

#: bits of a code that a pass narrows
STEP = 16
CODE_BITS = 64
# The layout of a double.
MANTISSA_BITS, EXPONENT_BIAS, INFINITE_EXPONENT = 52, 1023, 2047
SMALLEST, SMALLEST_NORMAL = 5e-324, 2.0 ** -1022

Target = tuple[str, int]


def with_codes(df: DataFrame, values: list[Column]) -> DataFrame:
    """Columns ``c0, c1, ...``: a long for each double, in the same order; null for null and NaN.

    The bits of the double's size, negated below zero. The exponent comes from
    the logarithm and one division by its power of two, which is exact; a
    logarithm rounded over a power of two shows in the quotient. Steps that
    are used more than once are columns of their own, so they are computed once.
    """
    k = range(len(values))
    x, size, near, part = ([F.col(f"{n}{i}") for i in k] for n in ("x", "size", "near", "part"))
    rows = df.select(*[v.alias(f"x{i}") for i, v in enumerate(values)])
    rows = rows.select(*x, *[F.abs(x[i]).alias(f"size{i}") for i in k])
    rows = rows.select(*x, *size, *[F.least(F.floor(F.log2(size[i])), F.lit(EXPONENT_BIAS)).alias(f"near{i}") for i in k])
    rows = rows.select(*x, *size, *near, *[(size[i] / F.pow(F.lit(2.0), near[i].cast("double"))).alias(f"part{i}") for i in k])

    def code(i: int) -> Column:
        def bits(exponent: Column, fraction: Column) -> Column:
            return (F.shiftleft(exponent + EXPONENT_BIAS, MANTISSA_BITS)
                    + ((fraction - 1) * F.lit(2.0 ** MANTISSA_BITS)).cast("long"))

        normal = (F.when(part[i] >= 2, bits(near[i] + 1, part[i] / 2)).when(part[i] < 1, bits(near[i] - 1, part[i] * 2))
                  .otherwise(bits(near[i], part[i])))
        of_size = (F.when(size[i] == float("inf"), F.lit(INFINITE_EXPONENT << MANTISSA_BITS))
                   .when(size[i] >= SMALLEST_NORMAL, normal)
                   .when(size[i] > 0, (size[i] / F.lit(SMALLEST)).cast("long"))
                   .otherwise(F.lit(0).cast("long")))
        return F.when(x[i].isNotNull() & ~F.isnan(x[i]), F.when(x[i] < 0, -of_size).otherwise(of_size)).alias(f"c{i}")

    return rows.select(*[code(i) for i in k])


def encoded(x: float) -> int:
    """The code of a double."""
    size = struct.unpack("<q", struct.pack("<d", abs(x)))[0]
    return -size if x < 0 else size


def decoded(code: int) -> float:
    """The double of a code."""
    size = struct.unpack("<d", struct.pack("<q", abs(code)))[0]
    return -size if code < 0 else size


def column_stats(df: DataFrame, cols) -> dict[str, tuple]:
    """(count, min, max) of the non-null, non-NaN values of each column, in one pass."""
    cols = list(cols)
    row = df.agg(*[a for i, c in enumerate(cols) for a in (
        F.count(number(c)).alias(f"n{i}"), F.min(number(c)).alias(f"mn{i}"), F.max(number(c)).alias(f"mx{i}"))]).first()
    return {c: (row[f"n{i}"], row[f"mn{i}"], row[f"mx{i}"]) for i, c in enumerate(cols)}


def prefix_counts(codes: DataFrame, inside: dict[int, tuple[int, int, set[int] | None]]) -> DataFrame:
    """``col, prefix, n, low, high``: rows and code range of each prefix ``code >> shift`` of the columns ``c<i>``.

    ``inside`` gives, for each column, the shift, and the shorter prefixes that
    count with their own shift (None: all rows). One pass over narrow rows for all columns.
    """
    cols = sorted(inside)
    prefixes = []
    for i in cols:
        c, (shift, outer, wanted) = F.col(f"c{i}"), inside[i]
        within = c.isNotNull() if wanted is None else F.shiftright(c, outer).isin(sorted(wanted))
        prefixes.append(F.when(within, F.shiftright(c, shift)).alias(f"p{i}"))
    rows = codes.select(*[f"c{i}" for i in cols], *prefixes)
    rows = rows.where(F.coalesce(*[F.col(f"p{i}") for i in cols]).isNotNull())
    names = [f"p{i}" for i in cols]
    which = F.grouping_id(*names) if len(cols) > 1 else F.lit(0).cast("long")
    grouped = rows.groupingSets([[n] for n in names], *names) if len(cols) > 1 else rows.groupBy(*names)
    counted = grouped.agg(which.alias("which"), F.count(F.lit(1)).alias("n"),
                          *[F.min(f"c{i}").alias(f"low{i}") for i in cols], *[F.max(f"c{i}").alias(f"high{i}") for i in cols])
    # a grouping set's number has a zero bit for its own column, the first column the highest one
    own = {(1 << len(cols)) - 1 - (1 << (len(cols) - 1 - k)): i for k, i in enumerate(cols)}

    def pick(stem: str) -> Column:
        if len(cols) == 1:
            return F.col(f"{stem}{cols[0]}")
        return F.coalesce(*[F.when(F.col("which") == w, F.col(f"{stem}{i}")) for w, i in own.items()])

    col = F.coalesce(*[F.when(F.col("which") == w, F.lit(i)) for w, i in own.items()])
    return counted.select(col.alias("col"), pick("p").alias("prefix"), "n", pick("low").alias("low"),
                          pick("high").alias("high")).where(F.col("prefix").isNotNull())


def kth_smallest_multi(df: DataFrame, targets: list[Target], stats: dict | None = None) -> dict[Target, float | None]:
    """Exact value at each 0-based rank among the non-null, non-NaN values of each column."""
    cols = sorted({c for c, _ in targets})
    codes = with_codes(df, [number(c) for c in cols])
    stats = stats if stats is not None and all(c in stats for c in cols) else column_stats(df, cols)
    out: dict[Target, float | None] = {}
    shifts: dict[int, int] = {}
    #: (column, prefix) -> its targets with their ranks among the prefix's rows
    open_at: dict[tuple[int, int | None], list[tuple[Target, int]]] = {}
    for t in set(targets):
        n, least, most = stats[t[0]]
        if n == 0 or t[1] >= n:
            out[t] = None
        elif least == most:
            out[t] = least + 0.0
        else:
            i = cols.index(t[0])
            # the bits above the first one in which the ends differ are the same in all rows
            varying = CODE_BITS if (least < 0) != (most < 0) else (encoded(least) ^ encoded(most)).bit_length()
            shifts[i] = max(0, varying - STEP)
            open_at.setdefault((i, None), []).append((t, t[1]))
    outer: dict[int, int] = {}
    while open_at:
        inside: dict[int, tuple[int, int, set[int] | None]] = {}
        for i, prefix in open_at:
            wanted = None if prefix is None else (inside[i][2] if i in inside else set()) | {prefix}
            inside[i] = (shifts[i], outer.get(i, CODE_BITS), wanted)
        found = prefix_counts(codes, inside).toArrow()
        col, prefix, n, low, high = (found[c].to_numpy() for c in ("col", "prefix", "n", "low", "high"))
        after: dict[tuple[int, int | None], list[tuple[Target, int]]] = {}
        for (i, parent), wanted in open_at.items():
            here = np.flatnonzero((col == i) if parent is None else (col == i) & (prefix >> (outer[i] - shifts[i]) == parent))
            here = here[np.argsort(prefix[here])]
            upto = np.cumsum(n[here])
            for t, rank in wanted:
                at = int(np.searchsorted(upto, rank, side="right"))
                k = here[at]
                if low[k] == high[k]:
                    out[t] = decoded(int(low[k]))
                else:
                    after.setdefault((i, int(prefix[k])), []).append((t, rank - int(upto[at] - n[k])))
        open_at = after
        for i in inside:
            outer[i], shifts[i] = shifts[i], max(0, shifts[i] - STEP)
    return out


def exact_quantiles_multi(df: DataFrame, cols, qs, stats: dict | None = None) -> dict[str, dict[float, float | None]]:
    """Linear-interpolation quantiles (pandas / ``quantile_cont``) of several columns.

    ``stats`` (from :func:`column_stats`) saves the counting pass when the
    caller has already aggregated the columns.
    """
    cols = list(cols)
    stats = stats if stats is not None and all(c in stats for c in cols) else column_stats(df, cols)
    targets, pos = [], {}
    for c in cols:
        n = stats[c][0]
        for q in qs:
            if n == 0:
                pos[(c, q)] = None
                continue
            p = (n - 1) * q
            lo = int(math.floor(p))
            hi = min(lo + 1, n - 1)
            pos[(c, q)] = (lo, hi, p - lo)
            targets += [(c, lo), (c, hi)]
    v = kth_smallest_multi(df, targets, stats) if targets else {}
    res: dict[str, dict] = {c: {} for c in cols}
    for (c, q), p in pos.items():
        if p is None:
            res[c][q] = None
            continue
        lo, hi, frac = p
        a, b = v[(c, lo)], v[(c, hi)]
        res[c][q] = a + (b - a) * frac if frac and a != b else a
    return res


def exact_quantiles(df: DataFrame, col: str, qs) -> dict[float, float | None]:
    return exact_quantiles_multi(df, [col], qs)[col]


def kth_smallest(df: DataFrame, col: str, ranks) -> dict[int, float | None]:
    got = kth_smallest_multi(df, [(col, r) for r in ranks])
    return {r: got[(col, r)] for r in ranks}
