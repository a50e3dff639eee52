"""Connected components of an edge table, by alternating large and small stars.

Every round is two grouped minima and two joins over the edges; nothing is
collected. Rounds end when a large star finds that every node has either
larger neighbours only or a single, smaller one: all edges lead to the
smallest node of their component then. So the last round costs its large star
alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from transitlens.llm.common import by_shuffle_beyond, discard, written, written_counted


def _pairs(df: DataFrame, *names: tuple[str, str]) -> DataFrame:
    """Edges ``u, v`` from several pairs of columns of each row, which is computed once."""
    return df.select(F.inline(F.array(*[F.struct(F.col(a).alias("u"), F.col(b).alias("v")) for a, b in names])))


def _with_least(edges: DataFrame, rows: int) -> DataFrame:
    """Edges ``u, v`` with ``m``, the smallest of ``u`` and all its ``v``.

    The minimum merges before the shuffle; the join back has one row per ``u``
    on one side, so a node with very many edges is split by the skew join.
    """
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return edges.join(by_shuffle_beyond(least, rows), "u")


def _large_star(edges: DataFrame, seen: Observation | None = None, rows: int = 0) -> DataFrame:
    """Each larger neighbour of a node linked to the smallest of that node and its neighbours.

    ``rows`` bounds the edges, here and in the small star; neither makes them more.
    ``seen`` gets ``open``, how many nodes have a smaller neighbour and another
    one: none if the edges are stars around their smallest nodes. Repeated edges
    don't count, and a task that runs again leaves none at none.
    """
    both = _pairs(edges, ("u", "v"), ("v", "u"))
    ends = both.groupBy("u").agg(F.min("v").alias("a"), F.max("v").alias("b"))
    if seen is not None:
        ends = ends.observe(seen, F.count_if((F.col("a") < F.col("u")) & (F.col("a") < F.col("b"))).alias("open"))
    # repeated edges are no more than the edges read; the small star drops them
    return (ends.select("u", F.least("u", "a").alias("m")).join(by_shuffle_beyond(both, 2 * rows), "u").where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(edges: DataFrame, rows: int = 0) -> DataFrame:
    down = edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    starred = _with_least(down, rows)
    return _pairs(starred, ("u", "m"), ("v", "m")).where("u != v").distinct()


def stars(edges: DataFrame) -> DataFrame:
    """``u, v``, stored: every node with an edge but its component's smallest, once, and that smallest node."""
    down = edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges, n = written_counted(down, "edges")
    while n:
        # stored between the stars: the small one reads it twice, and would compute the large one each time
        seen = Observation()
        larger = written(_large_star(edges, seen, n), "larger")
        if not seen.get["open"]:
            discard(larger)
            break
        after = written(_small_star(larger, n), "edges")
        discard(larger)
        discard(edges)
        edges = after
    return edges


def roots(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node with an edge; ``root`` is its component's smallest node."""
    found = stars(edges)
    named = found.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return named.unionByName(found.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
