"""Running totals and ranks over one huge ordered group, without sorting the group in one task.

A plain window over ``partitionBy(group)`` sorts a whole group in a single task. Here the order column is cut into
value ranges, each (group, range) is summed locally, and the small table of range totals supplies the offsets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabwright.functions.columns import quoted

MAX_RANGES = 4096
ROWS_PER_RANGE = 250_000
SKETCH_ACCURACY = 20_000
#: Edges that are compared in one expression.
TREE_EDGES = 64


def range_edges(df: DataFrame, column: str, rows_per_range: int = ROWS_PER_RANGE) -> list[float]:
    """Cut points that split the column into ranges of about ``rows_per_range`` rows."""
    df = df.where(quoted(column).isNotNull() & ~F.isnan(quoted(column).cast("double")))
    rows = df.agg(F.count(quoted(column)).alias("n")).first().n
    ranges = min(MAX_RANGES, -(-rows // rows_per_range))
    if ranges <= 1:
        return []
    probs = [i / ranges for i in range(1, ranges)]
    cuts = df.agg(F.percentile_approx(quoted(column).cast("double"), probs, SKETCH_ACCURACY).alias("cuts")).first().cuts
    return sorted(set(cuts))


def with_range(df: DataFrame, column: str, edges: Sequence[float], name: str = "__range") -> DataFrame:
    """Number of the value range each row falls into; equal values always share a range."""
    value = quoted(column).cast("double")

    def below(low: int, high: int) -> Column:
        """The number of edges at or below the value, which lies between low and high: a tree of comparisons."""
        if low == high:
            return F.lit(float(low))
        middle = (low + high) // 2
        return F.when(value < F.lit(edges[middle]), below(low, middle)).otherwise(below(middle + 1, high))

    if len(edges) > TREE_EDGES:
        # the same numbers in two steps: which group of edges, then how many inside it
        groups = [edges[i : i + TREE_EDGES] for i in range(0, len(edges), TREE_EDGES)]
        mine = F.size(F.filter(F.array(*[F.lit(g[0]) for g in groups]), lambda e: e <= value))
        inside = F.get(F.array(*[F.array(*[F.lit(e) for e in g]) for g in groups]), F.greatest(mine - 1, F.lit(0)))
        number = (F.greatest(mine - 1, F.lit(0)) * TREE_EDGES + F.size(F.filter(inside, lambda e: e <= value))).cast("double")
        return df.withColumn(name, number)
    return df.withColumn(name, below(0, len(edges)))


def running_totals(
    df: DataFrame,
    group: Sequence[str],
    order: str,
    sums: Sequence[str],
    edges: Sequence[float],
    descending: bool = False,
) -> DataFrame:
    """Add, for every name in ``sums``, ``cum_<name>`` (the total up to and including the row) and ``all_<name>``.

    Totals are per group; ``df`` must hold one row per (group, order value). Rows without an order value (NULL or NaN)
    are left out.
    """
    df = df.where(quoted(order).isNotNull() & ~F.isnan(quoted(order).cast("double")))
    ranged = with_range(df, order, edges)
    direction = (lambda c: c.desc()) if descending else (lambda c: c.asc())
    totals = ranged.groupBy(*group, "__range").agg(*[F.sum(s).alias(f"__t_{s}") for s in sums])
    # one row per (group, range): at most MAX_RANGES rows in a window; with many groups the join below goes by the same
    # keys as the window after it, so it needs no further shuffle, and adaptive execution broadcasts what is small
    earlier = W.partitionBy(*group).orderBy(direction(F.col("__range"))).rowsBetween(W.unboundedPreceding, -1)
    before = [F.coalesce(F.sum(f"__t_{s}").over(earlier), F.lit(0)).alias(f"__o_{s}") for s in sums]
    whole = [F.sum(f"__t_{s}").over(W.partitionBy(*group)).alias(f"all_{s}") for s in sums]
    offsets = totals.select(*group, "__range", *before, *whole)
    local = W.partitionBy(*group, "__range").orderBy(direction(F.col(order))).rowsBetween(W.unboundedPreceding, 0)
    joined = ranged.join(offsets, [*group, "__range"])
    running = [(F.sum(s).over(local) + F.col(f"__o_{s}")).alias(f"cum_{s}") for s in sums]
    return joined.select(*df.columns, *running, *[f"all_{s}" for s in sums])
