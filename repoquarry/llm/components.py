"""Connected components of a link table by alternating star contractions.

A round hangs the larger neighbours of every node, and then its smaller ones, on the
smallest node it knows. Rounds use only aggregates and joins, end in a checkpoint, and are few
(logarithmic in the size of a component). No component meets in one task: minima are
combined before the shuffle, and the joins are inner equi-joins that adaptive
execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

ROWS = 200_000  # a task takes at least so many narrow rows


def _hang(edges: DataFrame, smaller: bool) -> DataFrame:
    """(u, v) pairs with every v hung on the smallest node next to u, or on u."""
    if smaller:  # u > v: all smaller neighbours of u, and u itself
        lowest = edges.groupBy("u").agg(F.min("v").alias("m"))
        hung = edges.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return hung.unionByName(lowest.select("u", F.col("m").alias("v")))
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def compact(df: DataFrame) -> DataFrame:
    """``df`` checkpointed and read with a partition for every ``ROWS`` rows at most."""
    df = materialize(df)
    return df.coalesce(df.count() // ROWS + 1)


def connected(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): every linked node and the smallest node of its component. Links are longs."""

    def state(edges: DataFrame) -> tuple:
        return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    edges = materialize(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct())
    before = state(edges)
    while before[0]:
        parts = before[0] // ROWS + 1
        edges = edges.coalesce(parts)
        edges = materialize(_hang(_hang(edges, False), True).filter("u <> v").distinct().coalesce(parts))
        now = state(edges)
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return materialize(edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots))
