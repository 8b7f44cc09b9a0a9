"""Joins that hold when one key owns a large share of the rows."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import BROADCAST_ROWS

HOT_KEYS = 1000
HOT_ROWS = 10_000
FAN_OUT = 64


def key_weights(facts: DataFrame, on: Sequence[str]) -> DataFrame:
    """How many facts have each key; one map-side combined count over the key columns."""
    return facts.where(F.col(on[0]).isNotNull()).groupBy(*on).agg(F.count("*").alias("weight"))


def lookup_join(
    facts: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    spread_by: Sequence[str],
    how: str = "left",
    weights: DataFrame | None = None,
    hot_keys: int = HOT_KEYS,
    hot_rows: int = HOT_ROWS,
    fan_out: int = FAN_OUT,
) -> DataFrame:
    """Join facts to a table that is unique on ``on``, hot keys spread over tasks.

    ``weights`` (the key columns and ``weight``) says how many facts have each key; it
    is counted when not given. Keys above ``1 / hot_keys`` of the total are fewer than
    ``hot_keys``, so that list may be broadcast whatever the data size. Only their
    rows in ``dim`` are repeated ``fan_out`` times, and their facts take one of the
    copies by a hash of ``spread_by``. ``how`` keeps the facts on the left.
    """
    on = list(on)
    weights = key_weights(facts, on) if weights is None else weights
    # a key with few facts is never hot, however small the table
    bar = weights.select(F.greatest(F.sum("weight") / hot_keys, F.lit(hot_rows))).scalar()
    hot = F.broadcast(weights.where(F.col("weight") > bar).select(*on, F.lit(fan_out).alias("__copies")))
    # null keys find no partner, so they may go anywhere
    spread = F.col("__copies").isNotNull() | F.col(on[0]).isNull()
    slot = F.pmod(F.xxhash64(*spread_by), F.lit(fan_out)).cast("int")
    salted = facts.join(hot, on, "left").withColumn("__salt", F.when(spread, slot).otherwise(0)).drop("__copies")
    copies = (
        dim.join(hot, on, "left")
        .withColumn("__salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("__copies"), F.lit(1)) - 1)))
        .drop("__copies")
    )
    return salted.join(copies, [*on, "__salt"], how).drop("__salt")


def frequent_bar(weights: DataFrame, most: int = BROADCAST_ROWS) -> int:
    """Least power of 2 ** (1 / 8), rounded up, that at most ``most`` keys reach with their ``weight``."""
    step = F.floor(F.log2(F.col("weight").cast("double")) * 8).cast("int")
    held = weights.where(F.col("weight") > 0).groupBy(step.alias("step")).agg(F.count("*").alias("n"))
    sizes = {row["step"]: row["n"] for row in held.collect()}  # a row for each step, 504 at most
    total, bar = 0, max(sizes, default=0) + 1
    for at in sorted(sizes, reverse=True):
        total += sizes[at]
        if total > most:
            break
        bar = at
    return math.ceil(2 ** (bar / 8) - 1e-9)


def frequent_join(facts: DataFrame, dim: DataFrame, on: str, how: str = "left", most: int = BROADCAST_ROWS) -> DataFrame:
    """Join facts to a table that is unique on ``on``: its most frequent keys are broadcast, only facts of others are shuffled.

    ``dim`` holds in ``weight`` about how many facts have a key, and is materialized, since it is read several times.
    Facts are read twice. ``how`` is left or inner.
    """
    bar = frequent_bar(dim, most)
    near = dim.where(F.col("weight") >= bar).drop("weight").withColumn("__near", F.lit(True))
    known = facts.join(F.broadcast(near), on, "left")
    # null keys find no partner and stay where they are
    known = known.where(F.col("__near") | (F.col(on).isNull() if how == "left" else F.lit(False))).drop("__near")
    others = facts.where(F.col(on).isNotNull()).join(F.broadcast(near.select(on)), on, "left_anti")
    far = dim.where(F.col(on).isNotNull() & ~F.coalesce(F.col("weight") >= bar, F.lit(False))).drop("weight")
    return known.unionByName(others.join(far, on, how))


def linked_runs(commits: DataFrame, runs: DataFrame) -> DataFrame:
    """CI runs with the commit they ran on (``sha`` = ``commit_hash``)."""
    sides = commits.withColumnRenamed("commit_hash", "sha")
    return lookup_join(runs.where(F.col("sha").isNotNull()), sides, ["sha"], ["pipeline_id"], "inner")


def orphan_parents(parents: DataFrame, commits: DataFrame) -> DataFrame:
    """Parent hashes that name no commit, with the number of links to each."""
    links = parents.groupBy("parent_hash").agg(F.count("*").alias("links"))
    known = commits.select(F.col("commit_hash").alias("parent_hash"))
    return links.join(known, "parent_hash", "left_anti")


def sampled_issues(issues: DataFrame, sample: DataFrame | None, with_repo: bool = False) -> DataFrame:
    """Issues whose number was sampled; all issues when there is no sample.

    The sample may grow with the data, so no broadcast is hinted: the planner
    picks one from the real size.
    """
    if sample is None or sample.isEmpty():
        return issues
    keys = ["repo", "issue_number"] if with_repo else ["issue_number"]
    return issues.join(sample.select(*keys).distinct(), keys, "left_semi")


def with_clusters(tokens: DataFrame, clusters: DataFrame, spread_by: Sequence[str]) -> DataFrame:
    """Cluster of each token row; tokens outside the map keep a null cluster."""
    return lookup_join(tokens, clusters.select("token", "cluster"), ["token"], spread_by)


def semi_by(facts: DataFrame, keys: DataFrame, on: Sequence[str], spread_by: Sequence[str]) -> DataFrame:
    """Facts whose key is among ``keys``."""
    return lookup_join(facts, keys.select(*on).distinct(), on, spread_by, "left_semi")
