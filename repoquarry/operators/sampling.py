"""Reproducible samples: the rows with the smallest seeded hash of their id.

A sample is described by one cut per group, the hash of its last row. Cuts come from a radix
selection, so no group is ever gathered in one task: rows are counted per leading hash digits, only the
bucket that a group's cut falls into is counted again by its next digits, as often as it holds more than
``BUCKET_ROWS`` rows, and only what is left is ranked. The population itself is filtered where it lies. The
edges (one row per group: its last bucket and how many rows of it) are broadcast when
their number is bounded or was counted.
"""

from __future__ import annotations

import math
import random
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sizing import proportion_size_of
from ..session import broadcast_if_small, materialize
from .joins import lookup_join

_DIGITS = 4  # of the hash in each round of counting
_HASH_DIGITS = 32
BUCKET_ROWS = 1_000_000  # that one task may rank
_TOP_K = 10_000
_SMALL_PER_GROUP = 100


def seeded_hash(ids: Sequence[str], seed: int) -> Column:
    """md5 of the id columns and the seed; the sampling order."""
    return F.md5(F.concat_ws(":", *[F.col(name).cast("string") for name in ids], F.lit(str(seed))))


def hash_ordered(rows: DataFrame, ids: Sequence[str], seed: int) -> DataFrame:
    """Add the hash and the place (hash, ids) in the order."""
    return rows.withColumn("__hash", seeded_hash(ids, seed)).withColumn("__place", F.struct("__hash", *ids))


def _same(left: str, right: str) -> Column:
    return F.col(left).eqNullSafe(F.col(right))


class Edges(NamedTuple):
    rows: DataFrame  # (__edge_group, __edge_bucket, __rest, __size, __n): materialized, one row per group
    digits: int  # of the buckets


def _bucket(digits: int) -> Column:
    return F.substring("__hash", 1, digits)


def _edges(counts: DataFrame, wanted: Column) -> DataFrame:
    """Of (__group, __bucket, __n, ..), the bucket in which ``wanted`` rows of a group are reached, and how many of its rows are."""
    so_far = Window.partitionBy("__group").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    return (
        counts.withColumn("__before", F.coalesce(F.sum("__n").over(so_far), F.lit(0)))
        .withColumn("__rest", wanted - F.col("__before"))
        .where((F.col("__rest") > 0) & (F.col("__rest") <= F.col("__n")))
        .select(F.col("__group").alias("__edge_group"), F.col("__bucket").alias("__edge_bucket"), "__rest", "__size", "__n")
    )


def _inside(ordered: DataFrame, group: Column, edges: Edges) -> DataFrame:
    """The rows in the last bucket of their group."""
    placed = ordered.select(group.alias("__group"), _bucket(edges.digits).alias("__bucket"), "__hash", "__place")
    rows, _ = broadcast_if_small(edges.rows)
    return placed.join(rows, _same("__group", "__edge_group") & (F.col("__bucket") == F.col("__edge_bucket")))


def hash_edges(ordered: DataFrame, group: Column, quota: Column) -> Edges:
    """Per group the bucket its sample ends in, of ``BUCKET_ROWS`` rows at most while hashes differ.

    ``quota`` is the wanted number of rows as an expression over ``__group`` and ``__size``, the
    rows of the group; ``__rest`` of them lie in the last bucket. A group with quota
    0 has no row here.
    """
    counts = ordered.groupBy(group.alias("__group"), _bucket(_DIGITS).alias("__bucket")).agg(F.count("*").alias("__n"))
    sized = counts.withColumn("__size", F.sum("__n").over(Window.partitionBy("__group")))
    edges = Edges(materialize(_edges(sized, F.least(quota, F.col("__size")))), _DIGITS)
    while edges.digits < _HASH_DIGITS and (edges.rows.agg(F.max("__n")).first()[0] or 0) > BUCKET_ROWS:
        digits = edges.digits + _DIGITS
        again = _inside(ordered, group, edges).groupBy("__group", _bucket(digits).alias("__bucket"), "__rest", "__size").agg(F.count("*").alias("__n"))
        again = again.withColumnRenamed("__rest", "__wanted")
        edges = Edges(materialize(_edges(again, F.col("__wanted"))), digits)
    return edges


def hash_cuts(ordered: DataFrame, group: Column, edges: Edges) -> DataFrame:
    """Per group the place (hash, ids) of the last sampled row: (__group, __cut)."""
    rank = F.row_number().over(Window.partitionBy("__group", "__bucket").orderBy("__place"))
    ranked = _inside(ordered, group, edges).withColumn("__rank", rank)
    return ranked.where(F.col("__rank") == F.col("__rest")).select("__group", F.col("__place").alias("__cut"))


def sample_uniform(population: DataFrame, k: int, ids: Sequence[str], seed: int = 0) -> DataFrame:
    """``k`` rows without replacement, all rows when there are no more than ``k``.

    ``ids`` must identify a row. Few rows come from a top-k, many from one cut.
    """
    columns = population.columns
    if k <= 0:
        return population.limit(0)
    ordered = hash_ordered(population, ids, seed)
    if k <= _TOP_K:
        return ordered.orderBy("__place").limit(k).select(*columns)
    everything = F.lit(0)
    edge = hash_edges(ordered, everything, F.lit(k))
    cut = hash_cuts(ordered, everything, edge).select("__cut").scalar()
    return ordered.where(F.col("__place") <= cut).select(*columns)


def sample_stratified(
    population: DataFrame,
    key: str | Column,
    ids: Sequence[str],
    *,
    n: int | None = None,
    frac: float | None = None,
    seed: int = 0,
    max_broadcast_groups: int = 100_000,
) -> DataFrame:
    """Per group ``min(n, size)`` rows, or ``ceil(size * frac)`` rows.

    A null key is a group of its own. Edges and cuts, one row per group, are
    broadcast when a count shows they are few. Otherwise the edges are joined on
    group and hash bucket, which no group can make hot, and the cuts on the group
    with hot groups spread.
    """
    if (n is None) == (frac is None):
        raise ValueError("give exactly one of n and frac")
    columns = population.columns
    if (n is not None and n <= 0) or (frac is not None and frac <= 0):
        return population.limit(0)
    group = F.col(key) if isinstance(key, str) else key
    ordered = hash_ordered(population, ids, seed)
    if n is not None and n <= _SMALL_PER_GROUP:
        # the rank limit is applied in every task before the shuffle
        place = Window.partitionBy("__group").orderBy("__place")
        ranked = ordered.withColumn("__group", group).withColumn("__rank", F.row_number().over(place))
        return ranked.where(F.col("__rank") <= n).select(*columns)
    quota = F.lit(n) if n is not None else F.ceil(F.col("__size") * F.lit(frac))
    edges = hash_edges(ordered, group, quota)
    _, small = broadcast_if_small(edges.rows, max_broadcast_groups)
    cuts = hash_cuts(ordered, group, edges)
    if small:
        few = F.broadcast(cuts.select(F.col("__group").alias("__cut_group"), "__cut"))
        joined = ordered.withColumn("__group", group).join(few, _same("__group", "__cut_group"))
    else:
        # a null group needs a name to join on; JSON tells it from every value
        def named(value: Column) -> Column:
            return F.to_json(F.struct(value.alias("g")))

        dim = cuts.select(named(F.col("__group")).alias("__name"), "__cut")
        sizes = edges.rows.select(named(F.col("__edge_group")).alias("__name"), F.col("__size").alias("weight"))
        joined = lookup_join(ordered.withColumn("__name", named(group)), dim, ["__name"], ["__hash"], "inner", sizes)
    return joined.where(F.col("__place") <= F.col("__cut")).select(*columns)


def numbered(rows: DataFrame, order: Sequence[Column], out: str = "__index") -> DataFrame:
    """Add a gapless index from 0 along ``order``, which must order rows totally.

    The range-partitioned sort is checkpointed, so every later read sees the
    same partitions. The offsets are one number per partition.
    """
    position = F.monotonically_increasing_id()
    placed = materialize(rows.orderBy(*order).withColumn("__position", position))
    part = F.shiftright("__position", 33)
    sizes = placed.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))
    before = Window.partitionBy(F.lit(0)).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    inside = F.col("__position").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.withColumn("__part", part)
        .join(F.broadcast(offsets), "__part")
        .withColumn(out, F.col("__offset") + inside)
        .drop("__part", "__offset", "__position")
    )


def sample_systematic(
    population: DataFrame,
    step: int,
    order: Sequence[Column],
    seed: int | None = None,
    start: int | None = None,
    ids: Sequence[str] = (),
    by: Sequence[str] = (),
) -> DataFrame:
    """Every ``step``-th row along ``order`` from a start drawn in [0, step - 1].

    With ``by``, the columns that ``order`` uses, and ``ids``, which identify a row, only
    these are sorted and numbered, and the population is filtered by the chosen ids.
    """
    if step <= 0:
        raise ValueError("step must be at least 1")
    first = random.Random(seed).randrange(step) if start is None else start
    narrow = population.select(*dict.fromkeys([*ids, *by])) if ids and by else population
    rows = numbered(narrow, order)
    chosen = rows.where(F.pmod(F.col("__index") - F.lit(first), F.lit(step)) == 0).drop("__index")
    return population.join(chosen.select(*ids), list(ids), "left_semi") if ids and by else chosen


def draw_sample(
    population: DataFrame,
    ids: Sequence[str],
    order: Sequence[Column],
    *,
    n: int | None = None,
    frac: float | None = None,
    step: int | None = None,
    seed: int = 0,
    key: str | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Pick the sampling method from the arguments given; ``by`` names the columns that ``order`` uses.

    Nothing given: the size that estimates a proportion within 5 % at 95 %
    confidence. A key wins over a step, a step over n, n over frac. A key that is
    no column falls back to a uniform sample of n, or to everything.
    """
    if step is not None and step <= 0:
        raise ValueError("step must be at least 1")
    if key is not None and key in population.columns and step is not None and n is None and frac is None:
        raise ValueError("give exactly one of n and frac")
    size = None
    if key is not None and key not in population.columns:
        if n is None and frac is None and step is None:
            return population
        return population if n is None else sample_uniform(population, n, ids, seed)
    if n is None and (step is None or key is not None):
        size = population.count()
        if size == 0:
            return population
    if n is None and frac is None and step is None:
        n = proportion_size_of(size)
        if key is not None:
            n, frac = None, n / size
    if key is not None:
        return sample_stratified(population, key, ids, n=n, frac=frac, seed=seed)
    if step is not None:
        return sample_systematic(population, step, order, seed, ids=ids, by=by)
    return sample_uniform(population, n if n is not None else math.ceil(size * frac), ids, seed)


# The columns sampled per entity (cleaned ones only when present),
# the id columns, the file name, and the order column with "desc" or "asc".
ENTITIES = {
    "issues": (
        ("issue_number", "state", "created_at", "author", "title", "labels", "title_clean", "author_norm", "is_bot"),
        ("provider", "repo", "issue_number"), "sampled_issues.csv", ("issue_number", "asc"),
    ),
    "commits": (
        ("commit_hash", "author_name", "commit_ts", "message"),
        ("commit_hash",), "sampled_commits.csv", ("commit_ts", "desc"),
    ),
    "pull_requests": (
        ("pr_number", "state", "created_at", "merged_at", "author", "title", "title_clean", "author_norm", "is_bot"),
        ("provider", "repo", "pr_number"), "sampled_prs.csv", ("pr_number", "asc"),
    ),
    "ci_pipelines": (
        ("pipeline_id", "status", "created_at", "updated_at", "sha"),
        ("provider", "repo", "pipeline_id"), "sampled_workflows.csv", ("created_at", "desc"),
    ),
    "ci_jobs": (
        ("job_id", "name", "status", "started_at", "duration_seconds"),
        ("provider", "repo", "job_id"), "sampled_jobs.csv", ("started_at", "desc"),
    ),
}


def sample_entity(table: DataFrame, entity: str, **options) -> DataFrame:
    """Sample one of the five entities with the arguments of ``draw_sample``.

    A descending order puts rows without a time first.
    """
    columns, ids, _, (sorted_by, direction) = ENTITIES[entity]
    ids = [name for name in ids if name in table.columns]
    shown = [name for name in columns if name in table.columns]
    by = F.col(sorted_by).desc_nulls_first() if direction == "desc" else F.col(sorted_by).asc()
    population = table.select(*dict.fromkeys([*shown, *ids]))
    return draw_sample(population, ids, [by, *map(F.col, ids)], by=[sorted_by], **options).select(*shown)
