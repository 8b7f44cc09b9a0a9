"""Key and reference checks over the fact tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import orphan_parents


def integrity_counts(commits: DataFrame, stats: DataFrame, parents: DataFrame) -> DataFrame:
    """One row: number of commits, of stats rows and of parent links without a commit."""
    n_commits = commits.select(F.count("*")).scalar()
    n_stats = stats.select(F.count("*")).scalar()
    orphans = orphan_parents(parents, commits).select(F.coalesce(F.sum("links"), F.lit(0))).scalar()
    return commits.sparkSession.range(1).select(
        n_commits.alias("n_commits"), n_stats.alias("n_stats"), orphans.alias("n_orphan_parents")
    )


def duplicate_keys(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; empty after a correct merge."""
    return table.groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")
