"""Exported commit logs turned into the four commit tables.

A log row is one commit: ``hash, author, message, epoch`` (seconds, UTC),
``parents`` (array of hashes), ``files`` (array of path, insertions, deletions)
and ``diffs`` (array of a_path, b_path, change_type against the first parent).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip
from ..operators.leading import first_rows

LOG_SCHEMA = (
    "hash string, author string, message string, epoch long, parents array<string>, "
    "files array<struct<path:string,insertions:int,deletions:int>>, "
    "diffs array<struct<a_path:string,b_path:string,change_type:string>>"
)


def commit_rows(log: DataFrame) -> DataFrame:
    return log.select(
        F.col("hash").alias("commit_hash"),
        F.coalesce(F.nullif("author", F.lit("")), F.lit("unknown")).alias("author_name"),
        strip(F.coalesce("message", F.lit(""))).alias("message"),
        F.timestamp_seconds("epoch").alias("commit_ts"),
    )


def parent_rows(log: DataFrame) -> DataFrame:
    return log.select(F.col("hash").alias("commit_hash"), F.explode("parents").alias("parent_hash"))


def _total(field: str) -> Column:
    each = F.transform(F.coalesce("files", F.array()), lambda f: F.coalesce(f[field], F.lit(0)))
    return F.aggregate(each, F.lit(0), lambda total, n: total + n)


def stat_rows(log: DataFrame) -> DataFrame:
    """Totals per commit; zeros for a commit without file statistics."""
    return log.select(
        F.col("hash").alias("commit_hash"),
        F.size(F.coalesce("files", F.array())).alias("files_changed"),
        _total("insertions").alias("insertions"),
        _total("deletions").alias("deletions"),
    )


def file_rows(log: DataFrame) -> DataFrame:
    """One row per changed file of every commit.

    The change type is ``A`` in a root commit, else the type of the path's last
    diff, else ``M``. A diff speaks for its new path, or for the old one when there
    is no new path. Files and diffs meet by (commit, path), so a commit that
    touches most of a repository is spread over tasks.
    """
    root = F.coalesce(F.size("parents"), F.lit(0)) < 1
    nothing = F.lit(None)
    files = log.select("hash", root.alias("root"), F.explode("files").alias("file")).select(
        "hash", "root", F.col("file.path").alias("path"),
        F.struct(
            F.coalesce("file.insertions", F.lit(0)).alias("additions"),
            F.coalesce("file.deletions", F.lit(0)).alias("deletions"),
        ).alias("change"),
        nothing.cast("string").alias("kind"), nothing.cast("int").alias("pos"),
    )
    diffs = log.select("hash", root.alias("root"), F.posexplode("diffs").alias("pos", "diff")).select(
        "hash", "root", F.coalesce(F.nullif(F.col("diff.b_path"), F.lit("")), F.col("diff.a_path")).alias("path"),
        nothing.cast(files.schema["change"].dataType).alias("change"),
        F.upper(F.coalesce("diff.change_type", F.lit("M"))).alias("kind"), "pos",
    )
    met = files.unionByName(diffs).groupBy("hash", "path").agg(
        F.bool_or("root").alias("root"), F.max("change").alias("change"), F.max_by("kind", "pos").alias("kind")
    )
    return met.where(F.col("change").isNotNull()).select(
        F.col("hash").alias("commit_hash"),
        F.col("path").alias("file_path"),
        F.when(F.col("root"), "A").otherwise(F.coalesce("kind", F.lit("M"))).alias("change_type"),
        "change.additions",
        "change.deletions",
    )


def oldest_commits(log: DataFrame, max_commits: int | None, depth: int | None = None) -> DataFrame:
    """The first commits of the history; a shallow history of ``depth`` gives one less."""
    if depth is not None:
        max_commits = depth - 1 if max_commits is None else min(max_commits, depth - 1)
    return log if max_commits is None else first_rows(log, ["epoch", "hash"], max_commits)


def newest_commit(log: DataFrame) -> DataFrame:
    return log.orderBy(F.desc("epoch"), "hash").limit(1)
