"""Keyed merges: stored rows plus a batch of arrivals give the new table.

All conflict rules are aggregates over the arrival order, so a merge is one
shuffle with map-side combining, whatever the number of arrivals per key. The
functions are pure: applying the same batch twice gives the same table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rules:
    """Conflict rule of every non-key column.

    first: the value that arrived first stays; latest: the newest arrival wins,
    even if null; least: the smallest non-null value; filled: the newest
    non-null value.
    """

    keys: tuple[str, ...]
    first: tuple[str, ...] = ()
    latest: tuple[str, ...] = ()
    least: tuple[str, ...] = ()
    filled: tuple[str, ...] = ()

    @property
    def columns(self) -> tuple[str, ...]:
        return (*self.keys, *self.first, *self.latest, *self.least, *self.filled)


COMMITS = Rules(("commit_hash",), first=("author_name", "message", "commit_ts"))
COMMIT_PARENTS = Rules(("commit_hash", "parent_hash"))
COMMIT_STATS = Rules(("commit_hash",), first=("files_changed", "insertions", "deletions"))
COMMIT_FILES = Rules(("commit_hash", "file_path"), first=("change_type", "additions", "deletions"))
ISSUES = Rules(
    ("provider", "repo", "issue_number"),
    latest=("title", "body", "author", "state", "state_reason", "comments_count", "labels"),
    least=("created_at",),
    filled=("closed_at",),
)
PULL_REQUESTS = Rules(
    ("provider", "repo", "pr_number"),
    latest=("title", "author", "state"),
    least=("created_at",),
    filled=("merged_at", "closed_at"),
)
CI_PIPELINES = Rules(
    ("provider", "repo", "pipeline_id"),
    latest=("status",),
    least=("created_at",),
    filled=("updated_at", "sha"),
)
CI_JOBS = Rules(
    ("provider", "repo", "job_id"),
    first=("pipeline_id", "name"),
    latest=("status",),
    filled=("started_at", "finished_at", "duration_seconds"),
)


def upsert(stored: DataFrame | None, batch: DataFrame, rules: Rules, arrival: str) -> DataFrame:
    """Merge ``batch`` into ``stored``; ``arrival`` is any orderable column that orders the batch.

    Arrivals must differ among the rows of a key and not be null. Stored rows come before all of them.
    """
    order = F.struct(F.lit(1).alias("batch"), F.col(arrival).alias("arrival")).alias("__seq")
    arriving = batch.select(*rules.columns, order)
    if stored is not None:
        kind = arriving.schema["__seq"].dataType["arrival"].dataType
        before = F.struct(F.lit(0).alias("batch"), F.lit(None).cast(kind).alias("arrival")).alias("__seq")
        arriving = stored.select(*rules.columns, before).unionByName(arriving)
    merged: list[Column] = []
    if rules.first:
        merged.append(F.min_by(F.struct(*rules.first), "__seq").alias("__first"))
    if rules.latest:
        merged.append(F.max_by(F.struct(*rules.latest), "__seq").alias("__latest"))
    merged += [F.min(name).alias(name) for name in rules.least]
    merged += [
        F.max_by(name, F.when(F.col(name).isNotNull(), F.col("__seq"))).alias(name) for name in rules.filled
    ]
    grouped = arriving.groupBy(*rules.keys)
    table = grouped.agg(*merged) if merged else arriving.select(*rules.keys).distinct()
    picked = {name: F.col(f"__first.{name}") for name in rules.first}
    picked |= {name: F.col(f"__latest.{name}") for name in rules.latest}
    return table.select(*[picked.get(name, F.col(name)).alias(name) for name in rules.columns])


def upsert_issues(stored: DataFrame | None, batch: DataFrame, arrival: str) -> DataFrame:
    defaults = {"body": F.lit(""), "labels": F.lit(""), "comments_count": F.lit(0)}
    missing = {name: value for name, value in defaults.items() if name not in batch.columns}
    return upsert(stored, batch.withColumns(missing), ISSUES, arrival)


def upsert_pull_requests(stored: DataFrame | None, batch: DataFrame, arrival: str) -> DataFrame:
    return upsert(stored, batch, PULL_REQUESTS, arrival)


def upsert_pipelines(stored: DataFrame | None, batch: DataFrame, arrival: str) -> DataFrame:
    return upsert(stored, batch.withColumn("pipeline_id", F.col("pipeline_id").cast("string")), CI_PIPELINES, arrival)


def upsert_jobs(stored: DataFrame | None, batch: DataFrame, arrival: str) -> DataFrame:
    ids = {name: F.col(name).cast("string") for name in ("pipeline_id", "job_id")}
    return upsert(stored, batch.withColumns(ids), CI_JOBS, arrival)


def jobs_of_batch(jobs: DataFrame, pipelines: DataFrame) -> DataFrame:
    """Jobs that belong to a pipeline of the batch, of the same repository; others are not ingested."""
    from .joins import semi_by

    origin = ["provider", "repo", "pipeline_id"]
    ids = pipelines.select("provider", "repo", F.col("pipeline_id").cast("string").alias("pipeline_id"))
    return semi_by(jobs.withColumn("pipeline_id", F.col("pipeline_id").cast("string")), ids, origin, ["job_id"])


def ingest_ci(
    stored_pipelines: DataFrame | None,
    stored_jobs: DataFrame | None,
    pipelines: DataFrame,
    jobs: DataFrame | None,
    arrival: str,
) -> tuple[DataFrame, DataFrame | None]:
    """Merge a batch of CI runs and, for these runs only, their jobs."""
    runs = upsert_pipelines(stored_pipelines, pipelines, arrival)
    if jobs is None:
        return runs, stored_jobs
    return runs, upsert_jobs(stored_jobs, jobs_of_batch(jobs, pipelines), arrival)


def strict_insert(stored: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Append rows; a key that is already stored, or arrives twice, is an error."""
    keys = list(keys)
    present = rows.join(stored.select(*keys), keys, "left_semi").select(*keys)
    doubled = rows.groupBy(*keys).count().where("count > 1").select(*keys)
    clash = present.unionByName(doubled).limit(1).collect()
    if clash:
        raise ValueError(f"duplicate key {clash[0].asDict()}")
    return stored.unionByName(rows)
