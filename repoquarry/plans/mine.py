"""Logs, payloads and markup into clean tables and samples."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import cleaning, markup, sampling, upsert
from ..operators.identifiers import file_identifier_dataset
from ..sources import gitlog, payloads
from ..sources.tables import write_csv, write_table


def mine_history(
    log: DataFrame,
    stored: dict[str, DataFrame] | None = None,
    max_commits: int | None = None,
    depth: int | None = None,
    repo_path: str | None = None,
) -> dict[str, DataFrame]:
    """Merge a commit log into the four commit tables; what is stored stays as it is.

    Commits arrive oldest first. With ``repo_path`` the run is added to the table
    ``run_log``: its newest commit and how many commits were traversed, stored before or not.
    """
    stored = stored or {}
    history = gitlog.oldest_commits(log, max_commits, depth)
    parts = {
        "commits": (gitlog.commit_rows(history), upsert.COMMITS),
        "commit_parents": (gitlog.parent_rows(history), upsert.COMMIT_PARENTS),
        "commit_stats": (gitlog.stat_rows(history), upsert.COMMIT_STATS),
        "commit_files": (gitlog.file_rows(history), upsert.COMMIT_FILES),
    }
    arrival = F.lit(0)  # one row per key and log: the hash decides the content
    merged = {
        name: upsert.upsert(stored.get(name), rows.withColumn("arrival", arrival), rules, "arrival")
        for name, (rows, rules) in parts.items()
    }
    if repo_path is not None:
        run = run_row(history, repo_path)
        merged["run_log"] = stored["run_log"].unionByName(run) if "run_log" in stored else run
    return merged


def run_row(history: DataFrame, repo_path: str) -> DataFrame:
    """Provenance of a run: start time, repository, newest commit, commits traversed. No row for an empty history."""
    counted = history.agg(F.count("*").alias("commit_count"), F.max_by("hash", F.struct("epoch", "hash")).alias("head_hash"))
    return counted.where("commit_count > 0").select(
        F.current_timestamp().alias("started_at"), F.lit(repo_path).alias("repo_path"), "head_hash", "commit_count"
    )


def append_newest(log: DataFrame, commits: DataFrame) -> DataFrame:
    """Append the newest commit of a log; one that is already stored is an error."""
    newest = gitlog.commit_rows(gitlog.newest_commit(log))
    return upsert.strict_insert(commits.select(*newest.columns), newest, ["commit_hash"])


ORIGIN = ["provider", "repo"]


def ingest(pages: dict[str, DataFrame], stored: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """Merge landed response pages into the tracker and CI tables.

    ``pages`` has tables named issues, pulls, runs and jobs, all optional, with
    provider, repo, page_no and json; jobs also run_id. Jobs are taken only with
    the runs they belong to.
    """
    stored, tables = stored or {}, {}
    if "issues" in pages:
        rows = payloads.issue_rows(pages["issues"], carry=ORIGIN, page_no="page_no")
        tables["issues"] = upsert.upsert_issues(stored.get("issues"), rows, "arrival")
    if "pulls" in pages:
        rows = payloads.pull_rows(pages["pulls"], carry=ORIGIN, page_no="page_no")
        tables["pull_requests"] = upsert.upsert_pull_requests(stored.get("pull_requests"), rows, "arrival")
    if "runs" in pages:
        runs = payloads.run_rows(pages["runs"], carry=ORIGIN, page_no="page_no")
        jobs = payloads.job_rows(pages["jobs"], "run_id", carry=ORIGIN, page_no="page_no") if "jobs" in pages else None
        merged = upsert.ingest_ci(stored.get("ci_pipelines"), stored.get("ci_jobs"), runs, jobs, "arrival")
        tables |= {name: table for name, table in zip(("ci_pipelines", "ci_jobs"), merged) if table is not None}
    return stored | tables


def mine_code(archives: DataFrame, first: int | None = None) -> dict[str, DataFrame]:
    """Identifiers and comments of multi-unit markup documents (document, xml)."""
    units = markup.split_units(archives, first)
    identifiers = markup.extract_identifiers(units).select("file_path", "name", "kind")
    comments = markup.extract_comments(units).select("file_path", "comment_text")
    return {"code_identifiers": identifiers, "code_comments": comments}


def write_identifier_dataset(documents: DataFrame, path: str) -> bool:
    """Naming metrics of the supported source files among (file_path, xml), as CSV."""
    return write_csv(file_identifier_dataset(markup.source_files(documents)), path)


def clean(tables: dict[str, DataFrame], limit: int | None = None) -> dict[str, DataFrame]:
    """The tables given, cleaned columns added."""
    keys = {"issues": ("provider", "repo", "issue_number"), "pull_requests": ("provider", "repo", "pr_number")}
    cleaned = {name: cleaning.clean_titles(tables[name], key, limit) for name, key in keys.items() if name in tables}
    if "commits" in tables:
        cleaned["commits"] = cleaning.clean_commits(tables["commits"], limit=limit)
    return tables | cleaned


def write_samples(tables: dict[str, DataFrame], folder: str, **options) -> dict[str, bool]:
    """Sample every entity among the tables to its CSV; says which were written."""
    written = {}
    for entity, (_, _, file_name, _) in sampling.ENTITIES.items():
        if entity in tables:
            sample = sampling.sample_entity(tables[entity], entity, **options)
            written[entity] = write_csv(sample, os.path.join(folder, file_name))
    return written


def write_tables(tables: dict[str, DataFrame], folder: str) -> None:
    for name, table in tables.items():
        write_table(table, folder, name)
