"""Schemas of the eleven tables, and helpers to create and widen them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# The columns of the tables.
DDL = {
    "commits": "commit_hash string not null, author_name string not null, message string not null, "
    "commit_ts timestamp not null",
    "commit_stats": "commit_hash string not null, files_changed int not null, insertions int not null, "
    "deletions int not null",
    "commit_files": "commit_hash string not null, file_path string not null, change_type string not null, "
    "additions int, deletions int",
    "commit_parents": "commit_hash string not null, parent_hash string not null",
    "run_log": "started_at timestamp not null, repo_path string not null, head_hash string not null, "
    "commit_count long not null",
    "issues": "provider string not null, repo string not null, issue_number int not null, title string not null, "
    "body string, author string, state string not null, state_reason string, comments_count int, labels string, "
    "created_at timestamp not null, closed_at timestamp",
    "pull_requests": "provider string not null, repo string not null, pr_number int not null, title string not null, "
    "author string, state string not null, created_at timestamp not null, merged_at timestamp, closed_at timestamp",
    "ci_pipelines": "provider string not null, repo string not null, pipeline_id string not null, "
    "status string not null, created_at timestamp not null, updated_at timestamp, sha string",
    "ci_jobs": "provider string not null, repo string not null, pipeline_id string not null, job_id string not null, "
    "name string, status string, started_at timestamp, finished_at timestamp, duration_seconds int",
    "code_identifiers": "file_path string not null, name string not null, kind string not null",
    "code_comments": "file_path string not null, comment_text string not null",
}

# The columns that cleaning adds.
CLEANED = {
    "issues": "title_clean string, author_norm string, is_bot boolean",
    "pull_requests": "title_clean string, author_norm string, is_bot boolean",
    "commits": "subject string, body string, cc_type string, cc_scope string, cc_breaking boolean",
}


def schema(table: str) -> StructType:
    return StructType.fromDDL(DDL[table])


def empty_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.createDataFrame([], schema(table))


def ensure_columns(df: DataFrame, table: str) -> DataFrame:
    """Add the cleaned columns that are missing: null, or false for flags."""
    missing = [field for field in StructType.fromDDL(CLEANED[table]) if field.name not in df.columns]
    defaults = {
        field.name: F.lit(False if field.dataType.simpleString() == "boolean" else None).cast(field.dataType)
        for field in missing
    }
    return df.withColumns(defaults) if defaults else df
