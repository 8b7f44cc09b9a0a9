"""Cleaned columns of issues, pull requests and commits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import canonical_user, commit_parts, plain_text
from .leading import first_rows


def _first(df: DataFrame, key: Sequence[str], limit: int | None) -> DataFrame:
    return df if limit is None else first_rows(df, key, limit)


def clean_titles(df: DataFrame, key: Sequence[str], limit: int | None = None, strict_bots: bool = False) -> DataFrame:
    """Issues or pull requests with title_clean, author_norm and is_bot."""
    user = canonical_user(F.col("author"), strict_bots)
    return _first(df, key, limit).withColumns(
        {
            "title_clean": plain_text(F.col("title")),
            "author_norm": user["login_norm"],
            "is_bot": user["is_bot"],
        }
    )


def clean_commits(df: DataFrame, key: Sequence[str] = ("commit_hash",), limit: int | None = None) -> DataFrame:
    """Commits with subject, body, cc_type, cc_scope and cc_breaking."""
    parts = _first(df, key, limit).withColumn("__parts", commit_parts(F.col("message")))
    names = ("subject", "body", "cc_type", "cc_scope", "cc_breaking")
    return parts.withColumns({name: F.col(f"__parts.{name}") for name in names}).drop("__parts")
