"""Identifier spelling: naming convention and word parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import SPACE

# The names of the conventions.
CONVENTIONS = ("SCREAMING_SNAKE", "snake_case", "camelCase", "PascalCase", "other")


def _all_upper(text: Column) -> Column:
    return (F.upper(text) == text) & (F.lower(text) != text)


def _all_lower(text: Column) -> Column:
    return (F.lower(text) == text) & (F.upper(text) != text)


def naming_convention(name: Column) -> Column:
    first = F.substring(name, 1, 1)
    joined = ~name.contains("_")
    return (
        F.when(name.isNull() | (name == ""), "other")
        .when(_all_upper(name) & (~joined | (F.length(name) > 1)), "SCREAMING_SNAKE")
        .when(_all_lower(name), "snake_case")
        .when(joined & _all_lower(first) & (F.lower(name) != name), "camelCase")
        .when(joined & _all_upper(first), "PascalCase")
        .otherwise("other")
    )


def name_parts(name: Column) -> Column:
    """Lower-cased parts of an identifier, split at ``_``, blanks and before A-Z."""
    spaced = F.lower(F.regexp_replace(F.coalesce(name, F.lit("")), "([A-Z])", " $1"))
    return F.array_remove(F.split(spaced, f"(?:_|{SPACE})+"), "")


def local_tag(tag: Column) -> Column:
    """Element name without its namespace."""
    return F.regexp_replace(tag, r"^[^}]*\}", "")
