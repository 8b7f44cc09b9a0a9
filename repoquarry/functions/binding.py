"""A value computed once and used several times inside one column."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` applied to ``value``, which becomes the variable of a one-element ``transform``."""
    return F.transform(F.array(value), body)[0]
