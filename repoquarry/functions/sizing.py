"""Statistical sample sizes, as plain numbers or per row."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _check(margin: float, *, share: float | None = None) -> None:
    if margin <= 0:
        raise ValueError("margin must be positive")
    if share is not None and not 0 <= share <= 1:
        raise ValueError("p must lie between 0 and 1")


def _corrected(base: Column, population: Column) -> Column:
    finite = base / (F.lit(1.0) + (base - F.lit(1.0)) / F.nullif(population, F.lit(0)))
    return F.when(population.isNull(), F.ceil(base)).when(population == 0, F.lit(0)).otherwise(F.least(F.ceil(finite), population.cast("long")))


def proportion_size(population: Column, p: float = 0.5, margin: float = 0.05, z: float = 1.96) -> Column:
    """Rows needed to estimate a proportion; a null population is unlimited, an empty one needs none."""
    _check(margin, share=p)
    return _corrected(F.lit(z * z * p * (1 - p) / (margin * margin)), population)


def mean_size(sigma: Column, population: Column, margin: float = 0.05, z: float = 1.96) -> Column:
    """Rows needed to estimate a mean; ``sigma`` must be positive."""
    _check(margin)
    checked = F.when(sigma > 0, sigma).otherwise(F.raise_error(F.lit("sigma must be positive")).cast("double"))
    return _corrected(F.lit(z * z) * checked * checked / F.lit(margin * margin), population)


def proportion_size_of(population: int | None, p: float = 0.5, margin: float = 0.05, z: float = 1.96) -> int:
    """The same size for one population already counted."""
    _check(margin, share=p)
    base = z * z * p * (1 - p) / (margin * margin)
    if population is None:
        return math.ceil(base)
    if population == 0:
        return 0
    return min(math.ceil(base / (1 + (base - 1) / population)), population)
