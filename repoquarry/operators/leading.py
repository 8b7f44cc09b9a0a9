"""The first n rows along an order, without gathering them in a task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

_TOP_K = 1_000


def first_rows(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows by the ``order`` columns, which must identify a row; nulls come first.

    Few rows come from a top-k. Otherwise the order columns alone are dealt by range and
    counted by range; only the range that the cut falls into is ranked, and the rows are
    filtered where they lie.
    """
    order = list(order)
    if n <= _TOP_K:
        return df.orderBy(*order).limit(max(n, 0))
    place = F.struct(*order)
    keys = materialize(df.select(*order).repartitionByRange(*order)).withColumn("__part", F.spark_partition_id())
    before, found = 0, None
    for part, size in keys.groupBy("__part").count().orderBy("__part").collect():  # one row for each range
        if before + size >= n:
            found = part
            break
        before += size
    if found is None:
        return df
    rank = F.row_number().over(Window.partitionBy("__part").orderBy(*order))
    last = keys.where(F.col("__part") == found).withColumn("__rank", rank).where(F.col("__rank") == n - before)
    return df.where(place <= last.select(place).scalar())
