"""Number of points in closed intervals, by a block index of the points instead of a range join.

Quantiles of the points' times cut time into blocks, ``BLOCKS`` at most, and the number of points before each
block is a table of one row a block, small enough to broadcast whatever the data. An interval end needs only the
points of its own block besides: they are summed up in the order of time together with the ends that fall into the
block. All points of one time are one row there, and a block with many ends is repeated for parts of them,
so neither a busy time nor a busy block makes a large task. Nothing is sorted as a whole, and no Python runs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCKS = 1000
ACCURACY = 10_000  # a block holds about 1 / BLOCKS of the points, give or take 1 / ACCURACY
PART_ENDS = 1_000_000  # of a block that one task counts

# order of marks at one time: a start, then points, then an end
_START, _POINT, _END = 0, 1, 2


def _micros(name: str) -> Column:
    return F.unix_micros(F.col(name).cast("timestamp"))


def _borders(times: DataFrame) -> list[float]:
    """Times that begin a block, in order. Doubles keep the order of times, so equal times stay in one block."""
    shares = [i / BLOCKS for i in range(1, BLOCKS)]
    found = times.agg(F.percentile_approx("__t", shares, ACCURACY)).first()[0] or []
    return sorted({float(t) for t in found})


def _in_blocks(marks: DataFrame, borders: list[float]) -> DataFrame:
    if not borders:
        return marks.withColumn("__block", F.lit(0))
    limits = [-float("inf"), *borders, float("inf")]
    placed = Bucketizer(splits=limits, inputCol="__x", outputCol="__b").transform(marks.withColumn("__x", F.col("__t").cast("double")))
    return placed.withColumn("__block", F.col("__b").cast("int")).drop("__x", "__b")


def count_in_windows(
    intervals: DataFrame,
    points: DataFrame,
    start: str,
    end: str,
    time: str,
    row_key: Sequence[str],
    out: str = "n_points",
) -> DataFrame:
    """Add to each interval the number of points with ``start <= time <= end``.

    ``row_key`` identifies an interval. An interval without a start or an end has no count; one that
    ends before it starts has a count of 0 or less. Points without a time are passed over.
    """
    keys = [f"__key{i}" for i in range(len(row_key))]
    named = [F.col(c).alias(k) for c, k in zip(row_key, keys)]
    ends = F.array(*(F.struct(_micros(c).alias("t"), F.lit(kind).alias("kind")) for c, kind in ((start, _START), (end, _END))))
    probes = intervals.select(*named, F.explode(ends).alias("__end")).select(F.col("__end.t").alias("__t"), F.col("__end.kind").alias("__kind"), *keys)
    times = points.select(_micros(time).alias("__t")).where(F.col("__t").isNotNull())
    borders = _borders(times)
    times = _in_blocks(times.groupBy("__t").agg(F.count("*").alias("__n")), borders)
    probes = _in_blocks(probes.where(F.col("__t").isNotNull()), borders)

    both = times.select("__block", "__n", F.lit(0).alias("__p")).unionByName(probes.select("__block", F.lit(0).alias("__n"), F.lit(1).alias("__p")))
    before = Window.partitionBy(F.lit(0)).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)  # one row a block
    sizes = both.groupBy("__block").agg(F.sum("__n").alias("__n"), F.sum("__p").alias("__p"))
    parts = F.ceil(F.greatest(F.col("__p"), F.lit(1)) / PART_ENDS).cast("int")
    blocks = sizes.select("__block", parts.alias("__parts"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    blocks = F.broadcast(blocks)  # BLOCKS rows at most

    nothing = [F.lit(None).cast(probes.schema[k].dataType).alias(k) for k in keys]
    every = F.explode(F.sequence(F.lit(0), F.col("__parts") - 1)).alias("__part")
    marks = times.join(blocks, "__block").select("__block", every, "__before", "__t", F.lit(_POINT).alias("__kind"), "__n", *nothing)
    asked = probes.join(blocks, "__block").select(
        "__block", F.pmod(F.xxhash64(*keys), F.col("__parts")).cast("int").alias("__part"), "__before", "__t", "__kind", F.lit(0).cast("long").alias("__n"), *keys
    )
    running = Window.partitionBy("__block", "__part").orderBy("__t", "__kind").rowsBetween(Window.unboundedPreceding, 0)
    seen = marks.unionByName(asked).withColumn("__seen", F.sum("__n").over(running) + F.col("__before")).where(F.col("__kind") != _POINT)
    signed = F.when(F.col("__kind") == _END, F.col("__seen")).otherwise(-F.col("__seen"))
    counted = seen.groupBy(*keys).agg(F.sum(signed).alias(out), F.count("*").alias("__ends"))
    same = [F.col(c).eqNullSafe(F.col(k)) for c, k in zip(row_key, keys)]
    n = F.when(F.col("__ends") == 2, F.col(out))  # an open interval has no count
    columns = [c for c in intervals.columns if c != out]
    return intervals.select(*columns).join(counted, same, "left").select(*columns, n.alias(out))
