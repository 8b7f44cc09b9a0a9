"""Vocabulary clusters over word vectors, projections and representatives."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

MERGERS = 32


def with_vectors(vocabulary: DataFrame, vectors: DataFrame) -> DataFrame:
    """Add the vector of every token, the zero vector where there is none; materialized.

    Both sides are unique on the token. Fits pass over the result many times and spend
    their time on arithmetic, so it is stored, in as many partitions as the session
    shuffles into, however few bytes a partition then holds. It is stored with the
    numbers as they come, which are often narrower, and read as doubles. The dimension
    is read off one stored row, since ``vectors`` may be dear to compute; they are asked
    themselves only if no token has a vector.
    """
    spark = vocabulary.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    joined = vocabulary.join(vectors.select("token", "vector"), "token", "left")
    points = materialize(joined.repartition(parts, "token"))
    width = _width(points)
    width = _width(vectors) if width is None else width
    zeros = F.array_repeat(F.lit(0.0), 1 if width is None else width)
    return points.withColumn("vector", F.coalesce(F.col("vector").cast("array<double>"), zeros))


def _width(vectors: DataFrame) -> int | None:
    """Entries of the first vector, None where there is none."""
    row = vectors.where(F.col("vector").isNotNull()).select(F.size("vector")).first()
    return None if row is None else row[0]


def cluster_vocabulary(
    vocabulary: DataFrame, vectors: DataFrame, k: int = 5, seed: int = 42, weighted: bool = True
) -> tuple[DataFrame, KMeansModel | None]:
    """k-means over the distinct tokens: the vocabulary with ``vector`` and ``cluster``.

    Weighting by the frequency ``n`` clusters occurrences without repeating rows.
    With one cluster, or one token, all labels are 0 and there is no model.
    """
    points = with_vectors(vocabulary, vectors)
    k = min(k, points.limit(max(k, 1)).count())
    if k <= 1:
        return points.withColumn("cluster", F.lit(0)), None
    featured = points.withColumn("__point", array_to_vector("vector"))
    means = KMeans(k=k, seed=seed, featuresCol="__point", predictionCol="cluster")
    if weighted:
        means = means.setWeightCol("n")
    model = means.fit(featured)
    return model.transform(featured).drop("__point"), model


def weighted_moments(points: DataFrame, vector: str, weight: Column, centre: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Sums of the weights, of the weighted vectors and of their weighted outer products, about ``centre``.

    One mergeable aggregate: a task adds its rows to one matrix of width x width, the matrices of tasks are added
    in ``MERGERS`` groups, and only these sums come to the driver.
    """
    width = len(centre)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((width + 1, width + 1))
        for batch in batches:
            if batch.num_rows:
                x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width) - centre
                x = np.column_stack([np.ones(len(x)), x])
                sums += (x * batch.column(1).to_numpy(zero_copy_only=False)[:, None]).T @ x
        if sums[0, 0]:
            yield pa.RecordBatch.from_pydict({"part": pa.array([TaskContext.get().partitionId() % MERGERS], pa.int32()), "sums": pa.array([sums.tobytes()], pa.binary())})

    def total(table: pa.Table) -> pa.Table:
        sums = sum(np.frombuffer(v.as_buffer()) for v in table.column("sums"))
        return pa.table({"sums": pa.array([sums.tobytes()], pa.binary())})

    rows = points.select(F.col(vector).cast("array<double>").alias("v"), weight.cast("double").alias("w"))
    parts = rows.mapInArrow(added, "part int, sums binary").groupBy("part").applyInArrow(total, "sums binary").toArrow()
    sums = sum((np.frombuffer(v.as_buffer()) for v in parts.column("sums")), np.zeros((width + 1) ** 2)).reshape(width + 1, width + 1)
    return sums[0, 0], sums[0, 1:], sums[1:, 1:]


def reduce_dimensions(points: DataFrame, n_components: int = 2, method: str = "pca") -> DataFrame:
    """Principal-component coordinates ``c1, c2, ..`` of the centred vectors.

    A column ``n`` weights them, so the axes are those of the table of all occurrences. The largest entry of an axis is positive.
    Vectors with fewer entries than components have zeros in the rest.
    """
    if method != "pca":
        raise ValueError(f"unknown method {method!r}; only 'pca' is available")
    names = [f"c{i + 1}" for i in range(n_components)]
    first = points.select(F.col("vector").cast("array<double>")).first()
    if first is None:
        return points.select("*", *[F.lit(0.0).alias(name) for name in names])
    weight = F.col("n") if "n" in points.columns else F.lit(1.0)
    start = np.array(first[0])  # sums about a point of the cloud lose fewer digits
    total, sums, products = weighted_moments(points, "vector", weight, start)
    shift = sums / total
    _, axes = np.linalg.eigh(products / total - np.outer(shift, shift))
    axes = axes[:, ::-1][:, :n_components]
    axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])])
    mean = F.array(*map(F.lit, (start + shift).tolist()))
    centred = F.zip_with(F.col("vector").cast("array<double>"), mean, lambda x, m: x - m)

    def along(axis: np.ndarray) -> Column:
        products = F.zip_with("__centred", F.array(*map(F.lit, axis.tolist())), lambda x, a: x * a)
        return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)

    coordinates = [along(axes[:, i]) if i < axes.shape[1] else F.lit(0.0) for i in range(n_components)]
    return points.withColumn("__centred", centred).select(*points.columns, *[c.alias(name) for c, name in zip(coordinates, names)])


def representative_tokens(coordinates: DataFrame, axes: tuple[str, ...] = ("c1", "c2")) -> DataFrame:
    """Per cluster the token nearest to the mean of its coordinates, ties by first place.

    Weights ``n`` make the mean one over occurrences. The centres are one row per
    cluster, and the number of clusters is a fitting parameter.
    """
    weight = F.sum("n")
    centres = coordinates.groupBy("cluster").agg(
        *[(F.sum(F.col(axis) * F.col("n")) / weight).alias(f"mean_{axis}") for axis in axes]
    )
    distance = sum((F.pow(F.col(axis) - F.col(f"mean_{axis}"), F.lit(2.0)) for axis in axes), F.lit(0.0))
    nearest = F.min_by("token", F.struct(F.sqrt(distance), "first"))
    return coordinates.join(F.broadcast(centres), "cluster").groupBy("cluster").agg(nearest.alias("token"))
