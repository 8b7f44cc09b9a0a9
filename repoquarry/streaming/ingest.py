"""Arrivals landed as a stream, merged when read.

The stream only appends: the file sink commits each micro-batch once, also
across restarts. Conflict rules depend on nothing but the arrival order, so the
merged table is the usual one-shuffle aggregate over everything landed, and no
state is rewritten per batch. Store the merged table now and then and merge only
what landed since to keep that read short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.upsert import Rules, upsert


def land(arrivals: DataFrame, folder: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append a stream of arrivals to Parquet files; the default takes what is there and stops."""
    writer = arrivals.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start(folder)


def merged(
    spark: SparkSession, folder: str, rules: Rules, arrival: str, stored: DataFrame | None = None
) -> DataFrame:
    """The table after everything landed, on top of an optional stored table."""
    return upsert(stored, spark.read.parquet(folder), rules, arrival)
