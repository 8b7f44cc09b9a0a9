"""Table scans and writes."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import schema


def read_table(spark: SparkSession, folder: str, table: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet table of a folder; the column list reaches the scan."""
    frame = spark.read.parquet(os.path.join(folder, f"{table}.parquet"))
    return frame.select(*columns) if columns else frame


def read_texts(spark: SparkSession, folder: str, table: str, columns: Sequence[str]) -> DataFrame:
    """Text columns for work that is bound by the processor, such as tokenizing.

    A table stored in fewer splits than there are cores is spread over them first;
    a table of many splits, the normal case on a cluster, is read as it is.
    """
    frame = read_table(spark, folder, table, columns)
    cores = spark.sparkContext.defaultParallelism
    return frame if frame.rdd.getNumPartitions() >= cores else frame.repartition(cores)


def read_database(
    spark: SparkSession,
    url: str,
    query: str,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
    **options: str,
) -> DataFrame:
    """Result of a query in an existing database, read in parallel ranges of a column."""
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    if partition_column is None:
        return reader.option("query", query).load()
    low, high = bounds
    return (
        reader.option("dbtable", f"({query}) q")
        .option("partitionColumn", partition_column)
        .option("lowerBound", low)
        .option("upperBound", high)
        .option("numPartitions", partitions)
        .load()
    )


def scalar(df: DataFrame, value: Column, name: str = "value") -> DataFrame:
    """One-row table with one aggregate."""
    return df.agg(value.alias(name))


def write_table(df: DataFrame, folder: str, table: str, truncate: bool = True) -> None:
    """Replace a table, or append to it. The source must not be the same path."""
    mode = "overwrite" if truncate else "append"
    df.write.mode(mode).parquet(os.path.join(folder, f"{table}.parquet"))


def append_run(spark: SparkSession, folder: str, repo_path: str, head_hash: str, commit_count: int) -> None:
    """Provenance row of a run; the start time defaults to now."""
    row = spark.range(1).select(
        F.current_timestamp().alias("started_at"),
        F.lit(repo_path).alias("repo_path"),
        F.lit(head_hash).alias("head_hash"),
        F.lit(commit_count).cast("long").alias("commit_count"),
    )
    write_table(row, folder, "run_log", truncate=False)


def write_csv(df: DataFrame, path: str) -> bool:
    """CSV folder with header, quotes doubled; nothing is written for an empty result."""
    if df.isEmpty():
        return False
    df.write.mode("overwrite").options(header=True, quote='"', escape='"').csv(path)
    return True


def write_lines(lines: DataFrame, path: str) -> None:
    """Text report from (line_no, line); a report is a page of text, so one file."""
    lines.orderBy("line_no").select("line").coalesce(1).write.mode("overwrite").text(path)


def read_sample(spark: SparkSession, path: str | None) -> DataFrame | None:
    """Sampled issue numbers from CSV; None when missing, unreadable or empty."""
    if not path:
        return None
    try:
        raw = spark.read.options(header=True, quote='"', escape='"', multiLine=True).csv(path)
        keys = [name for name in ("repo", "issue_number") if name in raw.columns]
        if "issue_number" not in keys:
            return None
        sample = raw.select(*keys).withColumn("issue_number", F.expr("try_cast(issue_number as int)"))
        if sample.isEmpty() or not sample.where("issue_number is null").isEmpty():
            return None
        return sample
    except AnalysisException:
        return None


def conforming(df: DataFrame, table: str) -> DataFrame:
    """Columns of the table's schema, in order and cast."""
    return df.select(*[F.col(field.name).cast(field.dataType) for field in schema(table)])
