"""Text reports as (line_no, line) tables, put together from metric tables.

Fixed values: the wording and number formats of the lines.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def fixed_lines(spark: SparkSession, section: int, lines: Sequence[str]) -> DataFrame:
    listed = F.array(*map(F.lit, lines))
    return spark.range(1).select(F.lit(section).alias("section"), F.posexplode(listed).alias("place", "line"))


def table_lines(table: DataFrame, section: int, order: Sequence[Column], line: Column) -> DataFrame:
    """A line per row of a metric table; such a table has a row per class or cluster."""
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order))
    return table.select(F.lit(section).alias("section"), place.alias("place"), line.alias("line"))


def numbered_lines(parts: Sequence[DataFrame]) -> DataFrame:
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    number = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("section", "place"))
    return report.select(number.alias("line_no"), "line")


# Names of the sources and their titles, in report order.
SOURCE_TITLES = {
    "commit": "Commit Message Vocabulary",
    "identifier": "Code Identifier Vocabulary",
    "comment": "Code Comment Vocabulary",
}


def alignment_report(top_lists: DataFrame, alignment: DataFrame) -> DataFrame:
    """Clusters of each source (source, cluster, tokens), then the pairwise measures."""
    spark = top_lists.sparkSession
    parts = [fixed_lines(spark, 0, ["VOCABULARY ALIGNMENT REPORT", "=" * 40, ""])]
    for number, (source, title) in enumerate(SOURCE_TITLES.items(), start=1):
        clusters = top_lists.where(F.col("source") == source)
        heading = F.array(F.lit(f"{title} Clusters"), F.lit("-" * 36))
        present = clusters.limit(1)
        parts.append(present.select(F.lit(number * 10).alias("section"), F.posexplode(heading).alias("place", "line")))
        listed = F.concat(F.lit("  Cluster "), F.col("cluster"), F.lit(": "), F.array_join("tokens", ", "))
        parts.append(table_lines(clusters, number * 10 + 1, [F.col("cluster")], listed))
        parts.append(present.select(F.lit(number * 10 + 2).alias("section"), F.lit(0).alias("place"),
                                    F.lit("").alias("line")))
    parts.append(fixed_lines(spark, 90, ["Alignment Metrics", "=" * 40, ""]))
    pairs = [("commit", "identifier"), ("commit", "comment"), ("identifier", "comment")]
    for number, (a, b) in enumerate(pairs, start=100):
        wanted = fixed_lines(spark, number, [""]).select("section")
        row = alignment.where((F.col("source_a") == a) & (F.col("source_b") == b)).withColumn("section", F.lit(number))
        block = F.array(
            F.lit(f"{a} ↔ {b}"),
            F.format_string("  Vocabulary overlap (Jaccard): %.1f%%", F.col("vocab_overlap") * 100),
            F.format_string("  Shared vocabulary size:       %d", F.col("shared_vocab_size")),
            F.format_string("  Cluster similarity (ARI):     %.3f", F.col("cluster_similarity")),
            F.lit(""),
        )
        shown = F.when(F.col("vocab_overlap").isNull(), F.array(F.lit(f"{a} ↔ {b}: no data"))).otherwise(block)
        parts.append(wanted.join(row, "section", "left").select("section", F.posexplode(shown).alias("place", "line")))
    return numbered_lines(parts)


def model_report(
    title: str,
    model_type: str,
    n_features: int,
    train_size: int,
    test_size: int,
    metrics: DataFrame,
    importances: DataFrame,
    classes: Sequence[str],
) -> DataFrame:
    """Sizes, the classification table and the ranked importances.

    The share of hits stands in the heading in either form of the table, with ``accuracy`` or with ``micro avg``.
    """
    spark = metrics.sparkSession
    hits = metrics.where(F.col("class").isin("accuracy", "micro avg"))  # one of the two; the recall over all classes
    order = [*classes, "accuracy", "micro avg", "macro avg", "weighted avg"]
    place = F.array_position(F.array(*map(F.lit, order)), F.col("class"))
    blank_before = F.col("class") == "accuracy"
    row = F.when(
        blank_before, F.format_string("%12s  %9s %9s %9.2f %9d", "class", F.lit(""), F.lit(""), "f1", "support")
    ).otherwise(F.format_string("%12s  %9.2f %9.2f %9.2f %9d", "class", "precision", "recall", "f1", "support"))
    return numbered_lines(
        [
            fixed_lines(spark, 0, [title, "=" * 40, "", f"Model type:  {model_type}", f"Features:    {n_features}",
                                   f"Train size:  {train_size}", f"Test size:   {test_size}"]),
            table_lines(hits, 1, [F.lit(0)],
                        F.format_string("Accuracy:    %.1f%%", F.col("recall") * 100)),
            fixed_lines(spark, 2, ["", "Classification report (test set):", "-" * 36,
                                   "              precision    recall  f1-score   support", ""]),
            table_lines(metrics, 3, [place], row),
            fixed_lines(spark, 4, ["", "Feature importances (descending):", "-" * 36]),
            table_lines(importances, 5, [F.desc("importance"), F.col("feature")],
                        F.format_string("  %-25s %.4f", "feature", "importance")),
        ]
    )
