"""File-level identifier metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.naming import name_parts, naming_convention
from .markup import extract_identifiers

METRICS = ("n_identifiers", "avg_identifier_length", "avg_tokens_per_identifier", "vocab_size", "vocab_diversity",
           "pct_snake_case", "pct_camel_case", "pct_pascal_case")


def identifier_features(identifiers: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """Metrics per ``file_path`` from identifier rows (file_path, name).

    Repeats of a name in a file are counted before the name is taken apart. Each
    name then becomes one row per word part, whose first carries the numbers of
    the name. Rows collapse to (file, part) before they meet per file, so a file
    with most of the identifiers is spread by its vocabulary. With ``files`` every
    file gets a row, zeros where nothing was found.
    """
    names = (
        identifiers.groupBy("file_path", "name")
        .agg(F.count("*").alias("m"))
        .withColumns({"length": F.length("name"), "convention": naming_convention(F.col("name")),
                      "parts": name_parts(F.col("name"))})
    )
    parts = names.select(
        "file_path", "m", "length", "convention", F.size("parts").alias("n_parts"),
        F.posexplode_outer("parts").alias("part_no", "part"),
    )
    lead = F.coalesce(F.col("part_no"), F.lit(0)) == 0

    def leads(value: Column) -> Column:
        return F.sum(F.when(lead, F.col("m") * value).otherwise(0))

    by_part = parts.groupBy("file_path", "part").agg(
        leads(F.lit(1)).alias("n"),
        leads(F.col("length")).alias("chars"),
        leads(F.col("n_parts")).alias("tokens"),
        leads((F.col("convention") == "snake_case").cast("int")).alias("snake"),
        leads((F.col("convention") == "camelCase").cast("int")).alias("camel"),
        leads((F.col("convention") == "PascalCase").cast("int")).alias("pascal"),
    )
    sums = by_part.groupBy("file_path").agg(
        *[F.sum(name).alias(name) for name in ("n", "chars", "tokens", "snake", "camel", "pascal")],
        F.count("part").alias("vocab_size"),
    )
    n = F.col("n")
    table = sums.select(
        "file_path",
        n.alias("n_identifiers"),
        (F.col("chars") / n).alias("avg_identifier_length"),
        (F.col("tokens") / n).alias("avg_tokens_per_identifier"),
        "vocab_size",
        F.coalesce(F.try_divide("vocab_size", "tokens"), F.lit(0.0)).alias("vocab_diversity"),
        (F.col("snake") / n).alias("pct_snake_case"),
        (F.col("camel") / n).alias("pct_camel_case"),
        (F.col("pascal") / n).alias("pct_pascal_case"),
    )
    if files is None:
        return table
    return files.select("file_path").distinct().join(table, "file_path", "left").fillna(0, subset=list(METRICS))


def file_identifier_dataset(documents: DataFrame, parser: str = "dom") -> DataFrame:
    """One row of metrics per (file_path, xml) document, in path order."""
    parser = parser.lower().strip()
    if parser not in ("dom", "sax"):
        raise ValueError(f"unknown parser {parser!r}; use 'dom' or 'sax'")
    if parser == "sax":
        raise NotImplementedError("there is no sax parser")
    return identifier_features(extract_identifiers(documents), documents).orderBy("file_path")
