"""Vocabularies of commits, identifiers and comments: clusters and alignment."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_filled, joined_text
from ..operators.clustering import cluster_vocabulary, reduce_dimensions, representative_tokens
from ..operators.leading import first_rows
from ..operators.vocabulary import pairwise_alignment, token_rows, top_token_lists, top_tokens, vocabulary_table
from .reports import SOURCE_TITLES, alignment_report


@dataclass
class Analysis:
    vocabularies: dict[str, DataFrame]  # token, n, first, vector, cluster
    top: DataFrame  # source, cluster, tokens
    alignment: DataFrame

    def report(self) -> DataFrame:
        return alignment_report(self.top, self.alignment)

    def coordinates(self, source: str) -> DataFrame:
        """Two principal components of a source's tokens, the points of its scatter plot."""
        return reduce_dimensions(self.vocabularies[source])

    def representatives(self, source: str) -> DataFrame:
        """The token that stands for each cluster in the plot."""
        return representative_tokens(self.coordinates(source))


def source_texts(
    commits: DataFrame, identifiers: DataFrame, comments: DataFrame, commit_limit: int | None = None
) -> dict[str, DataFrame]:
    """(key, text) of each source; ``commit_limit`` keeps the first commit hashes."""
    if commit_limit is not None:
        commits = first_rows(commits, ["commit_hash"], commit_limit)
    named = identifiers.where(is_filled(F.col("name")))
    noted = comments.where(is_filled(F.col("comment_text")))
    return {
        "commit": commits.select(F.col("commit_hash").alias("key"),
                                 joined_text(F.col("subject"), F.col("body")).alias("text")),
        "identifier": named.select(F.col("file_path").alias("key"), F.col("name").alias("text")),
        "comment": noted.select(F.col("file_path").alias("key"), F.col("comment_text").alias("text")),
    }


def analyze(
    commits: DataFrame,
    identifiers: DataFrame,
    comments: DataFrame,
    vectors: DataFrame,
    k: int = 5,
    top_n: int = 10,
    commit_limit: int | None = None,
) -> Analysis:
    """Cluster each vocabulary once and compare the three of them.

    ``vectors`` maps tokens to word vectors. A source without tokens is left out.
    """
    texts = source_texts(commits, identifiers, comments, commit_limit)
    vocabularies, labelled, tops = {}, None, None
    for source, rows in texts.items():
        tokens = token_rows(rows, ["key"], "text")
        clustered, _ = cluster_vocabulary(vocabulary_table(tokens, ["key", "pos"]), vectors, k)
        vocabularies[source] = clustered
        name = F.lit(source).alias("source")
        part = clustered.select(name, "token", F.col("cluster").alias("label"), F.col("first").alias("pos"))
        top = top_tokens(clustered.withColumn("source", F.lit(source)), top_n, ("source", "cluster"))
        labelled = part if labelled is None else labelled.unionByName(part)
        tops = top if tops is None else tops.unionByName(top)
    return Analysis(
        vocabularies,
        top_token_lists(tops, ("source", "cluster")),
        pairwise_alignment(labelled, list(SOURCE_TITLES)),
    )
