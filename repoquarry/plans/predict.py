"""Commit-type classifier."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.stemming import with_stems
from ..functions.text import COMMIT_LABELS, is_filled
from ..operators.clustering import cluster_vocabulary
from ..operators.features import commit_feature_names, commit_features, commit_texts, commit_tokens, token_weights
from ..operators.vocabulary import distinct_stems, token_rows
from ..session import discard, materialize, release, stored
from .evaluate import Evaluation, fit_and_evaluate


def commit_feature_table(
    commits: DataFrame,
    identifiers: DataFrame,
    comments: DataFrame,
    vectors: DataFrame,
    k: int = 5,
    commit_limit: int | None = None,
) -> DataFrame:
    """Features and label per commit, clusters fitted on the distinct commit tokens.

    Messages are split once; the vocabulary to cluster and the features both read their stored tokens.
    The table is materialized, and what it was made from is deleted: the vectors once the clusters are known, tokens at the end.
    """
    spark = commits.sparkSession
    messages = commit_texts(commits, "commit_hash", commit_limit)
    named = identifiers.where(is_filled(F.col("name"))).select(F.col("file_path").alias("key"), "name")
    noted = comments.where(is_filled(F.col("comment_text"))).select(F.col("file_path").alias("key"), "comment_text")

    def terms(rows: DataFrame, key: str, text: str) -> DataFrame:
        return materialize(distinct_stems(token_rows(rows, [key], text)))

    tokens = stored(commit_tokens(messages, "commit_hash", "message"))
    weights = token_weights(tokens)
    stems = with_stems(weights.select("token"))  # one row a word, as they are materialized
    vocabulary = stems.select(F.col("stem").alias("token")).distinct().sortWithinPartitions("token")  # fits depend on the order
    release(spark)
    # a checkpoint would keep the model that made it, and that the table of vectors
    clustered = stored(cluster_vocabulary(vocabulary, vectors, k, weighted=False)[0].select("token", "cluster"))
    release(spark)
    id_terms = terms(named, "key", "name")
    comment_terms = terms(noted, "key", "comment_text")
    table = commit_features(messages, "commit_hash", "message", clustered, k, id_terms, comment_terms, tokens=tokens, weights=weights)
    table = materialize(table.sortWithinPartitions("commit_hash"))
    discard(tokens)
    discard(clustered)
    return table


def predict_commit_types(
    commits: DataFrame,
    identifiers: DataFrame,
    comments: DataFrame,
    vectors: DataFrame,
    k: int = 5,
    model_type: str = "decision_tree",
    max_depth: int | None = None,
    commit_limit: int | None = None,
) -> Evaluation | None:
    rows = commit_feature_table(commits, identifiers, comments, vectors, k, commit_limit)
    classes = sorted(COMMIT_LABELS)
    return fit_and_evaluate(rows, ["commit_hash"], commit_feature_names(k), classes, "M1 MODEL REPORT", model_type,
                            max_depth)
