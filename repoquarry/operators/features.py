"""Feature tables of the two classifiers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.stemming import with_stems
from ..functions.text import COMMIT_LABELS, is_feature_request, is_not_blank, label_of_words, word_counts, words
from ..functions.timing import life_span_seconds, resolution_bin
from ..session import materialize, release, stored
from .joins import frequent_join
from .leading import first_rows
from .range_count import count_in_windows

# Names of the resolution-time features.
ISSUE_FEATURES = ("description_length", "comment_count", "concurrent_commits", "is_feature_request",
                  "commits_in_lifespan")


TERM_PARTS = 4  # the tasks that the terms of one commit are dealt to


def commit_feature_names(k: int) -> list[str]:
    return [*[f"cluster_{i}_frac" for i in range(k)], "log_token_count", "type_token_ratio", "id_overlap",
            "comment_overlap"]


def _distinct_count(vocabulary: DataFrame | None) -> Column:
    if vocabulary is None:
        return F.lit(0)
    return vocabulary.select(F.countDistinct("token")).scalar()


def token_profile(
    tokens: DataFrame,
    clusters: DataFrame,
    identifier_vocabulary: DataFrame | None,
    comment_vocabulary: DataFrame | None,
    stem: bool,
) -> DataFrame:
    """What each distinct token stands for: the columns of ``tokens`` and (term, cluster, in_ids, in_comments).

    ``term`` is the stem, or the token itself. The three vocabularies hold terms;
    they meet in one aggregation, so documents are joined only once.
    """
    terms = with_stems(tokens, stem="term") if stem else tokens.withColumn("term", F.col("token"))
    empty = F.lit(None).cast("int")
    parts = [clusters.select(F.col("token").alias("term"), F.col("cluster").cast("int").alias("cluster"),
                             F.lit(False).alias("in_ids"), F.lit(False).alias("in_comments"))]
    for vocabulary, name in ((identifier_vocabulary, "in_ids"), (comment_vocabulary, "in_comments")):
        if vocabulary is not None:
            flags = [F.lit(flag == name).alias(flag) for flag in ("in_ids", "in_comments")]
            parts.append(vocabulary.select(F.col("token").alias("term"), empty.alias("cluster"), *flags))
    known = parts[0]
    for part in parts[1:]:
        known = known.unionByName(part)
    known = known.groupBy("term").agg(
        F.max("cluster").alias("cluster"), F.max("in_ids").alias("in_ids"), F.max("in_comments").alias("in_comments")
    )
    return terms.join(known, "term", "left").select(
        *tokens.columns, "term", "cluster",
        F.coalesce("in_ids", F.lit(False)).alias("in_ids"),
        F.coalesce("in_comments", F.lit(False)).alias("in_comments"),
    )


def coded_profile(profile: DataFrame, k: int, numbered: bool) -> DataFrame:
    """(token, weight, code) of a materialized ``token_profile``; materialized.

    A code is one long: the number of the term (0 if not ``numbered``), the cluster (``k`` if it is none below that) and
    the two flags. Rows of the size of the tokens are shuffled with it in place of five columns.
    """
    cluster = F.when(F.col("cluster").between(0, k - 1), F.col("cluster")).otherwise(k)
    marks = cluster * 4 + F.col("in_ids").cast("int") * 2 + F.col("in_comments").cast("int")
    if not numbered:
        return materialize(profile.select("token", "weight", marks.cast("long").alias("code")))
    terms = materialize(profile.select("term").distinct()).withColumn("__number", F.monotonically_increasing_id())
    return materialize(profile.join(terms, "term").select("token", "weight", (F.col("__number") * (4 * k + 4) + marks).alias("code")))


def commit_tokens(commits: DataFrame, key: str, message: str) -> DataFrame:
    """(key, label, token, n): every commit's label and distinct tokens, from one split of its message.

    All tokens of a commit stand in one row, so nothing is shuffled to count them. A commit without
    tokens has one row with a null token.
    """
    split = commits.select(key, words(F.col(message)).alias("__words"))
    counted = split.select(key, label_of_words(F.col("__words")).alias("label"), word_counts(F.col("__words")).alias("__counts"))
    return counted.select(key, "label", F.explode_outer("__counts").alias("__token")).select(
        key, "label", "__token.token", "__token.n"
    )


def token_weights(tokens: DataFrame) -> DataFrame:
    """(token, weight): the distinct tokens of ``commit_tokens`` and how often they occur; materialized, as several steps read it."""
    return materialize(tokens.where(F.col("token").isNotNull()).groupBy("token").agg(F.sum("n").alias("weight")))


def commit_features(
    commits: DataFrame,
    key: str,
    message: str,
    clusters: DataFrame,
    k: int = 5,
    identifier_vocabulary: DataFrame | None = None,
    comment_vocabulary: DataFrame | None = None,
    stem: bool = True,
    tokens: DataFrame | None = None,
    weights: DataFrame | None = None,
) -> DataFrame:
    """Per commit: cluster shares, log token count, type-token ratio, overlaps, label.

    ``tokens`` is the stored result of ``commit_tokens`` and ``weights`` their ``token_weights``, where the
    caller has them: every use then reads these instead of the messages. A commit without tokens has zeros everywhere. Labels are
    numbers in their order meanwhile, which a hash aggregate can keep.
    """
    pairs = stored(commit_tokens(commits, key, message)) if tokens is None else tokens
    weights = token_weights(pairs) if weights is None else weights
    profile = materialize(token_profile(weights, clusters, identifier_vocabulary, comment_vocabulary, stem))
    release(profile.sparkSession)
    profile = coded_profile(profile, k, stem)
    release(profile.sparkSession)
    labels = F.array(*map(F.lit, sorted(COMMIT_LABELS)))
    label = F.array_position(labels, F.col("label")).cast("int").alias("label")
    terms = frequent_join(pairs.select(key, label, "token", "n"), profile, "token").drop("token")
    n_ids, n_comments = _distinct_count(identifier_vocabulary), _distinct_count(comment_vocabulary)
    marks = F.pmod("code", F.lit(4 * k + 4))
    sums = {
        "n": F.sum("n"),
        "d": F.count("code"),
        "m_ids": F.sum(F.shiftright(marks, 1).bitwiseAND(1)),
        "m_comments": F.sum(marks.bitwiseAND(1)),
        **{f"c{i}": F.sum(F.when(F.shiftright(marks, 2) == i, F.col("n")).otherwise(0)) for i in range(k)},
    }
    if stem:  # several tokens of a commit may be one term
        # A commit's terms go to few tasks, side by side, and leave each as one row. Rows without a key may be many, and go anywhere.
        part = F.when(F.col(key).isNull(), F.col("code")).otherwise(F.pmod(F.floor(F.col("code") / (4 * k + 4)), F.lit(TERM_PARTS)))
        dealt = terms.withColumn("__part", part).repartition(key, "__part")
        merged = dealt.groupBy(key, "__part", "label", "code").agg(F.sum("n").alias("n"))
        parts = merged.groupBy(key, "__part").agg(F.max("label").alias("label"), *[total.alias(name) for name, total in sums.items()])
        counts = parts.groupBy(key).agg(F.max("label").alias("label"), *[F.sum(name).alias(name) for name in sums])
    else:
        counts = terms.groupBy(key).agg(F.max("label").alias("label"), *[total.alias(name) for name, total in sums.items()])
    counts = counts.withColumn("label", F.element_at(labels, F.col("label")))
    n, d = F.col("n"), F.col("d")
    features = counts.select(
        key,
        "label",
        *[(F.col(f"c{i}") / n).alias(f"cluster_{i}_frac") for i in range(k)],
        F.log1p(n.cast("double")).alias("log_token_count"),
        (d / n).alias("type_token_ratio"),
        (F.col("m_ids") / (d + n_ids - F.col("m_ids"))).alias("id_overlap"),
        (F.col("m_comments") / (d + n_comments - F.col("m_comments"))).alias("comment_overlap"),
    )
    return features.fillna(0.0, subset=commit_feature_names(k))


def commit_texts(commits: DataFrame, key: str, limit: int | None = None) -> DataFrame:
    """Commits with a message that is not blank; ``limit`` keeps the first keys."""
    kept = commits.where(is_not_blank(F.col("message"))).select(key, "message")
    return kept if limit is None else first_rows(kept, [key], limit)


def closed_issues(issues: DataFrame, key: Sequence[str], limit: int | None = None) -> DataFrame:
    """Issues with both timestamps; ``limit`` keeps the first keys."""
    kept = issues.where(F.col("closed_at").isNotNull() & F.col("created_at").isNotNull())
    return kept if limit is None else first_rows(kept, key, limit)


def with_life_span(issues: DataFrame) -> DataFrame:
    """Add ``seconds`` and drop issues without a valid life span."""
    return issues.withColumn("seconds", life_span_seconds(F.col("created_at"), F.col("closed_at"))).where(
        F.col("seconds") >= 0
    )


def life_span_report(issues: DataFrame) -> DataFrame:
    """One row: how many issues have a usable life span and how many are skipped."""
    usable = F.coalesce(life_span_seconds(F.col("created_at"), F.col("closed_at")) >= 0, F.lit(False))
    return issues.agg(
        F.count_if(usable).alias("n_used"), F.count_if(~usable).alias("n_skipped")
    )


def issue_features(issues: DataFrame, commits: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key columns, the five resolution-time features and the binned label.

    Two features hold the same commit count, as in the study this follows. The
    count covers all commits given; filter both tables to study one repository.
    """
    framed = with_life_span(issues).select(
        *key,
        "created_at",
        "closed_at",
        F.coalesce(F.length("body"), F.lit(0)).cast("double").alias("description_length"),
        F.coalesce("comments_count", F.lit(0)).cast("double").alias("comment_count"),
        is_feature_request(F.col("labels")).cast("double").alias("is_feature_request"),
        resolution_bin(F.col("seconds")).alias("label"),
    )
    counted = count_in_windows(framed, commits, "created_at", "closed_at", "commit_ts", key, "n_commits")
    n_commits = F.col("n_commits").cast("double")
    return counted.select(
        *key, "description_length", "comment_count", n_commits.alias("concurrent_commits"), "is_feature_request",
        n_commits.alias("commits_in_lifespan"), "label",
    )
