"""Token tables, vocabularies, cluster inspection and cross-source alignment."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stemming import porter_stem, with_stems
from ..functions.text import STOP_WORDS, keeps_word, words
from ..session import BROADCAST_ROWS, materialize
from .joins import frequent_bar, key_weights


def token_rows(
    texts: DataFrame,
    keys: Sequence[str],
    text: str | Column,
    min_length: int = 3,
    stop_words: Sequence[str] = STOP_WORDS,
) -> DataFrame:
    """One row per unstemmed vocabulary token: the keys, ``pos`` in the text, ``token``."""
    column = F.col(text) if isinstance(text, str) else text
    exploded = texts.select(*keys, F.posexplode(words(column)).alias("pos", "token"))
    return exploded.where(keeps_word(F.col("token"), min_length, stop_words))


def stemmed_rows(tokens: DataFrame, spread_by: Sequence[str]) -> DataFrame:
    """Token rows with each token replaced by its stem; ``spread_by`` is not needed any more.

    The stems of the most frequent tokens are broadcast, at most ``BROADCAST_ROWS`` of them. A token
    that is not among them is stemmed where it stands, so no row is shuffled.
    """
    weights = materialize(key_weights(tokens, ["token"]))
    frequent = with_stems(weights.where(F.col("weight") >= frequent_bar(weights, BROADCAST_ROWS)).select("token"))
    joined = tokens.where(F.col("token").isNotNull()).join(F.broadcast(frequent), "token", "left")
    columns = [F.coalesce("stem", porter_stem(F.col("token"))).alias("token") if c == "token" else c for c in tokens.columns]
    return joined.select(*columns)


def vocabulary_table(tokens: DataFrame, order: Sequence[str], stem: bool = True) -> DataFrame:
    """Distinct tokens with their frequency ``n`` and first place ``first`` (a struct of ``order``).

    Occurrences are counted before they are stemmed, so the shuffles carry
    distinct tokens and nothing is joined back. Whole-number order columns are packed
    into one decimal, which a hash aggregate can keep; a struct would have every
    occurrence sorted.
    """
    packed, unpacked = _packed_place(tokens, order)
    counted = tokens.groupBy("token").agg(F.count("*").alias("n"), F.min(packed).alias("first"))
    if stem:
        stems = with_stems(counted).select(F.col("stem").alias("token"), "n", "first")
        counted = stems.groupBy("token").agg(F.sum("n").alias("n"), F.min("first").alias("first"))
    return counted.select("token", "n", unpacked(F.col("first")).alias("first"))


def distinct_stems(tokens: DataFrame) -> DataFrame:
    """The stems of the tokens, each once, in the column ``token``.

    The distinct tokens are materialized: otherwise the optimizer drops their aggregation, since that of
    the stems follows, and every occurrence is stemmed.
    """
    found = materialize(tokens.select("token").distinct())
    return with_stems(found).select(F.col("stem").alias("token")).distinct()


_NULL = -(2**63)  # a null number, which comes first


def _packed_place(tokens: DataFrame, order: Sequence[str]) -> tuple[Column, Callable[[Column], Column]]:
    """A place as one value in the order of ``order``, and the struct of its columns again."""
    kinds = [tokens.schema[name].dataType.simpleString() for name in order]
    if len(order) != 2 or kinds[0] not in ("tinyint", "smallint", "int", "bigint") or kinds[1] not in ("tinyint", "smallint", "int"):
        return F.struct(*order), lambda place: place
    unit = F.lit(2**32).cast("decimal(12,0)")
    major = F.coalesce(F.col(order[0]).cast("bigint"), F.lit(_NULL)).cast("decimal(20,0)")
    minor = (F.coalesce(F.col(order[1]).cast("bigint"), F.lit(-(2**31))) + F.lit(2**31)).cast("decimal(12,0)")

    def unpacked(place: Column) -> Column:
        rest = F.pmod(place, unit)
        high = ((place - rest) / unit).cast("bigint")  # divides without a remainder
        low = rest.cast("bigint") - F.lit(2**31)
        return F.struct(F.nullif(high, F.lit(_NULL)).cast(kinds[0]).alias(order[0]),
                        F.nullif(low, F.lit(-(2**31))).cast(kinds[1]).alias(order[1]))

    return (major * unit + minor).cast("decimal(38,0)"), unpacked


def vocabulary_totals(vocabulary: DataFrame, by: str) -> DataFrame:
    """Tokens and distinct tokens per source."""
    return vocabulary.groupBy(by).agg(F.sum("n").alias("n_tokens"), F.count("*").alias("n_distinct"))


def top_tokens(vocabulary: DataFrame, top_n: int = 10, by: Sequence[str] = ("cluster",)) -> DataFrame:
    """Most frequent tokens per cluster, ties by first occurrence.

    The rank limit prunes every task's rows before the shuffle, so a cluster with
    most of the vocabulary still sends ``top_n`` rows per task.
    """
    window = Window.partitionBy(*by).orderBy(F.desc("n"), "first", "token")
    ranked = vocabulary.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= top_n)
    return ranked.select(*by, "rank", "token", "n")


def top_token_lists(ranked: DataFrame, by: Sequence[str] = ("cluster",)) -> DataFrame:
    """The ranked tokens of each cluster as one array."""
    pairs = F.sort_array(F.collect_list(F.struct("rank", "token")))
    return ranked.groupBy(*by).agg(F.transform(pairs, lambda p: p["token"]).alias("tokens"))


def _pairs(n: Column) -> Column:
    return n.cast("double") * (n - 1) / F.lit(2.0)


def pairwise_alignment(labelled: DataFrame, sources: Sequence[str], keep_missing: bool = False) -> DataFrame:
    """Vocabulary overlap and cluster agreement of every pair of sources.

    ``labelled`` has source, token, label and pos; a token takes the label of its
    first place in a source. One aggregation by token lines the sources up, so
    nothing is joined; what follows are counts per pair of labels. A pair with an
    empty side is left out, or given zeros with ``keep_missing``.
    """
    marks = []
    for name in sources:
        here = F.col("source") == name
        marks.append(F.max(here).alias(f"in_{name}"))
        marks.append(F.min_by("label", F.when(here, F.col("pos"))).alias(f"label_{name}"))
    lined = labelled.where(F.col("source").isin(*sources)).groupBy("token").agg(*marks)
    sides = [
        F.struct(
            F.lit(a).alias("source_a"),
            F.lit(b).alias("source_b"),
            F.col(f"in_{a}").alias("in_a"),
            F.col(f"in_{b}").alias("in_b"),
            F.when(F.col(f"in_{a}"), F.col(f"label_{a}")).alias("label_a"),
            F.when(F.col(f"in_{b}"), F.col(f"label_{b}")).alias("label_b"),
        )
        for a, b in combinations(sources, 2)
    ]
    pair = ["source_a", "source_b"]
    table = (
        lined.select(F.inline(F.array(*sides)))
        .where(F.col("in_a") | F.col("in_b"))
        .groupBy(*pair, "in_a", "in_b", "label_a", "label_b")
        .agg(F.count("*").alias("n"))
    )
    both = F.col("in_a") & F.col("in_b")
    # every pair of labels, each label of either side and the total, in one pass
    margins = (
        table.withColumn("shared", F.when(both, F.col("n")).otherwise(0))
        .withColumn("label_a", F.when(both, F.col("label_a")))
        .withColumn("label_b", F.when(both, F.col("label_b")))
        .groupingSets(
            [[*pair, "label_a", "label_b"], [*pair, "label_a"], [*pair, "label_b"], pair],
            *pair, "label_a", "label_b",
        )
        .agg(
            F.grouping_id().alias("level"),
            F.sum("shared").alias("shared"),
            F.sum(F.when(F.col("in_a"), F.col("n")).otherwise(0)).alias("size_a"),
            F.sum(F.when(F.col("in_b"), F.col("n")).otherwise(0)).alias("size_b"),
        )
    )
    shared = F.col("shared")

    def summed(level: int) -> Column:
        return F.sum(F.when(F.col("level") == level, _pairs(shared)))

    def total(name: str) -> Column:
        return F.max(F.when(F.col("level") == 3, F.col(name)))

    sums = margins.groupBy(*pair).agg(
        summed(0).alias("both"), summed(1).alias("rows"), summed(2).alias("cols"), summed(3).alias("all"),
        total("shared").alias("shared"), total("size_a").alias("size_a"), total("size_b").alias("size_b"),
    )
    expected = F.try_divide(F.col("rows") * F.col("cols"), F.col("all"))
    ceiling = (F.col("rows") + F.col("cols")) / 2
    agreement = F.coalesce(F.try_divide(F.col("both") - expected, ceiling - expected), F.lit(1.0))
    union = F.col("size_a") + F.col("size_b") - shared
    result = sums.where((F.col("size_a") > 0) & (F.col("size_b") > 0) | F.lit(keep_missing)).select(
        *pair,
        (shared / union).alias("vocab_overlap"),
        shared.cast("long").alias("shared_vocab_size"),
        F.when(shared < 2, F.lit(0.0)).otherwise(agreement).alias("cluster_similarity"),
    )
    if not keep_missing:
        return result
    wanted = labelled.sparkSession.range(1).select(
        F.inline(F.array(*[F.struct(F.lit(a).alias("source_a"), F.lit(b).alias("source_b"))
                           for a, b in combinations(sources, 2)]))
    )
    zeros = {"vocab_overlap": 0.0, "shared_vocab_size": 0, "cluster_similarity": 0.0}
    return wanted.join(result, pair, "left").fillna(zeros)


def measure_alignment(side_a: DataFrame, side_b: DataFrame) -> DataFrame:
    """One row of alignment measures of two labelled vocabularies (token, label, pos)."""
    columns = ["token", "label", "pos"]
    labelled = side_a.select(F.lit("a").alias("source"), *columns).unionByName(
        side_b.select(F.lit("b").alias("source"), *columns)
    )
    return pairwise_alignment(labelled, ["a", "b"], keep_missing=True).drop("source_a", "source_b")


def shared_vocabulary(side_a: DataFrame, side_b: DataFrame) -> DataFrame:
    """Tokens of both labelled vocabularies with their first label on either side."""

    def first_label(side: DataFrame, name: str) -> DataFrame:
        return side.groupBy("token").agg(F.min_by("label", "pos").alias(name))

    return first_label(side_a, "label_a").join(first_label(side_b, "label_b"), "token")


def vocabulary_union(*vocabularies: DataFrame) -> DataFrame:
    """Distinct tokens of all vocabularies."""
    union = vocabularies[0].select("token")
    for vocabulary in vocabularies[1:]:
        union = union.unionByName(vocabulary.select("token"))
    return union.distinct()


def vocabulary_intersection(side_a: DataFrame, side_b: DataFrame) -> DataFrame:
    return side_a.select("token").intersect(side_b.select("token"))
