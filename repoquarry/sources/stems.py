"""A stored dictionary of stems that grows with the corpus.

Stemming is the dear part of a vocabulary, and a new batch brings few words that were never seen. The dictionary is a table
(token, stem) in buckets of the token. A batch is reduced to its distinct words, those that are stored are taken out by an anti join
of narrow rows, and only the rest is stemmed and merged into the buckets it falls into.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.stemming import with_stems
from ..operators.joins import frequent_join, key_weights
from ..session import materialize
from .keyed import BUCKETS, KeyedTable


class StemDictionary:
    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.table = KeyedTable(spark, path, ["token"], buckets)

    def grow(self, tokens: DataFrame) -> int:
        """Add the stems of the words in the column ``token`` that are not stored, and return how many were stemmed. Null is no word."""
        words = tokens.select("token").where(F.col("token").isNotNull()).distinct()
        known = self.table.read()
        new = words if known is None else words.join(known.select("token"), "token", "left_anti")
        stems = materialize(with_stems(new))
        n = stems.count()
        if n or known is None:
            self._add(stems)
        return n

    def _add(self, stems: DataFrame) -> None:
        """Store stems of words that are not stored; materialized."""
        self.table.merge(stems, lambda old, batch: batch if old is None else old.unionByName(batch), materialized=True)

    def _stems_of(self, words: DataFrame) -> DataFrame:
        """Distinct words with their stored ``stem``; a word that is ``new`` has the stem that is to be stored, and only it is stemmed."""
        known = self.table.read()
        if known is None:
            return with_stems(words).withColumn("new", F.lit(True))
        stored = known.select("token", F.col("stem").alias("__stored"), F.lit(True).alias("__known"))
        new = F.col("__known").isNull()
        found = with_stems(words.join(stored, "token", "left"))
        return found.select(*words.columns, F.when(new, F.col("stem")).otherwise(F.col("__stored")).alias("stem"), new.alias("new"))

    def stemmed_rows(self, tokens: DataFrame, spread_by: Sequence[str]) -> DataFrame:
        """Token rows with each token replaced by its stored stem, after the dictionary has grown by their words.

        The words are counted once and meet the dictionary once, which gives all their stems, and those that it has to
        grow by. The most frequent words are broadcast with their stems, and only rows of others are shuffled, so
        ``spread_by`` is not needed any more.
        """
        weights = materialize(key_weights(tokens, ["token"]))
        stems = materialize(self._stems_of(weights))
        self._add(stems.where(F.col("new")).select("token", "stem"))
        return frequent_join(tokens, stems.drop("new"), "token", "inner").drop("token").withColumnRenamed("stem", "token")
