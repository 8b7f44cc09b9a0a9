"""URL filters: host-suffix and path-prefix rules by hash prefixes.

Each distinct (host, path) is expanded into the host suffixes and path prefixes that
some rule could name: suffixes of as many labels and prefixes of as many characters
as rules have, so the expansion is exact and its size depends on the rules alone.
Expressions meet rules in an equi-join on the first hex digits of their SHA-256; the
full digests then decide. The longest matching rule wins. Everything is built from
DataFrame functions. A url that fills a third of the table is expanded once, and the
join back to the pages is a plain left join that adaptive execution may split.

Defined cases: a null url or one without ``://`` has an empty host and path and fits
no rule; an empty rule table gives every row the default; repeated rows get the same
verdict; of two rules with the same host and path, ``block`` wins; rules without a host
are ignored; an empty page table gives an empty table; a very long url is a row like any other, as only as many
characters are expanded as rules have. Other columns, whatever their names, are not touched: the three results
replace columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PREFIX_DIGITS = 8  # hex digits of the hash prefix: 4 bytes


def host_of(url: Column) -> Column:
    rest = F.when(F.contains(url, F.lit("://")), F.substring_index(url, "://", 1))
    after = F.substr(url, F.length(rest) + 4)
    return F.coalesce(F.translate(F.regexp_extract(after, r"^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    rest = F.when(F.contains(url, F.lit("://")), F.substring_index(url, "://", 1))
    after = F.substr(url, F.length(rest) + 4)
    return F.coalesce(F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, path), 256)  # unambiguous: a host has no slash, a path begins with one


def judge_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (host + path of the rule, or null) and ``verdict``.

    ``rules``: columns host, path, verdict (``allow`` or ``block``).
    """
    known = (
        rules.filter("host <> ''")
        .select(F.translate("host", UPPER, LOWER).alias("rule_host"), F.coalesce("path", F.lit("")).alias("rule_path"), "verdict")
        .groupBy("rule_host", "rule_path")
        .agg(F.max("verdict").alias("rule_verdict"))  # block > allow
        .withColumn("digest", _digest(F.col("rule_host"), F.col("rule_path")))
        .withColumn("prefix", F.substring("digest", 1, PREFIX_DIGITS))
    )
    # One row; label and character counts of rules are bounded by the longest host and path.
    shape = known.agg(
        F.sort_array(F.collect_set(F.size(F.split("rule_host", r"\.")))).alias("labels"),
        F.sort_array(F.collect_set(F.length("rule_path"))).alias("lengths"),
    ).first()
    labels = F.array(*map(F.lit, shape["labels"])) if shape["labels"] else F.array().cast("array<int>")
    lengths = F.array(*map(F.lit, shape["lengths"])) if shape["lengths"] else F.array().cast("array<int>")
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict") or c == url_col]
    split = pages.select(*(F.col(f"`{c}`") for c in kept), host_of(F.col(f"`{url_col}`")).alias("host"), path_of(F.col(f"`{url_col}`")).alias("path"))
    distinct = split.select("host", "path").filter("host <> ''").distinct()
    parts = F.split("host", r"\.")
    expanded = (
        distinct.withColumn("n", F.explode(F.filter(labels, lambda k: k <= F.size(parts))))
        .withColumn("suffix", F.array_join(F.slice(parts, F.size(parts) - F.col("n") + 1, F.col("n")), "."))
        .withColumn("length", F.explode(F.filter(lengths, lambda k: k <= F.length("path"))))
        .withColumn("digest", _digest(F.col("suffix"), F.substr("path", F.lit(1), F.col("length"))))
        .select("host", "path", "digest", F.substring("digest", 1, PREFIX_DIGITS).alias("prefix"))
    )
    best = (
        expanded.alias("e")
        .join(known.alias("k"), "prefix")
        .filter("e.digest = k.digest")
        .groupBy("host", "path")
        .agg(
            F.max(
                F.struct(
                    (F.length("rule_host") + F.length("rule_path")).alias("size"),
                    F.length("rule_host").alias("host_size"),
                    F.concat("rule_host", "rule_path").alias("rule"),
                    F.col("rule_verdict").alias("verdict"),
                )
            ).alias("__best")
        )
    )
    return (
        split.join(best, ["host", "path"], "left")
        .select(*(F.col(f"`{c}`") for c in split.columns), F.col("__best.rule").alias("rule"), F.coalesce("__best.verdict", F.lit(default)).alias("verdict"))
    )
