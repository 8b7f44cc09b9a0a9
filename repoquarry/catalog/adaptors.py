"""Benchmark tables read as commits, issues, runs and texts; the SQL twins stand beside them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import STOP_WORDS
from ..sources.tables import read_table, read_texts

STOP_LIST = ", ".join(f"'{word}'" for word in STOP_WORDS)


def iso(column: Column) -> Column:
    """ISO text of a timestamp, with the zone letter."""
    return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss'Z'")


ISO_SQL = "strftime({0}, '%Y-%m-%dT%H:%M:%SZ')"


def micros(name: str) -> Column:
    return F.unix_micros(F.col(name).cast("timestamp"))


def events(spark: SparkSession, folder: str) -> DataFrame:
    """Events with the number in their JSON property as ``k`` and a zoned time ``at``."""
    frame = read_table(spark, folder, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    return frame.withColumn("k", k).withColumn("at", F.col("ts").cast("timestamp"))


EVENTS_SQL = "ev AS (SELECT *, CAST(props->>'$.k' AS INTEGER) AS k FROM events)"


def issues(spark: SparkSession, folder: str) -> DataFrame:
    """Every event as an issue: open, closed early, late or before it was created."""
    e = events(spark, folder)
    n = F.pmod(F.col("event_id") * 7919, F.lit(1000))
    span = (
        F.when(F.col("event_type") == "click", n * 3)
        .when(F.col("event_type") == "error", n * 80)
        .when(F.col("event_type") == "view", n * 600)
        .when(F.col("event_type") == "signup", n * 2600)
        .otherwise(n * 5000)
    )
    span = F.when(F.col("k") < 3, -span).when(F.col("k") > 5, span)
    return e.select(
        F.lit("tracker").alias("provider"),
        F.concat(F.lit("r"), F.pmod("user_id", F.lit(7))).alias("repo"),
        F.col("event_id").alias("issue_number"),
        F.concat(F.lit("# "), "event_type", F.lit(" `"), "props", F.lit("`  for\t "), "user_id").alias("title"),
        F.when(F.col("k") % 9 != 0, F.repeat("props", F.col("k") % 5)).alias("body"),
        F.concat(F.lit(" "), F.initcap("event_type"), "user_id",
                 F.when(F.col("k") % 7 == 0, "[bot]").otherwise("\t")).alias("author"),
        F.when(span.isNull(), "open").otherwise("closed").alias("state"),
        F.lit(None).cast("string").alias("state_reason"),
        F.col("k").alias("comments_count"),
        F.concat(F.lit("bug, "), F.when(F.col("k") % 4 == 0, "Enhancement ").otherwise(F.col("event_type"))).alias(
            "labels"),
        F.col("at").alias("created_at"),
        F.timestamp_micros(F.unix_micros("at") + span * 1_000_000).alias("closed_at"),
    )


ISSUES_SQL = EVENTS_SQL + """,
spans AS (
    SELECT *, CASE event_type WHEN 'click' THEN n * 3 WHEN 'error' THEN n * 80 WHEN 'view' THEN n * 600
                              WHEN 'signup' THEN n * 2600 ELSE n * 5000 END AS size
    FROM (SELECT *, (event_id * 7919) % 1000 AS n FROM ev)),
timed AS (SELECT *, CASE WHEN k < 3 THEN -size WHEN k > 5 THEN size END AS span FROM spans),
issues AS (
    SELECT 'tracker' AS provider, 'r' || (user_id % 7) AS repo, event_id AS issue_number,
           '# ' || event_type || ' `' || props || '`  for' || chr(9) || ' ' || user_id AS title,
           CASE WHEN k % 9 <> 0 THEN repeat(props, k % 5) END AS body,
           ' ' || upper(event_type[1]) || event_type[2:] || user_id || CASE WHEN k % 7 = 0 THEN '[bot]' ELSE chr(9) END
               AS author,
           CASE WHEN span IS NULL THEN 'open' ELSE 'closed' END AS state, k AS comments_count,
           'bug, ' || CASE WHEN k % 4 = 0 THEN 'Enhancement ' ELSE event_type END AS labels,
           ts AS created_at, ts + to_seconds(span) AS closed_at
    FROM timed)"""


def commits(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as commits: a header in several styles, the text as subject and body."""
    d = read_texts(spark, folder, "documents", ["doc_id", "text", "lang", "source"])
    style = F.pmod("doc_id", F.lit(4))
    head = (
        F.when(style == 0, F.concat(F.lit("Fix("), "lang", F.lit(")!: ")))
        .when(style == 1, F.concat(F.lit("feat: `"), "source", F.lit("` ")))
        .when(style == 2, F.concat("lang", F.lit(" : ")))
        .otherwise("")
    )
    return d.select(
        "doc_id",
        F.md5(F.col("doc_id").cast("string")).alias("commit_hash"),
        F.col("source").alias("author_name"),
        F.concat(head, "text").alias("message"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id") * 997).alias("commit_ts"),
    )


COMMITS_SQL = """commits AS (
    SELECT doc_id, md5(CAST(doc_id AS VARCHAR)) AS commit_hash, source AS author_name,
           CASE doc_id % 4 WHEN 0 THEN 'Fix(' || lang || ')!: ' WHEN 1 THEN 'feat: `' || source || '` '
                           WHEN 2 THEN lang || ' : ' ELSE '' END || text AS message,
           make_timestamp((1704067200 + doc_id * 997) * 1000000) AS commit_ts
    FROM documents)"""


def identifier_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Words of the documents, as written, as identifiers of the file named after the source."""
    d = read_texts(spark, folder, "documents", ["doc_id", "text", "source"])
    words = F.regexp_extract_all("text", F.lit(r"([\p{L}\p{N}_]+)"), 1)
    return d.select(F.col("source").alias("file_path"), "doc_id", F.posexplode(words).alias("pos", "name"))


IDENTIFIERS_SQL = r"""identifiers AS (
    SELECT source AS file_path, doc_id, unnest(regexp_extract_all(text, '[\p{L}\p{N}_]+')) AS name FROM documents)"""


def tokens_sql(name: str, rows: str, key: str, text: str) -> str:
    """CTE ``name`` with the vocabulary tokens of a text column: key, pos (from 0), token."""
    return rf"""{name}_words AS (
    SELECT {key}, unnest(words) AS token, unnest(range(len(words))) AS pos
    FROM (SELECT {key}, regexp_extract_all(lower(coalesce({text}, '')), '[\p{{L}}\p{{N}}_]+') AS words FROM {rows})),
{name} AS (
    SELECT {key}, pos, token FROM {name}_words
    WHERE length(token) >= 3 AND NOT regexp_full_match(token, '\p{{Nd}}+') AND token NOT IN ({STOP_LIST}))"""


def token_label(tokens: DataFrame, spark: SparkSession, folder: str, salt: str = "") -> DataFrame:
    """Add the label of the embedding that a token's hash points at.

    Embedding ids are a range from 0, so the number of embeddings as modulus maps
    tokens to all of them; the planner sees the size of the embeddings file and
    picks the join by it.
    """
    labels = read_table(spark, folder, "embeddings", ["vec_id", "label"])
    return with_vec_id(tokens, spark, folder, salt).join(labels, "vec_id").drop("vec_id")


def with_vec_id(tokens: DataFrame, spark: SparkSession, folder: str, salt: str = "") -> DataFrame:
    """Add ``vec_id``, the embedding that a token's hash points at."""
    n_vectors = read_table(spark, folder, "embeddings", ["vec_id"]).select(F.count("*")).scalar()
    digits = F.substring(F.md5(F.concat("token", F.lit(salt))), 1, 6)
    return tokens.withColumn("vec_id", F.pmod(F.conv(digits, 16, 10).cast("long"), n_vectors))


def vec_id_sql(token: str, salt: str = "") -> str:
    return f"CAST('0x' || substr(md5({token} || '{salt}'), 1, 6) AS BIGINT) % (SELECT count(*) FROM embeddings)"
