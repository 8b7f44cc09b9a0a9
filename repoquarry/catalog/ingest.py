"""Payload readers, commit logs, file filter and table checks."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.integrity import duplicate_keys, integrity_counts
from ..operators.joins import orphan_parents
from ..operators.markup import source_files
from ..sources import gitlog, payloads
from ..sources.tables import read_table
from . import query
from .adaptors import EVENTS_SQL, events, iso, micros

PAGE = 50


def pages(items: DataFrame, field: str | None = None, *keys: str) -> DataFrame:
    """Response pages of at most 50 items, as JSON text; the item id makes the page number."""
    page = items.groupBy(F.floor(F.col("item_id") / PAGE).alias("page"), *keys).agg(
        F.collect_list("item").alias("items")
    )
    return page.select(*keys, F.to_json("items" if field is None else F.struct(F.col("items").alias(field))).alias("json"))


@query("issues_from_json", f"""WITH {EVENTS_SQL}
SELECT CAST(event_id AS INTEGER) AS issue_number, event_type || ' ' || user_id AS title, CASE WHEN k % 3 = 0 THEN '' ELSE props END AS body,
       CASE WHEN k % 5 <> 0 THEN 'User' || user_id END AS author, CASE WHEN k % 2 = 0 THEN 'closed' ELSE 'open' END AS state,
       k AS comments_count, event_type || ',k' || k AS labels, epoch_us(date_trunc('second', ts)) AS created_us,
       CASE WHEN k % 2 = 0 THEN epoch_us(date_trunc('second', ts)) END AS closed_us, CASE WHEN k % 4 = 0 THEN 'done' END AS state_reason
FROM ev WHERE event_type <> 'view'""")
def issues_from_json(spark, folder):
    e = events(spark, folder)
    item = F.struct(
        F.col("event_id").alias("number"),
        F.concat("event_type", F.lit("\x00 "), "user_id").alias("title"),
        F.when(F.col("k") % 3 != 0, F.col("props")).alias("body"),
        F.when(F.col("k") % 5 != 0, F.struct(F.concat(F.lit("User"), "user_id").alias("login"))).alias("user"),
        F.when(F.col("k") % 2 == 0, "closed").alias("state"),
        F.when(F.col("k") % 4 == 0, "done").alias("state_reason"),
        F.col("k").alias("comments"),
        # a label that is a text stands before one that is an object
        F.array(F.col("event_type").cast("variant"), F.to_variant_object(F.struct(F.col("event_type").alias("name"))),
                F.to_variant_object(F.struct(F.concat(F.lit("k"), "k").alias("name")))).alias("labels"),
        iso(F.col("at")).alias("created_at"),
        F.when(F.col("k") % 2 == 0, iso(F.col("at"))).alias("closed_at"),
        F.when(F.col("event_type") == "view", F.struct(F.lit("link").alias("url"))).alias("pull_request"),
    )
    rows = payloads.issue_rows(pages(e.select(F.col("event_id").alias("item_id"), item.alias("item"))))
    return rows.withColumns({"created_us": micros("created_at"), "closed_us": micros("closed_at")}).drop(
        "created_at", "closed_at"
    )


@query("pulls_state", f"""WITH {EVENTS_SQL}
SELECT CAST(event_id AS INTEGER) AS pr_number, event_type AS title, 'User' || user_id AS author,
       CASE WHEN k % 3 = 2 THEN 'merged' WHEN k % 2 = 0 THEN 'closed' ELSE 'open' END AS state,
       CASE WHEN k % 3 = 2 THEN epoch_us(date_trunc('second', ts)) END AS merged_us, epoch_us(date_trunc('second', ts)) AS created_us,
       CASE WHEN k % 5 = 0 THEN epoch_us(date_trunc('second', ts)) END AS closed_us
FROM ev""")
def pulls_state(spark, folder):
    e = events(spark, folder)
    merged = F.when(F.col("k") % 3 == 1, "").when(F.col("k") % 3 == 2, iso(F.col("at")))
    item = F.struct(
        F.col("event_id").alias("number"),
        F.col("event_type").alias("title"),
        F.struct(F.concat(F.lit("User"), "user_id").alias("login")).alias("user"),
        F.when(F.col("k") % 2 == 0, "closed").alias("state"),
        iso(F.col("at")).alias("created_at"),
        merged.alias("merged_at"),
        F.when(F.col("k") % 5 == 0, iso(F.col("at"))).alias("closed_at"),
    )
    rows = payloads.pull_rows(pages(e.select(F.col("event_id").alias("item_id"), item.alias("item"))))
    return rows.select("pr_number", "title", "author", "state", *(micros(f"{c}_at").alias(f"{c}_us") for c in ("merged", "created", "closed")))


@query("run_status", f"""WITH {EVENTS_SQL}
SELECT CAST(event_id AS VARCHAR) AS pipeline_id, CASE WHEN k % 3 = 0 THEN 'success' WHEN k % 2 = 0 THEN 'queued'
       ELSE 'unknown' END AS status, md5(CAST(user_id AS VARCHAR)) AS sha, epoch_us(date_trunc('second', ts)) AS created_us,
       CASE WHEN k % 2 = 1 THEN epoch_us(date_trunc('second', ts)) END AS updated_us
FROM ev""")
def run_status(spark, folder):
    e = events(spark, folder)
    item = F.struct(
        F.col("event_id").alias("id"),
        F.when(F.col("k") % 3 == 0, "success").when(F.col("k") % 3 == 1, "").alias("conclusion"),
        F.when(F.col("k") % 2 == 0, "queued").when(F.col("k") % 5 == 0, "").alias("status"),
        iso(F.col("at")).alias("created_at"),
        F.when(F.col("k") % 2 == 1, iso(F.col("at"))).alias("updated_at"),
        F.md5(F.col("user_id").cast("string")).alias("head_sha"),
    )
    rows = payloads.run_rows(pages(e.select(F.col("event_id").alias("item_id"), item.alias("item")), "workflow_runs"))
    return rows.select("pipeline_id", "status", "sha", micros("created_at").alias("created_us"), micros("updated_at").alias("updated_us"))


@query("job_rows", f"""WITH {EVENTS_SQL}
SELECT CAST(user_id AS VARCHAR) AS pipeline_id, CAST(event_id AS VARCHAR) AS job_id, event_type AS name,
       CASE WHEN k % 2 = 0 THEN 'done' ELSE 'running' END AS status, epoch_us(date_trunc('second', ts)) AS started_us,
       CASE WHEN k % 2 = 0 THEN epoch_us(date_trunc('second', ts)) END AS finished_us,
       CASE WHEN k % 2 = 0 THEN k * 731 // 1000 END AS duration_seconds
FROM ev""")
def job_rows(spark, folder):
    e = events(spark, folder)
    done = F.col("k") % 2 == 0
    item = F.struct(
        F.col("event_id").alias("id"),
        F.col("event_type").alias("name"),
        F.when(done, "done").alias("conclusion"),
        F.lit("running").alias("status"),
        iso(F.col("at")).alias("started_at"),
        F.when(done, iso(F.col("at"))).alias("completed_at"),
        F.when(done, F.col("k") * 731).alias("duration_ms"),
    )
    listed = pages(e.select("user_id", F.col("event_id").alias("item_id"), item.alias("item")), "jobs", "user_id")
    rows = payloads.job_rows(listed, "user_id")
    return rows.select("pipeline_id", "job_id", "name", "status", micros("started_at").alias("started_us"), micros("finished_at").alias("finished_us"),
                       "duration_seconds")


def log(spark, folder) -> DataFrame:
    """Orders as a commit log: up to three files, at most two parents, diffs for some files."""
    o = read_table(spark, folder, "orders")
    key = F.col("o_orderkey")

    def name(i):
        return F.concat(F.lit("src/f"), i, F.lit(".java"))

    numbers = F.sequence(F.lit(1), (F.lit(1) + key % 3).cast("int"))
    files = F.transform(numbers, lambda i: F.struct(
        name(i).alias("path"), ((key * i) % 50).cast("int").alias("insertions"),
        ((F.col("o_custkey") + i) % 20).cast("int").alias("deletions")))
    diffs = F.transform(F.filter(numbers, lambda i: (key + i) % 2 == 0), lambda i: F.struct(
        name(i).alias("a_path"), F.when(key % 3 != 0, name(i)).alias("b_path"),
        F.when(key % 5 != 0, F.lower(F.substring("o_orderstatus", 1, 1))).alias("change_type")))
    back = F.filter(F.array(key - 1, key * 2), lambda p: key % 10 > F.when(p == key - 1, 0).otherwise(6))
    return o.select(
        F.md5(key.cast("string")).alias("hash"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).otherwise("").alias("author"),
        F.concat(F.lit(" \n"), "o_orderstatus", F.lit(" "), key, F.lit("\t")).alias("message"),
        F.unix_seconds(F.col("o_orderdate").cast("timestamp")).alias("epoch"),
        F.transform(back, lambda p: F.md5(p.cast("string"))).alias("parents"),
        files.alias("files"),
        diffs.alias("diffs"),
    )


COMMIT_SQL = """SELECT md5(CAST(o_orderkey AS VARCHAR)) AS commit_hash,
       CASE WHEN o_orderpriority = '5-LOW' THEN 'unknown' ELSE o_orderpriority END AS author_name,
       o_orderstatus || ' ' || o_orderkey AS message, CAST(epoch(o_orderdate) AS BIGINT) AS epoch
FROM orders"""
PARENT_SQL = """SELECT md5(CAST(o_orderkey AS VARCHAR)) AS commit_hash, md5(CAST(o_orderkey * factor - step AS VARCHAR)) AS parent_hash
FROM orders, (VALUES (1, 1, 0), (2, 0, 6)) AS s(factor, step, floor) WHERE o_orderkey % 10 > floor"""
FILE_SQL = """SELECT o_orderkey, o_custkey, o_orderstatus, unnest(range(1, 2 + o_orderkey % 3)) AS i FROM orders"""


@query("commit_rows", COMMIT_SQL)
def commit_rows(spark, folder):
    rows = gitlog.commit_rows(log(spark, folder))
    return rows.withColumn("epoch", F.unix_seconds("commit_ts")).drop("commit_ts")


@query("commit_parents", PARENT_SQL)
def commit_parents(spark, folder):
    return gitlog.parent_rows(log(spark, folder))


@query("commit_stats", f"""SELECT md5(CAST(o_orderkey AS VARCHAR)) AS commit_hash, CAST(count(*) AS INTEGER) AS files_changed,
       CAST(sum((o_orderkey * i) % 50) AS INTEGER) AS insertions, CAST(sum((o_custkey + i) % 20) AS INTEGER) AS deletions
FROM ({FILE_SQL}) GROUP BY o_orderkey""")
def commit_stats(spark, folder):
    return gitlog.stat_rows(log(spark, folder))


@query("commit_files", f"""SELECT md5(CAST(o_orderkey AS VARCHAR)) AS commit_hash, 'src/f' || i || '.java' AS file_path,
       CASE WHEN o_orderkey % 10 = 0 THEN 'A' WHEN (o_orderkey + i) % 2 <> 0 OR o_orderkey % 5 = 0 THEN 'M'
            ELSE upper(o_orderstatus[1]) END AS change_type,
       CAST((o_orderkey * i) % 50 AS INTEGER) AS additions, CAST((o_custkey + i) % 20 AS INTEGER) AS deletions
FROM ({FILE_SQL})""")
def commit_files(spark, folder):
    return gitlog.file_rows(log(spark, folder))


@query("oldest_commits", f"""SELECT commit_hash, epoch FROM ({COMMIT_SQL}) ORDER BY epoch, commit_hash LIMIT 99""")
def oldest_commits(spark, folder):
    rows = gitlog.commit_rows(gitlog.oldest_commits(log(spark, folder), None, depth=100))
    return rows.select("commit_hash", F.unix_seconds("commit_ts").alias("epoch"))


@query("source_files", """SELECT file_path FROM (
    SELECT replace(p_name, ' ', '/') || p_partkey || ['.java', '.c', '.py', '.CPP', '.cxx', '.md', '.tar.cs'][1 + p_partkey % 7]
        AS file_path FROM part)
WHERE regexp_matches(file_path, '[.](c|cpp|cxx|cs|java)$')""")
def source_paths(spark, folder):
    endings = F.array(*map(F.lit, (".java", ".c", ".py", ".CPP", ".cxx", ".md", ".tar.cs")))
    ending = F.element_at(endings, (F.col("p_partkey") % 7 + 1).cast("int"))
    paths = read_table(spark, folder, "part", ["p_name", "p_partkey"]).select(
        F.concat(F.translate("p_name", " ", "/"), "p_partkey", ending).alias("file_path")
    )
    return source_files(paths)


@query("orphan_parents", f"""SELECT parent_hash, count(*) AS links FROM ({PARENT_SQL}) p
WHERE NOT EXISTS (SELECT 1 FROM ({COMMIT_SQL}) c WHERE c.commit_hash = p.parent_hash) GROUP BY parent_hash""")
def orphans(spark, folder):
    history = log(spark, folder)
    return orphan_parents(gitlog.parent_rows(history), gitlog.commit_rows(history))


@query("integrity_counts", f"""SELECT (SELECT count(*) FROM orders) AS n_commits, (SELECT count(*) FROM orders) AS n_stats,
    (SELECT count(*) FROM ({PARENT_SQL}) p
     WHERE NOT EXISTS (SELECT 1 FROM ({COMMIT_SQL}) c WHERE c.commit_hash = p.parent_hash)) AS n_orphan_parents""")
def integrity(spark, folder):
    history = log(spark, folder)
    return integrity_counts(gitlog.commit_rows(history), gitlog.stat_rows(history), gitlog.parent_rows(history))


@query("duplicate_keys", """SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def duplicates(spark, folder):
    return duplicate_keys(read_table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])
