"""Keyed merges: events before the middle of the month are stored, later ones arrive."""

import uuid

from pyspark.sql import functions as F

from ..operators import upsert as ops
from ..operators.upsert import Rules, upsert
from ..plans.mine import append_newest, run_row
from ..session import shared_folder
from ..sources import gitlog
from ..sources.keyed import KeyedTable
from . import query
from .adaptors import EVENTS_SQL, events, micros
from .ingest import COMMIT_SQL, log

MIDDLE = "2024-01-16"


def halves(rows, merge):
    """Merge the earlier events into nothing, then the later ones into the result."""
    early, late = rows.where(F.col("at") < F.lit(MIDDLE).cast("timestamp")), rows.where(
        F.col("at") >= F.lit(MIDDLE).cast("timestamp")
    )
    return merge(merge(None, early, "event_id"), late, "event_id")


# arrival order over both halves
SEQ_SQL = f"""{EVENTS_SQL},
seq AS (SELECT *, event_id + CASE WHEN ts >= TIMESTAMP '{MIDDLE}' THEN 1000000000 ELSE 0 END AS s FROM ev)"""


@query("upsert_keep_stored", f"""WITH {SEQ_SQL}
SELECT user_id, event_type, arg_min_null(value, s) AS value, arg_min_null(props, s) AS props
FROM seq GROUP BY user_id, event_type""")
def keep_stored(spark, folder):
    rules = Rules(("user_id", "event_type"), first=("value", "props"))
    return halves(events(spark, folder), lambda old, new, at: upsert(old, new, rules, at))


@query("upsert_key_set", """SELECT DISTINCT l_orderkey AS commit_hash, l_linenumber AS parent_hash FROM lineitem""")
def key_set(spark, folder):
    from ..sources.tables import read_table

    rows = read_table(spark, folder, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey"])
    rows = rows.withColumnsRenamed({"l_orderkey": "commit_hash", "l_linenumber": "parent_hash"})
    return upsert(None, rows, ops.COMMIT_PARENTS, "l_partkey")


ISSUE_MERGE_SQL = f"""WITH {SEQ_SQL}
SELECT event_type AS provider, 'r' || (user_id % 10) AS repo, user_id AS issue_number,
       arg_max_null(props, s) AS title, arg_max_null(CASE WHEN value >= 8 THEN props ELSE '' END, s) AS body,
       arg_max_null(CASE WHEN value >= 5 THEN 'u' || k END, s) AS author,
       arg_max_null(CASE WHEN k % 3 = 0 THEN 'closed' ELSE 'open' END, s) AS state,
       arg_max_null(CASE WHEN k % 3 = 0 THEN 'done' END, s) AS state_reason,
       arg_max_null(k, s) AS comments_count, arg_max_null(event_type || k, s) AS labels,
       epoch_us(min(ts)) AS created_us,
       epoch_us(arg_max(ts, s) FILTER (WHERE k % 3 = 0)) AS closed_us
FROM seq GROUP BY event_type, user_id"""


@query("upsert_issues", ISSUE_MERGE_SQL)
def issues(spark, folder):
    return _in_micros(halves(issue_arrivals(spark, folder), ops.upsert_issues))


@query("upsert_issues_by_bucket", ISSUE_MERGE_SQL)
def bucketed_issues(spark, folder):
    """The same merges into a stored table of which each rewrites only the buckets it falls into."""
    table = KeyedTable(spark, f"{shared_folder(spark)}/issues-{uuid.uuid4()}", ops.ISSUES.keys, buckets=16)
    rows = issue_arrivals(spark, folder)
    for half in (rows.where(F.col("at") < F.lit(MIDDLE).cast("timestamp")), rows.where(F.col("at") >= F.lit(MIDDLE).cast("timestamp"))):
        table.merge(half, lambda old, new: ops.upsert_issues(old, new, "event_id"))
    return _in_micros(table.read())


def _in_micros(table):
    return table.withColumns({"created_us": micros("created_at"), "closed_us": micros("closed_at")}).drop("created_at", "closed_at")


def issue_arrivals(spark, folder):
    return events(spark, folder).select(
        "event_id", "at", F.col("event_type").alias("provider"),
        F.concat(F.lit("r"), F.pmod("user_id", F.lit(10))).alias("repo"), F.col("user_id").alias("issue_number"),
        F.col("props").alias("title"), F.when(F.col("value") >= 8, F.col("props")).otherwise("").alias("body"),
        F.when(F.col("value") >= 5, F.concat(F.lit("u"), "k")).alias("author"),
        F.when(F.col("k") % 3 == 0, "closed").otherwise("open").alias("state"),
        F.when(F.col("k") % 3 == 0, "done").alias("state_reason"), F.col("k").alias("comments_count"),
        F.concat("event_type", "k").alias("labels"), F.col("at").alias("created_at"),
        F.when(F.col("k") % 3 == 0, F.col("at")).alias("closed_at"),
    )


@query("upsert_pulls", f"""WITH {SEQ_SQL}
SELECT event_type AS provider, 'r' || (user_id % 10) AS repo, user_id AS pr_number, arg_max_null(props, s) AS title,
       arg_max_null(CASE WHEN value >= 5 THEN 'u' || k END, s) AS author,
       arg_max_null(CASE WHEN k % 4 = 0 THEN 'merged' WHEN k % 2 = 0 THEN 'closed' ELSE 'open' END, s) AS state,
       epoch_us(min(ts)) AS created_us, epoch_us(arg_max(ts, s) FILTER (WHERE k % 4 = 0)) AS merged_us,
       epoch_us(arg_max(ts, s) FILTER (WHERE k % 2 = 0)) AS closed_us
FROM seq GROUP BY event_type, user_id""")
def pulls(spark, folder):
    rows = events(spark, folder).select(
        "event_id", "at", F.col("event_type").alias("provider"),
        F.concat(F.lit("r"), F.pmod("user_id", F.lit(10))).alias("repo"), F.col("user_id").alias("pr_number"),
        F.col("props").alias("title"), F.when(F.col("value") >= 5, F.concat(F.lit("u"), "k")).alias("author"),
        F.when(F.col("k") % 4 == 0, "merged").when(F.col("k") % 2 == 0, "closed").otherwise("open").alias("state"),
        F.col("at").alias("created_at"), F.when(F.col("k") % 4 == 0, F.col("at")).alias("merged_at"),
        F.when(F.col("k") % 2 == 0, F.col("at")).alias("closed_at"),
    )
    table = halves(rows, ops.upsert_pull_requests)
    return table.withColumns({name.replace("_at", "_us"): micros(name) for name in ("created_at", "merged_at", "closed_at")}).drop(
        "created_at", "merged_at", "closed_at"
    )


def run_arrivals(spark, folder):
    return events(spark, folder).select(
        "event_id", "at", F.lit("ci").alias("provider"), F.col("event_type").alias("repo"),
        F.col("user_id").alias("pipeline_id"), F.concat(F.lit("s"), F.col("k") % 4).alias("status"),
        F.col("at").alias("created_at"), F.when(F.col("k") % 2 == 0, F.col("at")).alias("updated_at"),
        F.when(F.col("value") >= 10, F.md5("props")).alias("sha"),
    )


def job_arrivals(spark, folder):
    return events(spark, folder).select(
        "event_id", "at", F.lit("ci").alias("provider"), F.col("event_type").alias("repo"),
        F.pmod(F.col("user_id") * 3, F.lit(200)).alias("pipeline_id"), F.col("user_id").alias("job_id"),
        F.concat(F.lit("job "), "k").alias("name"), F.concat(F.lit("s"), F.col("k") % 4).alias("status"),
        F.col("at").alias("started_at"), F.when(F.col("k") % 3 == 0, F.col("at")).alias("finished_at"),
        F.when(F.col("k") % 3 == 0, F.col("k")).alias("duration_seconds"),
    )


@query("upsert_ci_runs", f"""WITH {SEQ_SQL}
SELECT 'ci' AS provider, event_type AS repo, CAST(user_id AS VARCHAR) AS pipeline_id, arg_max_null('s' || (k % 4), s) AS status,
       epoch_us(min(ts)) AS created_us, epoch_us(arg_max(ts, s) FILTER (WHERE k % 2 = 0)) AS updated_us,
       arg_max(md5(props), s) FILTER (WHERE value >= 10) AS sha
FROM seq GROUP BY event_type, user_id""")
def ci_runs(spark, folder):
    table = halves(run_arrivals(spark, folder), ops.upsert_pipelines)
    return table.withColumns({"created_us": micros("created_at"), "updated_us": micros("updated_at")}).drop(
        "created_at", "updated_at"
    )


JOBS_SELECT = """'ci' AS provider, event_type AS repo, CAST(user_id AS VARCHAR) AS job_id,
       arg_min_null(CAST((user_id * 3) % 200 AS VARCHAR), s) AS pipeline_id, arg_min_null('job ' || k, s) AS name,
       arg_max_null('s' || (k % 4), s) AS status, epoch_us(arg_max(ts, s)) AS started_us,
       epoch_us(arg_max(ts, s) FILTER (WHERE k % 3 = 0)) AS finished_us,
       arg_max(k, s) FILTER (WHERE k % 3 = 0) AS duration_seconds"""


def _job_times(table):
    return table.withColumns({"started_us": micros("started_at"), "finished_us": micros("finished_at")}).drop(
        "started_at", "finished_at"
    )


@query("upsert_ci_jobs", f"WITH {SEQ_SQL} SELECT {JOBS_SELECT} FROM seq GROUP BY event_type, user_id")
def ci_jobs(spark, folder):
    return _job_times(halves(job_arrivals(spark, folder), ops.upsert_jobs))


@query("ingest_ci_jobs", f"""WITH {SEQ_SQL}
SELECT {JOBS_SELECT} FROM seq
WHERE EXISTS (SELECT 1 FROM ev r WHERE r.event_type = seq.event_type AND r.user_id = (seq.user_id * 3) % 200 AND r.user_id % 5 <> length(r.event_type) % 5)
GROUP BY event_type, user_id""")
def ingest_ci_jobs(spark, folder):
    # a run id that one repository lacks is there in others
    runs = run_arrivals(spark, folder).where(F.pmod("pipeline_id", F.lit(5)) != F.length("repo") % 5)
    _, jobs = ops.ingest_ci(None, None, runs, _middle_last(job_arrivals(spark, folder)), "event_id")
    return _job_times(jobs)


def _middle_last(rows):
    """Arrival numbers that put the later events after the earlier ones."""
    late = F.col("at") >= F.lit(MIDDLE).cast("timestamp")
    return rows.withColumn("event_id", F.col("event_id") + F.when(late, 1_000_000_000).otherwise(0))


@query("insert_newest_commit", f"""WITH c AS ({COMMIT_SQL})
SELECT commit_hash, author_name, message, epoch FROM c WHERE epoch < (SELECT max(epoch) FROM c)
UNION ALL (SELECT commit_hash, author_name, message, epoch FROM c ORDER BY epoch DESC, commit_hash LIMIT 1)""")
def insert_newest_commit(spark, folder):
    history = log(spark, folder)
    known = history.where(F.col("epoch") < history.select(F.max("epoch")).scalar())
    table = append_newest(history, gitlog.commit_rows(known))
    return table.withColumn("epoch", F.unix_seconds("commit_ts")).drop("commit_ts")


@query("run_log_row", f"""SELECT 'north/star' AS repo_path, (SELECT commit_hash FROM ({COMMIT_SQL}) ORDER BY epoch DESC, commit_hash DESC LIMIT 1) AS head_hash,
    count(*) AS commit_count FROM orders HAVING count(*) > 0""")
def run_log(spark, folder):
    """The row of a run, but for its time."""
    return run_row(log(spark, folder), "north/star").drop("started_at")
