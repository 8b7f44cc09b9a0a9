"""Joins between commits, runs, samples and time windows."""

from pyspark.sql import functions as F

from ..operators import joins
from ..operators.range_count import count_in_windows
from ..operators.sampling import sample_uniform
from ..sources import gitlog
from ..sources.tables import read_table
from . import query
from .adaptors import ISSUES_SQL, events, issues
from .ingest import COMMIT_SQL, log


@query("commit_run_join", f"""SELECT commit_hash AS sha, author_name, l_orderkey || '-' || l_linenumber || '-' || l_partkey AS pipeline_id,
       l_linestatus AS status
FROM lineitem JOIN ({COMMIT_SQL}) c ON c.commit_hash = md5(CAST(l_orderkey * 2 AS VARCHAR))""")
def commit_run_join(spark, folder):
    lines = read_table(spark, folder, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_linestatus"])
    runs = lines.select(
        F.md5((F.col("l_orderkey") * 2).cast("string")).alias("sha"),
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("pipeline_id"),
        F.col("l_linestatus").alias("status"),
    )
    linked = joins.linked_runs(gitlog.commit_rows(log(spark, folder)), runs)
    return linked.select("sha", "author_name", "pipeline_id", "status")


@query("sampled_issues", f"""WITH {ISSUES_SQL} SELECT issue_number, comments_count FROM issues WHERE issue_number IN (
    SELECT event_id FROM events ORDER BY md5(event_id || ':5'), event_id LIMIT 385)""")
def sampled(spark, folder):
    population = read_table(spark, folder, "events", ["event_id"])
    sample = sample_uniform(population, 385, ["event_id"], seed=5).select(F.col("event_id").alias("issue_number"))
    return joins.sampled_issues(issues(spark, folder), sample).select("issue_number", "comments_count")


@query("commits_in_window", f"""WITH {ISSUES_SQL}
SELECT issue_number, count(c.ts) AS n_commits FROM issues i
LEFT JOIN events c ON c.ts >= i.created_at AND c.ts <= i.closed_at
WHERE i.closed_at >= i.created_at GROUP BY issue_number""")
def commits_in_window(spark, folder):
    commits = events(spark, folder).select("at")
    open_issues = issues(spark, folder).where(F.col("closed_at") >= F.col("created_at"))
    counted = count_in_windows(open_issues, commits, "created_at", "closed_at", "at", ["issue_number"], "n_commits")
    return counted.select("issue_number", "n_commits")


@query("orders_before_shipping", """WITH d AS (SELECT CAST(epoch(o_orderdate) AS BIGINT) AS t, count(*) AS n FROM orders GROUP BY 1),
s AS (SELECT t, CAST(sum(n) OVER (ORDER BY t) AS BIGINT) AS upto FROM d)
SELECT l_shipdate_s, coalesce(upto, 0) AS n_until FROM (SELECT DISTINCT CAST(epoch(l_shipdate) AS BIGINT) AS l_shipdate_s FROM lineitem)
ASOF LEFT JOIN s ON t <= l_shipdate_s""")
def orders_before_shipping(spark, folder):
    """Orders up to each distinct shipping time: windows open to the left."""
    shipped = read_table(spark, folder, "lineitem", ["l_shipdate"]).distinct().withColumn("first", F.lit("0001-01-01").cast("timestamp"))
    orders = read_table(spark, folder, "orders", ["o_orderdate"])
    counts = count_in_windows(shipped, orders, "first", "l_shipdate", "o_orderdate", ["l_shipdate"], "n_until")
    return counts.select((F.unix_micros(F.col("l_shipdate").cast("timestamp")) / 1_000_000).cast("long").alias("l_shipdate_s"), "n_until")
