"""Queries for helpers and sinks, and for what learned results must satisfy whatever was learned."""

import uuid

from pyspark.sql import functions as F

from ..functions.naming import local_tag
from ..functions.text import is_filled, is_not_blank
from ..operators import sampling
from ..operators.clustering import cluster_vocabulary, reduce_dimensions, with_vectors
from ..schemas import ensure_columns
from ..session import shared_folder
from ..sources import tables
from . import query
from .adaptors import EVENTS_SQL, ISSUES_SQL, events, issues
from .learned import document_vocabulary, resolution, stems_sql, token_vectors
from .vocabularies import TOKENS


@query("filled_texts", f"""WITH {ISSUES_SQL}
SELECT issue_number, body IS NOT NULL AND body <> '' AS filled, body IS NOT NULL AND trim(body, e' \\t\\n\\r') <> '' AS not_blank FROM issues""")
def filled_texts(spark, folder):
    return issues(spark, folder).select("issue_number", is_filled(F.col("body")).alias("filled"), is_not_blank(F.col("body")).alias("not_blank"))


@query("local_tags", """SELECT p_partkey, p_type AS tag FROM part""")
def local_tags(spark, folder):
    parts = tables.read_table(spark, folder, "part", ["p_partkey", "p_type", "p_brand"])
    qualified = F.when(F.col("p_partkey") % 3 != 0, F.concat(F.lit("{urn:"), "p_brand", F.lit("}"), "p_type")).otherwise(F.col("p_type"))
    return parts.select("p_partkey", local_tag(qualified).alias("tag"))


@query("table_maximum", "SELECT max(o_totalprice) AS value FROM orders")
def table_maximum(spark, folder):
    return tables.scalar(tables.read_table(spark, folder, "orders"), F.max("o_totalprice"))


@query("sample_read_back", f"""WITH {ISSUES_SQL}
SELECT repo, CAST(issue_number AS INTEGER) AS issue_number FROM issues WHERE issue_number % 3 = 0""")
def sample_read_back(spark, folder):
    """A sample written as CSV and read as the list of sampled issues."""
    path = f"{shared_folder(spark)}/sample-{uuid.uuid4().hex}"
    tables.write_csv(issues(spark, folder).where(F.col("issue_number") % 3 == 0).select("issue_number", "repo", "title"), path)
    return tables.read_sample(spark, path)


@query("table_read_back", """SELECT o_orderpriority, count(*) AS n, sum(o_custkey) AS customers FROM (
    SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_custkey % 2 = 0) GROUP BY o_orderpriority""")
def table_read_back(spark, folder):
    """A table written, appended to, and read."""
    place, orders = f"{shared_folder(spark)}/tables-{uuid.uuid4().hex}", tables.read_table(spark, folder, "orders")
    tables.write_table(orders, place, "orders")
    tables.write_table(orders.where("o_custkey % 2 = 0"), place, "orders", truncate=False)
    both = spark.read.parquet(f"{place}/orders.parquet")
    return both.groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.sum("o_custkey").alias("customers"))


@query("widened_issues", f"""WITH {ISSUES_SQL}
SELECT issue_number, state, CAST(NULL AS VARCHAR) AS title_clean, CAST(NULL AS VARCHAR) AS author_norm, false AS is_bot FROM issues""")
def widened_issues(spark, folder):
    return ensure_columns(issues(spark, folder).select("issue_number", "state"), "issues")


def _entity_sql(table: str, ids: str, order: str, step: int, start: int, columns: str) -> str:
    return f"""SELECT {columns} FROM (SELECT *, row_number() OVER (ORDER BY {order} DESC NULLS FIRST, {ids}) - 1 AS i FROM ({table})) WHERE i % {step} = {start}"""


RUN_SQL = """SELECT 'ci' AS provider, event_type AS repo, CAST(event_id AS VARCHAR) AS pipeline_id, 's' || (k % 4) AS status,
    CASE WHEN k % 5 <> 0 THEN ts END AS created_at, md5(props) AS sha FROM ev"""


@query("sample_pipelines", f"WITH {EVENTS_SQL} " + _entity_sql(RUN_SQL, "provider, repo, pipeline_id", "created_at", 9, 4, "pipeline_id, status, sha"))
def sample_pipelines(spark, folder):
    """Every ninth CI run, those without a time first, then from the newest on."""
    runs = events(spark, folder).select(
        F.lit("ci").alias("provider"), F.col("event_type").alias("repo"), F.col("event_id").cast("string").alias("pipeline_id"),
        F.concat(F.lit("s"), F.col("k") % 4).alias("status"), F.when(F.col("k") % 5 != 0, F.col("at")).alias("created_at"), F.md5("props").alias("sha"))
    return sampling.sample_entity(runs, "ci_pipelines", step=9, seed=_seed_for(9, 4)).select("pipeline_id", "status", "sha")


JOB_SQL = """SELECT 'ci' AS provider, event_type AS repo, CAST(event_id AS VARCHAR) AS job_id, 'job ' || k AS name,
    CASE WHEN k % 7 <> 0 THEN ts END AS started_at FROM ev"""


@query("sample_jobs", f"WITH {EVENTS_SQL} " + _entity_sql(JOB_SQL, "provider, repo, job_id", "started_at", 11, 2, "job_id, name"))
def sample_jobs(spark, folder):
    jobs = events(spark, folder).select(
        F.lit("ci").alias("provider"), F.col("event_type").alias("repo"), F.col("event_id").cast("string").alias("job_id"),
        F.concat(F.lit("job "), "k").alias("name"), F.when(F.col("k") % 7 != 0, F.col("at")).alias("started_at"))
    return sampling.sample_entity(jobs, "ci_jobs", step=11, seed=_seed_for(11, 2)).select("job_id", "name")


@query("sample_pulls", f"""WITH {EVENTS_SQL} SELECT pr_number, title FROM (
    SELECT event_id AS pr_number, event_type AS title, row_number() OVER (ORDER BY md5(concat_ws(':', 'git', 'r' || k, event_id, '3')), 'git', 'r' || k, event_id) AS r,
           count(*) OVER () AS n FROM ev) WHERE r <= ceil(n * CAST(0.05 AS DOUBLE))""")
def sample_pulls(spark, folder):
    pulls = events(spark, folder).select(
        F.lit("git").alias("provider"), F.concat(F.lit("r"), "k").alias("repo"), F.col("event_id").alias("pr_number"), F.col("event_type").alias("title"))
    return sampling.sample_entity(pulls, "pull_requests", frac=0.05, seed=3).select("pr_number", "title")


def _seed_for(step: int, start: int) -> int:
    """A seed whose first draw below ``step`` is ``start``."""
    import random

    return next(seed for seed in range(10_000) if random.Random(seed).randrange(step) == start)


# --- learned results ---


@query("nearest_clusters", f"""WITH {TOKENS}, {stems_sql('tok')}
SELECT stem AS token, count(*) AS n, true AS nearest FROM tok JOIN stems USING (token) GROUP BY stem""")
def nearest_clusters(spark, folder):
    """Whether every token is in the cluster of its nearest centre."""
    table = document_vocabulary(spark, folder)
    clustered, model = cluster_vocabulary(table, token_vectors(spark, folder, table), 5)
    centres = F.array(*[F.array(*map(F.lit, centre.tolist())) for centre in model.clusterCenters()])
    distances = F.transform(centres, lambda centre: F.aggregate(F.zip_with("vector", centre, lambda x, c: F.pow(x - c, F.lit(2.0))), F.lit(0.0), lambda a, b: a + b))
    nearest = F.get(distances, F.col("cluster")) <= F.array_min(distances) + 1e-9
    return clustered.select("token", "n", nearest.alias("nearest"))


@query("projection_axes", f"""WITH {TOKENS}, {stems_sql('tok')}
SELECT count(DISTINCT stem) AS n_tokens, 0.0 AS mean_1, 0.0 AS mean_2, 0.0 AS covariance, true AS ordered, true AS first_is_widest
FROM tok JOIN stems USING (token)""")
def projection_axes(spark, folder):
    """Over all occurrences the axes have mean 0, are uncorrelated, and the first is as wide as any vector entry."""
    table = document_vocabulary(spark, folder)
    points = reduce_dimensions(with_vectors(table, token_vectors(spark, folder, table)))
    n = F.col("n").cast("double")
    entry = F.get("vector", F.lit(0))

    def mean(column):
        return F.sum(column * n) / F.sum(n)

    sums = points.agg(
        F.count("*").alias("n_tokens"), mean(F.col("c1")).alias("m1"), mean(F.col("c2")).alias("m2"), mean(F.col("c1") * F.col("c2")).alias("c12"),
        mean(F.col("c1") * F.col("c1")).alias("v1"), mean(F.col("c2") * F.col("c2")).alias("v2"), (mean(entry * entry) - mean(entry) * mean(entry)).alias("ve"))
    zero = lambda c: F.round(F.abs(F.col(c)), 6)
    return sums.select("n_tokens", zero("m1").alias("mean_1"), zero("m2").alias("mean_2"), zero("c12").alias("covariance"),
                       (F.col("v1") >= F.col("v2")).alias("ordered"), (F.col("v1") >= F.col("ve") - 1e-9).alias("first_is_widest"))


LABELS_SQL = f"""{ISSUES_SQL},
living AS (SELECT *, (epoch_us(closed_at) - epoch_us(created_at)) / 1e6 AS seconds FROM issues),
labelled AS (SELECT issue_number, CASE WHEN seconds < 3600 THEN 'minutes' WHEN seconds < 86400 THEN 'hours' WHEN seconds < 604800 THEN 'days'
    WHEN seconds < 2592000 THEN 'weeks' ELSE 'months' END AS label FROM living WHERE seconds >= 0),
quota AS (SELECT label, size, size - floored - CASE WHEN row_number() OVER (ORDER BY rest DESC, label) <= train - sum(floored) OVER () THEN 1 ELSE 0 END AS test_rows
    FROM (SELECT *, size * train // total AS floored, size * train % total AS rest FROM (
        SELECT label, count(*) AS size, CAST(sum(count(*)) OVER () AS BIGINT) AS total,
               CAST(sum(count(*)) OVER () - ceil(sum(count(*)) OVER () * 0.2) AS BIGINT) AS train FROM labelled GROUP BY label)))"""


@query("resolution_supports", f"WITH {LABELS_SQL} SELECT label, CAST(test_rows AS BIGINT) AS support, CAST(test_rows AS BIGINT) AS predicted FROM quota WHERE test_rows > 0")
def resolution_supports(spark, folder):
    """Test rows of every class, in the metrics and as row sums of the confusion matrix."""
    result = resolution(spark, folder, max_depth=5)
    classes = [c for c in result.confusion.columns if c != "label"]
    rows = result.confusion.select("label", sum((F.col(c) for c in classes), F.lit(0)).cast("long").alias("predicted"))
    return result.metrics.select(F.col("class").alias("label"), "support").join(rows, "label")


@query("importance_total", "SELECT 5 AS features, 1.0 AS total, true AS none_negative FROM (SELECT count(*) FROM events)")
def importance_total(spark, folder):
    """Importances of a forest are shares."""
    result = resolution(spark, folder, model_type="random_forest", max_depth=4)
    return result.importances.agg(F.count("*").cast("int").alias("features"), F.round(F.sum("importance"), 6).alias("total"),
                                  (F.min("importance") >= 0).alias("none_negative"))
