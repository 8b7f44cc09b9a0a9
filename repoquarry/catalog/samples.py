"""Samples and splits. The order is md5 of id and seed, which both engines share."""

from pyspark.sql import functions as F

from ..operators import sampling
from ..operators.modeling import split_dataset, split_quotas
from ..sources.tables import read_table
from . import query
from .adaptors import ISSUES_SQL, commits, issues

CUSTOMERS_SQL = """placed AS (
    SELECT *, row_number() OVER (ORDER BY md5(c_custkey || ':7'), c_custkey) AS r, count(*) OVER () AS n,
           row_number() OVER (PARTITION BY seg ORDER BY md5(c_custkey || ':7'), c_custkey) AS seg_r,
           count(*) OVER (PARTITION BY seg) AS seg_n
    FROM (SELECT *, nullif(c_mktsegment, 'MACHINERY') AS seg FROM customer))"""


def customers(spark, folder):
    """Customers; one segment is null, which makes it a group of its own."""
    return read_table(spark, folder, "customer").withColumn("seg", F.nullif("c_mktsegment", F.lit("MACHINERY")))


@query("sample_uniform", f"WITH {CUSTOMERS_SQL} SELECT c_custkey, c_name FROM placed WHERE r <= 400")
def uniform(spark, folder):
    population = read_table(spark, folder, "customer", ["c_custkey", "c_name"])
    return sampling.sample_uniform(population, 400, ["c_custkey"], seed=7)


@query("sample_uniform_large", """SELECT o_orderkey, o_totalprice FROM (
    SELECT *, row_number() OVER (ORDER BY md5(o_orderkey || ':0'), o_orderkey) AS r FROM orders) WHERE r <= 12345""")
def uniform_large(spark, folder):
    population = read_table(spark, folder, "orders", ["o_orderkey", "o_totalprice"])
    return sampling.sample_uniform(population, 12_345, ["o_orderkey"], seed=0)


@query("sample_stratified_few", f"WITH {CUSTOMERS_SQL} SELECT c_custkey, seg FROM placed WHERE seg_r <= 20")
def stratified_few(spark, folder):
    population = customers(spark, folder).select("c_custkey", "seg")
    return sampling.sample_stratified(population, "seg", ["c_custkey"], n=20, seed=7)


@query("sample_stratified_n", f"WITH {CUSTOMERS_SQL} SELECT c_custkey, seg FROM placed WHERE seg_r <= 290")
def stratified_n(spark, folder):
    population = customers(spark, folder).select("c_custkey", "seg")
    return sampling.sample_stratified(population, "seg", ["c_custkey"], n=290, seed=7)


@query("sample_stratified_frac", f"""WITH {CUSTOMERS_SQL}
SELECT c_custkey, seg FROM placed WHERE seg_r <= ceil(seg_n * CAST(0.13 AS DOUBLE))""")
def stratified_frac(spark, folder):
    population = customers(spark, folder).select("c_custkey", "seg")
    return sampling.sample_stratified(population, "seg", ["c_custkey"], frac=0.13, seed=7)


@query("sample_stratified_many", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM (
    SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY md5(concat_ws(':', l_orderkey, l_linenumber, l_partkey,
                  l_extendedprice_text, '1')), l_orderkey, l_linenumber, l_partkey, l_extendedprice_text) AS r,
           count(*) OVER (PARTITION BY l_suppkey) AS n
    FROM (SELECT *, CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR) AS l_extendedprice_text FROM lineitem))
WHERE r <= ceil(n * CAST(0.25 AS DOUBLE))""")
def stratified_many(spark, folder):
    """The way for more groups than may be broadcast, forced by a bound of one group."""
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    cents = F.round(F.col("l_extendedprice") * 100).cast("long").cast("string")
    population = read_table(spark, folder, "lineitem", columns).withColumn("cents", cents)
    ids = ["l_orderkey", "l_linenumber", "l_partkey", "cents"]
    sample = sampling.sample_stratified(population, "l_suppkey", ids, frac=0.25, seed=1, max_broadcast_groups=1)
    return sample.drop("cents")


@query("sample_systematic", """SELECT o_orderkey, o_orderdate_us FROM (
    SELECT o_orderkey, epoch_us(o_orderdate) AS o_orderdate_us, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS i
    FROM orders) WHERE i % 37 = 11""")
def systematic(spark, folder):
    population = read_table(spark, folder, "orders", ["o_orderkey", "o_orderdate"])
    order = [F.col("o_orderdate"), F.col("o_orderkey")]
    sample = sampling.sample_systematic(population, 37, order, start=11)
    return sample.select("o_orderkey", F.unix_micros(F.col("o_orderdate").cast("timestamp")).alias("o_orderdate_us"))


@query("sample_auto", f"""WITH {CUSTOMERS_SQL} SELECT c_custkey FROM placed
WHERE r <= least(ceil(384.16 / (1 + (384.16 - 1) / n)), n)""")
def auto(spark, folder):
    population = read_table(spark, folder, "customer", ["c_custkey"])
    return sampling.draw_sample(population, ["c_custkey"], [F.col("c_custkey")], seed=7)


@query("sample_auto_stratified", f"""WITH {CUSTOMERS_SQL} SELECT c_custkey, seg FROM placed
WHERE seg_r <= ceil(seg_n * (CAST(least(ceil(384.16 / (1 + (384.16 - 1) / n)), n) AS DOUBLE) / n))""")
def auto_stratified(spark, folder):
    population = customers(spark, folder).select("c_custkey", "seg")
    return sampling.draw_sample(population, ["c_custkey"], [F.col("c_custkey")], seed=7, key="seg")


@query("sample_entity", f"""WITH {ISSUES_SQL} SELECT issue_number, state, title FROM (
    SELECT *, row_number() OVER (ORDER BY md5(concat_ws(':', provider, repo, issue_number, '3')), provider, repo, issue_number) AS r,
           count(*) OVER () AS n FROM issues) WHERE r <= ceil(n * CAST(0.05 AS DOUBLE))""")
def entity(spark, folder):
    sample = sampling.sample_entity(issues(spark, folder), "issues", frac=0.05, seed=3)
    return sample.select("issue_number", "state", "title")


QUOTA_SQL = """quota AS (
    SELECT o_orderpriority, size, size - floored - CASE WHEN row_number() OVER (ORDER BY rest DESC, o_orderpriority)
               <= train - sum(floored) OVER () THEN 1 ELSE 0 END AS test_rows
    FROM (SELECT *, size * train // total AS floored, size * train % total AS rest FROM (
        SELECT o_orderpriority, count(*) AS size, CAST(sum(count(*)) OVER () AS BIGINT) AS total,
               CAST(sum(count(*)) OVER () - ceil(sum(count(*)) OVER () * 0.2) AS BIGINT) AS train
        FROM orders GROUP BY o_orderpriority)))"""


@query("split_quotas", f"WITH {QUOTA_SQL} SELECT o_orderpriority, size, CAST(test_rows AS BIGINT) AS test_rows FROM quota")
def quotas(spark, folder):
    return split_quotas(read_table(spark, folder, "orders", ["o_orderpriority"]), "o_orderpriority", 0.2)


@query("stratified_split", f"""WITH {QUOTA_SQL}, placed AS (
    SELECT o_orderkey, o_orderpriority, row_number() OVER (
        PARTITION BY o_orderpriority ORDER BY md5(o_orderkey || ':42'), o_orderkey) AS r FROM orders)
SELECT o_orderkey, o_orderpriority, r <= test_rows AS is_test FROM placed JOIN quota USING (o_orderpriority)""")
def split(spark, folder):
    rows = read_table(spark, folder, "orders", ["o_orderkey", "o_orderpriority"])
    return split_dataset(rows, ["o_orderkey"], "o_orderpriority")


@query("sample_commits", """SELECT md5(CAST(doc_id AS VARCHAR)) AS commit_hash, source AS author_name FROM (
    SELECT *, row_number() OVER (ORDER BY doc_id DESC) - 1 AS i FROM documents) WHERE i % 10 = 1""")
def sample_commits(spark, folder):
    """Every tenth commit from the newest on; seed 42 draws the start 1."""
    sample = sampling.sample_entity(commits(spark, folder), "commits", step=10, seed=42)
    return sample.select("commit_hash", "author_name")
