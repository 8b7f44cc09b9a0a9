import json
from datetime import datetime, timezone

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from repoquarry import schemas
from repoquarry.functions.timing import life_span_seconds, resolution_bin, utc_timestamp
from repoquarry.operators import upsert as ops
from repoquarry.operators.integrity import duplicate_keys, integrity_counts
from repoquarry.operators.joins import linked_runs, orphan_parents
from repoquarry.plans import mine
from repoquarry.sources import gitlog, payloads, tables
from repoquarry.streaming.ingest import land, merged


def utc(*parts):
    return datetime(*parts, tzinfo=timezone.utc)


def instants(rows):
    return [None if r[0] is None else r[0].astimezone(timezone.utc) for r in rows]


def test_timestamps(spark):
    values = ["2025-01-02T03:04:05Z", "2025-01-02T03:04:05+00:00", "2025-01-02T03:04:05.123456Z", "2025-01-02 03:04:05",
              "2025-01-02", "2025-01-02T03:04:05-02:30", None, "2025-01", "soon", "2025-13-01"]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").orderBy("i")
    micros = [r[0] for r in rows.select(F.unix_micros(utc_timestamp(F.col("v"), strict=False))).collect()]
    second = int(utc(2025, 1, 2, 3, 4, 5).timestamp()) * 10**6
    assert micros == [second, second, second + 123456, second, int(utc(2025, 1, 2).timestamp()) * 10**6,
                      second + 9000 * 10**6, None, None, None, None]
    with pytest.raises(PySparkException, match="Unrecognized timestamp: "):
        rows.select(utc_timestamp(F.col("v"))).collect()
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        moved = rows.limit(6).select(F.unix_micros(utc_timestamp(F.col("v")))).collect()
        assert [r[0] for r in moved] == micros[:6]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_resolution_bins(spark):
    seconds = [0.0, 3599.9, 3600.0, 86399.0, 86400.0, 604799.0, 604800.0, 2591999.0, 2592000.0, None]
    rows = spark.createDataFrame([(s,) for s in seconds], "s double").select(resolution_bin(F.col("s"))).collect()
    assert [r[0] for r in rows] == ["minutes", "minutes", "hours", "hours", "days", "days", "weeks", "weeks", "months", None]
    span = spark.sql("select timestamp_ntz'2024-01-01 00:00:00' a, timestamp_ntz'2024-01-01 00:00:01.5' b")
    assert span.select(life_span_seconds(F.col("a"), F.col("b"))).first()[0] == 1.5


ISSUES_PAGE = [
    {"number": 1, "title": "Bug\u0000!", "body": None, "user": {"login": "Alice"}, "state": "open", "comments": 3,
     "labels": [{"name": "bug"}, {"name": "new feature"}], "created_at": "2024-01-01T00:00:00Z", "closed_at": None},
    {"number": 2, "title": "Merge", "pull_request": {"url": "u"}, "created_at": "2024-01-01T00:00:00Z"},
    {"number": 3, "title": "No user", "user": None, "created_at": "2024-01-03T00:00:00Z"},
]


def page(spark, value):
    return spark.createDataFrame([("acme/widgets", json.dumps(value))], "repo string, json string")


def test_issue_payload(spark):
    rows = payloads.issue_rows(page(spark, ISSUES_PAGE), carry=["repo"]).orderBy("issue_number").collect()
    assert [(r.repo, r.issue_number, r.title, r.body, r.author, r.state, r.comments_count, r.labels) for r in rows] == [
        ("acme/widgets", 1, "Bug!", "", "Alice", "open", 3, "bug,new feature"),
        ("acme/widgets", 3, "No user", "", None, "open", 0, ""),
    ]


def test_pull_payload(spark):
    pulls = [
        {"number": 10, "title": "a", "user": {"login": "x"}, "state": "open", "created_at": "2024-01-01T00:00:00Z"},
        {"number": 11, "title": "b", "user": None, "state": "closed", "created_at": "2024-01-01T00:00:00Z",
         "merged_at": "2024-01-02T00:00:00Z", "closed_at": "2024-01-02T00:00:00Z"},
        {"number": 12, "state": "closed", "created_at": "2024-01-01T00:00:00Z", "merged_at": ""},
    ]
    rows = payloads.pull_rows(page(spark, pulls)).orderBy("pr_number").collect()
    assert [(r.pr_number, r.state, r.author, r.title) for r in rows] == [
        (10, "open", "x", "a"), (11, "merged", None, "b"), (12, "closed", None, ""),
    ]


def test_run_and_job_payloads(spark):
    runs = {"workflow_runs": [{"id": 1001, "conclusion": "success", "head_sha": "abc"},
                              {"id": 1002, "conclusion": "", "status": "queued"}, {"id": 99999999999, "status": None}]}
    rows = payloads.run_rows(page(spark, runs)).orderBy("pipeline_id").collect()
    assert [(r.pipeline_id, r.status, r.sha) for r in rows] == [
        ("1001", "success", "abc"), ("1002", "queued", None), ("99999999999", "unknown", None)]
    jobs = {"jobs": [{"id": 2001, "name": "build", "conclusion": "success", "duration_ms": 61999},
                     {"id": 2002, "name": "lint", "status": "in_progress"}]}
    listed = page(spark, jobs).withColumn("run", F.lit(1001))
    rows = payloads.job_rows(listed, "run").orderBy("job_id").collect()
    assert [(r.pipeline_id, r.job_id, r.status, r.finished_at, r.duration_seconds) for r in rows] == [
        ("1001", "2001", "success", None, 61), ("1001", "2002", "in_progress", None, None)]


LOG = [
    ("c1", "Ann", " first \n", 100, [], [("a.c", 3, 0), ("b.c", 1, 0)], []),
    ("c2", "", "second", 200, ["c1"], [("a.c", 1, 2), ("new.c", 5, 0), ("odd.c", 1, 1)],
     [("a.c", "a.c", "m"), ("old.c", "new.c", "r"), ("gone.c", None, "d")]),
    ("c3", "Bob", "third", 300, ["c2", "lost"], [("gone.c", 0, 9)], [("gone.c", None, "D"), ("gone.c", "", "t")]),
    ("c4", "Bob", "empty", 400, ["c3"], None, None),
]


def test_commit_log(spark):
    log = spark.createDataFrame(LOG, gitlog.LOG_SCHEMA)
    stored = mine.mine_history(log)
    again = mine.mine_history(log, stored)
    for name, table in stored.items():
        assert sorted(table.collect()) == sorted(again[name].collect()), name
        assert set(table.columns) == {f.name for f in schemas.schema(name)}
    assert sorted(tuple(r) for r in stored["commit_files"].select("commit_hash", "file_path", "change_type").collect()) == [
        ("c1", "a.c", "A"), ("c1", "b.c", "A"), ("c2", "a.c", "M"), ("c2", "new.c", "R"), ("c2", "odd.c", "M"),
        ("c3", "gone.c", "T"),
    ]
    assert sorted(tuple(r) for r in stored["commit_stats"].collect()) == [
        ("c1", 2, 4, 0), ("c2", 3, 7, 3), ("c3", 1, 0, 9), ("c4", 0, 0, 0)]
    authors = {r.commit_hash: (r.author_name, r.message) for r in stored["commits"].collect()}
    assert authors["c2"] == ("unknown", "second") and authors["c1"] == ("Ann", "first")
    counts = integrity_counts(stored["commits"], stored["commit_stats"], stored["commit_parents"]).first()
    assert tuple(counts) == (4, 4, 1)
    assert [tuple(r) for r in orphan_parents(stored["commit_parents"], stored["commits"]).collect()] == [("lost", 1)]
    assert duplicate_keys(stored["commits"], ["commit_hash"]).isEmpty()
    oldest = mine.mine_history(log, max_commits=3, depth=3)["commits"]
    assert {r.commit_hash for r in oldest.collect()} == {"c1", "c2"}
    logged = mine.mine_history(log, repo_path="north/star")
    assert tuple(logged["run_log"].first())[1:] == ("north/star", "c4", 4)
    twice = mine.mine_history(log, logged, max_commits=2, repo_path="north/star")["run_log"]
    assert sorted((r.head_hash, r.commit_count) for r in twice.collect()) == [("c2", 2), ("c4", 4)]  # stored commits count too
    assert mine.mine_history(log.limit(0), repo_path="x")["run_log"].isEmpty()


def test_strict_insert(spark):
    log = spark.createDataFrame(LOG, gitlog.LOG_SCHEMA)
    commits = gitlog.commit_rows(log)
    with pytest.raises(ValueError, match="c4"):
        mine.append_newest(log, commits)
    assert mine.append_newest(log, commits.where("commit_hash <> 'c4'")).count() == 4


def issue_batch(spark, rows):
    return spark.createDataFrame(
        [("github", "acme/widgets", *r) for r in rows],
        "provider string, repo string, issue_number int, title string, author string, state string, "
        "state_reason string, created_at timestamp, closed_at timestamp, seq int",
    )


def test_issue_upsert(spark):
    first = issue_batch(spark, [(100, "old", "ann", "open", None, utc(2024, 1, 2), None, 0),
                                (101, "other", "bob", "open", None, utc(2024, 1, 2), utc(2024, 1, 9), 1)])
    later = issue_batch(spark, [(100, "new", None, "closed", "done", utc(2024, 1, 1), utc(2024, 1, 5), 0),
                                (101, "other", "bob", "open", None, utc(2024, 1, 3), None, 1),
                                (102, "fresh", "cy", "open", None, utc(2024, 1, 4), None, 2)])
    table = ops.upsert_issues(ops.upsert_issues(None, first, "seq"), later, "seq")
    rows = {r.issue_number: r for r in table.collect()}
    assert len(rows) == 3
    assert (rows[100].title, rows[100].author, rows[100].state, rows[100].comments_count) == ("new", None, "closed", 0)
    assert instants([[rows[100].created_at], [rows[100].closed_at]]) == [utc(2024, 1, 1), utc(2024, 1, 5)]
    assert instants([[rows[101].created_at], [rows[101].closed_at]]) == [utc(2024, 1, 2), utc(2024, 1, 9)]
    repeated = ops.upsert_issues(table, later, "seq")
    assert sorted(repeated.collect()) == sorted(table.collect())


def test_ci_ingest(spark):
    runs = spark.createDataFrame(
        [("github", "acme/widgets", 1001, "success", utc(2024, 1, 1), None, "c2", 0)],
        "provider string, repo string, pipeline_id long, status string, created_at timestamp, updated_at timestamp, "
        "sha string, seq int")
    jobs = spark.createDataFrame(
        [("github", "acme/widgets", 1001, 2001, "build", "running", None, None, None, 0),
         ("github", "acme/widgets", 1001, 2002, "lint", "success", None, None, 60, 1),
         ("github", "acme/widgets", 4444, 2003, "stray", "success", None, None, 60, 2)],
        "provider string, repo string, pipeline_id long, job_id long, name string, status string, started_at timestamp, "
        "finished_at timestamp, duration_seconds int, seq int")
    pipelines, found = ops.ingest_ci(None, None, runs, jobs, "seq")
    pipelines, found = ops.ingest_ci(pipelines, found, runs.withColumn("sha", F.lit(None).cast("string")),
                                     jobs.withColumn("name", F.lit("renamed")), "seq")
    assert [(r.pipeline_id, r.sha) for r in pipelines.collect()] == [("1001", "c2")]
    assert sorted((r.job_id, r.name, r.duration_seconds) for r in found.collect()) == [
        ("2001", "build", None), ("2002", "lint", 60)]
    commits = gitlog.commit_rows(spark.createDataFrame(LOG, gitlog.LOG_SCHEMA))
    assert linked_runs(commits, pipelines).select("pipeline_id", "author_name").collect() == [("1001", "unknown")]


def test_ingest_pages(spark):
    def listed(*values, **more):
        rows = [("github", "acme/widgets", no, json.dumps(v)) for no, v in enumerate(values)]
        frame = spark.createDataFrame(rows, "provider string, repo string, page_no int, json string")
        return frame.withColumns({name: F.lit(v) for name, v in more.items()})

    moved = [{**ISSUES_PAGE[0], "state": "closed", "closed_at": "2024-02-01T00:00:00Z"}]
    pulls = [{"number": 11, "title": "b", "state": "closed", "created_at": "2024-01-01T00:00:00Z",
              "merged_at": "2024-01-02T00:00:00Z"}]
    pages = {
        "issues": listed(ISSUES_PAGE, moved),
        "pulls": listed(pulls),
        "runs": listed({"workflow_runs": [{"id": 1001, "conclusion": "success", "created_at": "2024-01-01T00:00:00Z"}]}),
        "jobs": listed({"jobs": [{"id": 2001, "name": "build", "status": "running"}]}, run_id=1001),
    }
    tables = mine.ingest(pages)
    again = mine.ingest(pages, tables)
    for name, table in tables.items():
        assert sorted(table.collect(), key=repr) == sorted(again[name].collect(), key=repr), name
    assert {r.issue_number: r.state for r in tables["issues"].collect()} == {1: "closed", 3: "open"}
    assert [r.state for r in tables["pull_requests"].collect()] == ["merged"]
    assert tables["ci_jobs"].count() == tables["ci_pipelines"].count() == 1


def test_streamed_arrivals(spark, tmp_path):
    source, landed = str(tmp_path / "in"), str(tmp_path / "landed")
    batches = [[("a", 1, 0), ("b", 1, 1)], [("a", None, 2), ("a", 5, 3)], [("b", 7, 4), ("c", 9, 5)]]
    shape = "key string, value int, seq int"
    rules = ops.Rules(("key",), filled=("value",))
    expected = None
    for rows in batches:
        batch = spark.createDataFrame(rows, shape)
        batch.write.mode("append").parquet(source)
        stream = spark.readStream.schema(shape).parquet(source)
        land(stream, landed, str(tmp_path / "progress")).awaitTermination()
        expected = ops.upsert(expected, batch, rules, "seq")
    assert sorted(merged(spark, landed, rules, "seq").collect()) == sorted(expected.collect()) == [
        ("a", 5), ("b", 7), ("c", 9)]


def test_tables_and_sinks(spark, tmp_path):
    folder = str(tmp_path)
    issues = schemas.empty_table(spark, "issues")
    assert schemas.ensure_columns(issues, "issues").columns[-3:] == ["title_clean", "author_norm", "is_bot"]
    twice = schemas.ensure_columns(schemas.ensure_columns(issues, "issues"), "issues")
    assert len(twice.columns) == len(issues.columns) + 3
    assert set(schemas.DDL) == {"commits", "commit_stats", "commit_files", "commit_parents", "run_log", "issues",
                                "pull_requests", "ci_pipelines", "ci_jobs", "code_identifiers", "code_comments"}
    tables.append_run(spark, folder, "acme/widgets", "c4", 4)
    tables.append_run(spark, folder, "acme/widgets", "c5", 5)
    runs = tables.read_table(spark, folder, "run_log", ["head_hash", "commit_count", "started_at"])
    assert sorted((r[0], r[1]) for r in runs.collect()) == [("c4", 4), ("c5", 5)]
    assert tables.conforming(tables.read_table(spark, folder, "run_log"), "run_log").count() == 2
    assert tables.scalar(runs, F.max("commit_count")).first()[0] == 5
    numbers = spark.createDataFrame([(3,), (4,)], "issue_number int")
    assert tables.write_csv(numbers.where("issue_number > 9"), folder + "/none") is False
    assert tables.write_csv(numbers, folder + "/sample") is True
    assert sorted(r[0] for r in tables.read_sample(spark, folder + "/sample").collect()) == [3, 4]
    assert tables.read_sample(spark, folder + "/missing") is None and tables.read_sample(spark, None) is None
    wrong = spark.createDataFrame([("x",)], "issue_number string")
    tables.write_csv(wrong, folder + "/wrong")
    assert tables.read_sample(spark, folder + "/wrong") is None


BAD_PAGES = [
    ('[{"number": 1, "title": "cut o', "no list of items"),
    ('{"message": "rate limit"}', "no list of items"),
    ("", "no list of items"),
    ('[{"title": "nameless"}]', "an item without number"),
    ('[{"number": "x"}]', "an item without number"),
    ('[{"number": 1}, {"number": 9999999999}]', "a number out of range"),
    ('[{"number": 1}, "text"]', "an item without number"),
    ('[{"number": 1.5}]', "number of another type"),
    ('[{"number": 1, "user": "bob"}]', "user of another type"),
    ('[{"number": 1, "user": {"login": ["x"]}}]', "user of another type"),
    ('[{"number": 1, "title": {"en": "x"}}]', "title of another type"),
    ('[{"number": 1, "created_at": ["2024"]}]', "created_at of another type"),
]


BAD_ISSUES = [
    ('[{"number": 1, "comments": 3000000000}]', "a comments out of range"),
    ('[{"number": 1, "comments": "many"}]', "comments of another type"),
    ('[{"number": 1, "labels": "bug"}]', "labels of another type"),
    ('[{"number": 1, "labels": {"name": "bug"}}]', "labels of another type"),
]


@pytest.mark.parametrize(("text", "problem"), BAD_ISSUES)
def test_bad_issue_fields_stop_the_run(spark, text, problem):
    with pytest.raises(PySparkException, match=f"{problem} in page: "):
        payloads.issue_rows(spark.createDataFrame([(text,)], "json string")).collect()


def test_no_field_of_an_item_is_lost(spark):
    """Labels that are strings are passed over, not the list; numbers as text and texts that look like JSON are taken."""
    items = [
        {"number": 1, "title": "[draft] {x}", "labels": ["bug", {"name": "x"}, {"name": None}, {"color": "red"}, 5, {"name": "y"}], "user": {"id": 3}, "comments": "12"},
        {"number": "2", "title": 7, "labels": None, "user": {"login": "z"}, "comments": None, "state": None},
        {"number": 3, "pull_request": None, "title": "a pull request all the same"},
    ]
    rows = payloads.issue_rows(spark.createDataFrame([(json.dumps(items),)], "json string")).orderBy("issue_number").collect()
    assert [(r.issue_number, r.title, r.labels, r.author, r.comments_count, r.state) for r in rows] == [
        (1, "[draft] {x}", "x,,,y", None, 12, "open"), (2, "7", "", "z", 0, "open")]
    runs = '{"workflow_runs": [{"id": 12345678901234, "status": 5, "extra": [1]}]}'
    assert payloads.run_rows(spark.createDataFrame([(runs,)], "json string")).first()["status"] == "5"


@pytest.mark.parametrize(("text", "problem"), BAD_PAGES)
@pytest.mark.parametrize("reader", [payloads.issue_rows, payloads.pull_rows])
def test_bad_list_pages_stop_the_run(spark, reader, text, problem):
    pages = spark.createDataFrame([("north/star", 7, text)], "repo string, page_no long, json string")
    with pytest.raises(PySparkException, match=f"{problem} in page: north/star 7"):
        reader(pages, carry=["repo"], page_no="page_no").collect()


@pytest.mark.parametrize("text", ['{"workflow_runs": [{"id": 1}', '{"message": "no"}', '{"workflow_runs": [{"status": "x"}]}', "[]"])
def test_bad_run_pages_stop_the_run(spark, text):
    with pytest.raises(PySparkException, match="in page: "):
        payloads.run_rows(spark.createDataFrame([(text,)], "json string")).collect()


def test_pages_without_items(spark):
    pages = spark.createDataFrame([("[]",), (" [ ]",), (None,)], "json string")
    assert payloads.issue_rows(pages).count() == 0
    empty = [('{"workflow_runs": []}',), ('{"total_count": 0}',), (None,)]
    assert payloads.run_rows(spark.createDataFrame(empty, "json string")).count() == 0
    with pytest.raises(PySparkException, match="no list of workflow_runs in page: "):
        payloads.run_rows(spark.createDataFrame([('{"total_count": 3}',)], "json string")).collect()


def test_arrivals_order_by_page_then_place(spark):
    """A place beyond any page size stays before the next page."""
    late = [{"number": 1, "title": f"t{i}", "state": "open", "created_at": "2024-01-01T00:00:00Z"} for i in range(3)]
    pages = spark.createDataFrame([("p", "r", 2, json.dumps(late[2:])), ("p", "r", 1, json.dumps(late[:2]))],
                                  "provider string, repo string, page_no long, json string")
    rows = payloads.issue_rows(pages, carry=["provider", "repo"], page_no="page_no")
    assert [tuple(r[0]) for r in rows.select("arrival").orderBy("arrival").collect()] == [(1, 0), (1, 1), (2, 0)]
    moved = rows.withColumn("arrival", F.struct(F.col("arrival.page"), (F.col("arrival.place") + 5_000_000).alias("place")))
    moved = moved.withColumn("arrival", F.when(F.col("title") == "t2", F.struct(F.lit(2).cast("long").alias("page"), F.lit(0).alias("place"))).otherwise(F.col("arrival")))
    table = ops.upsert_issues(None, moved, "arrival")
    assert table.first()["title"] == "t2"
    again = ops.upsert_issues(table, moved.where("title = 't0'"), "arrival")
    assert again.first()["title"] == "t0" and again.count() == 1


def test_jobs_follow_runs_of_their_own_repository(spark):
    runs = spark.createDataFrame([("h", "a", "1"), ("g", "c", "2")], "provider string, repo string, pipeline_id string")
    jobs = spark.createDataFrame([("h", "a", 1, "j1"), ("g", "b", 1, "j2"), ("g", "a", 1, "j3"), ("g", "c", 2, "j4"), ("h", "a", 2, "j5")],
                                 "provider string, repo string, pipeline_id long, job_id string")
    assert sorted(r["job_id"] for r in ops.jobs_of_batch(jobs, runs).collect()) == ["j1", "j4"]
