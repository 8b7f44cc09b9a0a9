import glob
import math
import random
import time

import pytest
from pyspark.sql import functions as F

from repoquarry.functions.text import commit_label
from repoquarry.functions.timing import RESOLUTION_LABELS
from repoquarry.operators import clustering, modeling
from repoquarry.operators.features import commit_feature_names, commit_features
from repoquarry.operators.vocabulary import token_rows, vocabulary_table
from repoquarry.plans import mine
from repoquarry.plans.analyze import analyze
from repoquarry.plans.predict import commit_feature_table, predict_commit_types
from repoquarry.plans.research import predict_resolution_times
from repoquarry.session import discard, materialize, release, shared_folder
from repoquarry.sources.tables import read_table, write_csv, write_lines

THEMES = {
    "fix": ["crash", "null", "pointer", "overflow"], "add": ["parser", "option", "widget"],
    "rename": ["module", "class"], "readme": ["typing", "manual"], "bump": ["version", "release"],
}


@pytest.fixture(scope="module")
def study(spark):
    rng = random.Random(3)
    messages = []
    for i in range(200):
        theme = rng.choice(list(THEMES))
        words = [rng.choice(THEMES[theme]) for _ in range(rng.randrange(1, 6))]
        messages.append((f"h{i:03d}", "ann", f"{theme}: {' '.join(words)}\n\nabout the {rng.choice(words)}", i))
    messages.append(("h999", "ann", "  ", 999))
    commits = spark.createDataFrame(messages, "commit_hash string, author_name string, message string, i long")
    commits = commits.withColumn("commit_ts", F.timestamp_seconds(F.col("i") * 3600)).drop("i")
    names = spark.createDataFrame([("a.c", n) for n in ("parser", "widget", "crash_count", "Module", None)],
                                  "file_path string, name string")
    notes = spark.createDataFrame([("a.c", "Parser of the manual"), ("b.c", "release the widget"), ("c.c", "")],
                                  "file_path string, comment_text string")
    stems = {"pars": 0, "parser": 0, "widget": 0, "option": 0, "crash": 1, "null": 1, "pointer": 1, "overflow": 1,
             "modul": 2, "class": 2, "version": 3, "releas": 3, "manual": 4, "type": 4}
    vectors = spark.createDataFrame([(t, [float(c == i) for i in range(5)]) for t, c in stems.items()],
                                    "token string, vector array<float>")
    return mine.clean({"commits": commits})["commits"], names, notes, vectors


def test_cluster_vocabulary(spark, study):
    commits, _, _, vectors = study
    table = vocabulary_table(token_rows(commits, ["commit_hash"], "message"), ["commit_hash", "pos"])
    clustered, model = clustering.cluster_vocabulary(table, vectors, k=4)
    rows = clustered.collect()
    assert len(rows) == table.count() and {r.cluster for r in rows} <= set(range(4)) and model is not None
    assert {tuple(r.vector) for r in rows if r.token == "readm"} == {(0.0,) * 5}
    same = {frozenset(r.token for r in rows if r.cluster == c) for c in range(4)}
    again, _ = clustering.cluster_vocabulary(table, vectors, k=4)
    assert same == {frozenset(r.token for r in again.collect() if r.cluster == c) for c in range(4)}
    alone, model = clustering.cluster_vocabulary(table.limit(1), vectors, k=5)
    assert model is None and [r.cluster for r in alone.collect()] == [0]


def test_projection(spark):
    rng = random.Random(1)
    rows = [(f"t{i}", 1 + i % 3, i, i % 2, [x := rng.gauss(0, 5), x + rng.gauss(0, 1), rng.gauss(3, 0.1)]) for i in range(60)]
    points = spark.createDataFrame(rows, "token string, n int, first int, cluster int, vector array<double>")
    placed = clustering.reduce_dimensions(points)
    found = placed.select("n", "c1", "c2").toPandas()
    found = found.loc[found.index.repeat(found.n)]  # the axes are those of all occurrences
    assert abs(found.c1.mean()) < 1e-9 and abs(found.c2.mean()) < 1e-9
    assert found.c1.var() > found.c2.var() > 0 and abs(found.c1.corr(found.c2)) < 1e-6
    tokens = clustering.representative_tokens(placed).collect()
    assert {r.cluster for r in tokens} == {0, 1}
    with pytest.raises(ValueError):
        clustering.reduce_dimensions(points, method="umap")
    assert clustering.reduce_dimensions(points.limit(0)).columns[-2:] == ["c1", "c2"]


def test_commit_features(spark):
    commits = spark.createDataFrame([(1, "fix bug add"), (2, "fix unknown fix"), (3, ""), (4, None)], "id int, message string")
    clusters = spark.createDataFrame([("fix", 0), ("bug", 0), ("add", 1), ("far", 2), ("out", 9)], "token string, cluster int")
    ids = spark.createDataFrame([("fix",), ("name",)], "token string")
    table = commit_features(commits, "id", "message", clusters, 3, ids, None, stem=False)
    assert table.columns == ["id", "label", *commit_feature_names(3)]
    rows = {r.id: r for r in table.collect()}
    assert tuple(rows[1])[1:] == pytest.approx(("fix", 2 / 3, 1 / 3, 0.0, 1.3862943611, 1.0, 1 / 4, 0.0), abs=1e-9)
    assert tuple(rows[2])[1:] == pytest.approx(("fix", 2 / 3, 0.0, 0.0, 1.3862943611, 2 / 3, 1 / 3, 0.0), abs=1e-9)
    assert tuple(rows[3])[1:] == tuple(rows[4])[1:] == ("other", *[0.0] * 7)


def test_commit_features_of_repeated_keys(spark):
    """Tokens of one term and rows of one key are merged, and no aggregate has to sort."""
    commits = spark.createDataFrame([(1, "fixing fixes docs"), (1, "add fixes"), (None, "runs running"), (None, None), (2, "the of")], "id int, message string")
    clusters = spark.createDataFrame([("fix", 0), ("run", 1)], "token string, cluster int")
    table = commit_features(commits, "id", "message", clusters, 2, clusters.select("token"), None)
    assert "SortAggregate" not in table._jdf.queryExecution().executedPlan().toString()
    rows = {r.id: r for r in table.collect()}
    assert len(rows) == 3 and rows[1].label == "feature" and rows[2].label == "other" and rows[2].log_token_count == 0
    assert rows[None].cluster_1_frac == 1 and rows[None].type_token_ratio == 1 / 2 and rows[None].id_overlap == 1 / 2
    assert rows[1].cluster_0_frac == pytest.approx(3 / 5) and rows[1].type_token_ratio == pytest.approx(4 / 5)


def test_commit_features_by_hand(spark):
    """Shares and overlaps of random commits as loops count them; no commit's terms go to more than a few tasks."""
    rng = random.Random(5)
    stems = {"running": "run", "runs": "run", "run": "run", "fixes": "fix", "fix": "fix", "mocks": "mock", "zebra": "zebra", "docs": "doc"}
    rows = [(rng.choice([None, *range(12)]), " ".join(rng.choice([*stems, "the", "of"]) for _ in range(rng.randrange(9)))) for _ in range(60)]
    commits = spark.createDataFrame(rows, "id int, message string")
    clusters = {"run": 0, "fix": 1, "doc": 2, "mock": 7}
    ids, comments = {"run", "mock", "far"}, {"zebra", "fix"}
    words = lambda names: spark.createDataFrame([(n,) for n in names], "token string")
    table = commit_features(commits, "id", "message", spark.createDataFrame([*clusters.items()], "token string, cluster int"), 3, words(ids), words(comments))
    found = {r.id: r for r in table.collect()}
    assert len(found) == len({key for key, _ in rows}) and "REPARTITION_BY_COL" in table._jdf.queryExecution().executedPlan().toString()
    labels = [r.label for r in commits.select(commit_label(F.col("message")).alias("label")).collect()]
    for key, row in found.items():
        own = [(label, stems[w]) for (k, text), label in zip(rows, labels) if k == key for w in text.split() if w in stems]
        n, terms = len(own), set(own)  # a term counts once a label
        shares = [sum(clusters.get(term) == i for _, term in own) / max(n, 1) for i in range(3)]
        m = [sum(term in side for _, term in terms) for side in (ids, comments)]
        overlaps = [hits / (len(terms) + len(side) - hits) if n else 0.0 for hits, side in zip(m, (ids, comments))]
        assert tuple(row)[2:] == pytest.approx((*shares, math.log1p(n), len(terms) / max(n, 1), *overlaps), abs=1e-9)
        assert row.label == max(label for (k, _), label in zip(rows, labels) if k == key)


def test_disk_given_back(spark, study, tmp_path):
    """Stored tokens are deleted with the last use, shuffles of what is materialized at a release."""
    folder = shared_folder(spark).removeprefix("file://")
    before = set(glob.glob(f"{folder}/stored-*"))
    assert commit_feature_table(*study, k=3).count() == 200
    assert set(glob.glob(f"{folder}/stored-*")) == before
    shuffles = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses()
    rows = materialize(spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count().join(spark.range(50).withColumnRenamed("id", "k"), "k"))
    held = shuffles.size()
    for _ in range(10):  # the cleaner runs beside this
        release(spark)
        if shuffles.size() < held:
            break
        time.sleep(0.1)
    assert shuffles.size() < held and rows.count() == 10
    kept = spark.range(3)
    kept.write.parquet(str(tmp_path / "mine"))
    discard(spark.read.parquet(str(tmp_path / "mine")))  # not written by stored()
    assert spark.read.parquet(str(tmp_path / "mine")).count() == 3


def test_points_as_narrow_as_they_come(spark):
    words = spark.createDataFrame([("a",), ("b",)], "token string")
    vectors = spark.createDataFrame([("a", [0.1, 2.0])], "token string, vector array<float>")
    points = clustering.with_vectors(words, vectors)
    assert points.schema["vector"].dataType.simpleString() == "array<double>"
    assert "cast(vector" in points._jdf.queryExecution().optimizedPlan().toString()  # after what is stored
    assert {r.token: r.vector for r in points.collect()} == {"a": [pytest.approx(0.1, abs=1e-8), 2.0], "b": [0.0, 0.0]}


def test_vectors_are_computed_once(spark):
    """The dimension comes from what is stored; counted are the rows that the vectors are made of."""
    words = spark.createDataFrame([("a", 3), ("b", 1), ("c", 2), (None, 1)], "token string, n long")
    made = spark.sparkContext.accumulator(0)

    def vector(row):
        made.add(1)
        return row

    rows = [("z", None), ("a", [0.5, 2.0, 1.0]), ("c", None), (None, [9.0, 9.0, 9.0])]
    vectors = spark.createDataFrame(spark.sparkContext.parallelize(rows, 2).map(vector), "token string, vector array<float>")
    points = clustering.with_vectors(words, vectors)
    expected = {"a": [0.5, 2.0, 1.0], "b": [0.0] * 3, "c": [0.0] * 3, None: [0.0] * 3}
    assert {r.token: r.vector for r in points.collect()} == expected and made.value == len(rows)
    # no token has a vector: zeros as long as the vectors that there are
    others = clustering.with_vectors(words.where("token = 'b'"), vectors)
    assert [(r.token, r.n, r.vector) for r in others.collect()] == [("b", 1, [0.0] * 3)]
    for none in (vectors.where("token = 'z'"), vectors.limit(0)):
        assert [r.vector for r in clustering.with_vectors(words.limit(1), none).collect()] == [[0.0]]
    assert clustering.with_vectors(words.limit(0), vectors).collect() == []


def test_analysis(spark, study):
    result = analyze(*study, k=3, top_n=2)
    assert {(r.source_a, r.source_b) for r in result.alignment.collect()} == {
        ("commit", "identifier"), ("commit", "comment"), ("identifier", "comment")}
    lines = [r.line for r in result.report().orderBy("line_no").collect()]
    assert lines[0] == "VOCABULARY ALIGNMENT REPORT" and "Alignment Metrics" in lines
    assert "commit ↔ identifier" in lines and sum(line.startswith("  Cluster ") for line in lines) >= 6 + 3
    assert {r.cluster for r in result.representatives("commit").collect()} == {0, 1, 2}
    only = analyze(study[0], study[1].limit(0), study[2], study[3], k=2)
    lines = [r.line for r in only.report().orderBy("line_no").collect()]
    assert "commit ↔ identifier: no data" in lines and "Code Identifier Vocabulary Clusters" not in lines


def test_commit_classifier(spark, study, tmp_path):
    table = commit_feature_table(*study, k=3)
    assert table.count() == 200 and table.columns == ["commit_hash", "label", *commit_feature_names(3)]
    for model in ("decision_tree", "random_forest"):
        result = predict_commit_types(*study, k=3, model_type=model, max_depth=6)
        accuracy = {r["class"]: r for r in result.metrics.collect()}["accuracy"]
        assert accuracy.support == 40 and accuracy.f1 > 0.5
        importances = result.importances.collect()
        values = [r.importance for r in importances]
        assert len(values) == 7 and values == sorted(values, reverse=True) and sum(values) == pytest.approx(1)
        assert sum(sum(tuple(r)[1:]) for r in result.confusion.collect()) <= 40
    write_lines(result.report, str(tmp_path / "report"))
    lines = [r.value for r in spark.read.text(str(tmp_path / "report")).collect()]
    assert lines[0] == "M1 MODEL REPORT" and "Train size:  160" in lines and "Test size:   40" in lines
    with pytest.raises(ValueError):
        modeling.train_classifier(table, commit_feature_names(3), ["fix", "other"], model_type="svm")
    same = study[0].where("message like 'fix%'")
    assert predict_commit_types(same, *study[1:], k=3) is None


@pytest.fixture(scope="module")
def issues(spark):
    rng = random.Random(8)
    spans = [600, 7200, 200_000, 1_000_000, 5_000_000, -50]
    rows = [("github", "acme/widgets", i, "t", "x" * rng.randrange(50), "Ann", "closed", rng.randrange(9), "bug",
             1_600_000_000 + i * 977, rng.choice(spans)) for i in range(300)]
    frame = spark.createDataFrame(
        rows, "provider string, repo string, issue_number int, title string, body string, author string, state string, "
        "comments_count int, labels string, a long, s long")
    return frame.withColumns({"created_at": F.timestamp_seconds("a"), "closed_at": F.timestamp_seconds(F.col("a") + F.col("s"))})


def test_resolution_classifier(spark, study, issues, tmp_path):
    commits = spark.range(3000).select(F.timestamp_seconds(F.lit(1_600_000_000) + F.col("id") * 1777).alias("commit_ts"))
    result = predict_resolution_times(issues, commits)
    usable = issues.where("s >= 0").count()
    rows = {r["class"]: r for r in result.metrics.collect()}
    assert rows["accuracy"].support == -(-usable // 5) and rows["accuracy"].f1 > 0.7
    assert tuple(result.skipped.first()) == (usable, 300 - usable) and usable < 300
    assert sum(r.n for r in result.distribution.collect()) == usable
    assert result.confusion.columns[1:] == [c for c in RESOLUTION_LABELS if c in result.confusion.columns]
    tops = [r.feature for r in result.importances.limit(2).collect()]
    assert {"concurrent_commits", "commits_in_lifespan"} & set(tops)
    write_csv(issues.where("issue_number < 100").select("issue_number"), str(tmp_path / "sample"))
    sampled = predict_resolution_times(issues, commits, str(tmp_path / "sample"), max_depth=3)
    used = issues.where("s >= 0 and issue_number < 100").count()
    assert {r["class"]: r for r in sampled.metrics.collect()}["accuracy"].support == -(-used // 5)


def test_samples_and_tables(spark, study, issues, tmp_path):
    tables = mine.clean({"issues": issues.drop("a", "s"), "commits": study[0]})
    written = mine.write_samples(tables, str(tmp_path), n=20, seed=4)
    assert written == {"issues": True, "commits": True}
    sample = spark.read.option("header", True).csv(str(tmp_path / "sampled_issues.csv"))
    assert sample.count() == 20 and sample.columns == [
        "issue_number", "state", "created_at", "author", "title", "labels", "title_clean", "author_norm", "is_bot"]
    mine.write_tables(tables, str(tmp_path))
    assert read_table(spark, str(tmp_path), "issues", ["author_norm"]).distinct().collect() == [("ann",)]
    assert mine.write_samples({"issues": tables["issues"].limit(0)}, str(tmp_path / "none")) == {"issues": False}
