"""Feature tables and evaluation tables of the classifiers."""

from pyspark.sql import functions as F

from ..functions.text import FEATURE_LABELS
from ..operators import modeling
from ..operators.clustering import representative_tokens
from ..operators.features import commit_features, commit_tokens, issue_features, token_weights
from ..operators.vocabulary import vocabulary_table
from ..session import materialize, stored
from ..plans.reports import model_report
from ..sources.tables import read_table, read_texts
from . import query
from .adaptors import ISSUES_SQL, commits, events, issues, token_label, tokens_sql, vec_id_sql, with_vec_id
from .text import BIN_SQL, COMMITS_SQL, label_sql
from .vocabularies import PAGED, SPEECH, TOKENS, document_tokens, page_tokens, speech_tokens

FEATURE_LIST = ", ".join(f"'{label}'" for label in FEATURE_LABELS)


@query("label_distribution", f"SELECT label, count(*) AS n FROM (SELECT {label_sql('text')} AS label FROM documents) GROUP BY label")
def labels(spark, folder):
    from ..functions.text import commit_label

    rows = read_texts(spark, folder, "documents", ["text"]).select(commit_label(F.col("text")).alias("label"))
    return modeling.label_distribution(rows)


@query("commit_features", f"""WITH {COMMITS_SQL}, {tokens_sql('word', 'commits', 'doc_id', 'message')}, {SPEECH}, {PAGED},
tagged AS (SELECT w.doc_id, w.token, e.label AS cluster, i.token IS NOT NULL AS in_ids, n.token IS NOT NULL AS in_notes
    FROM word w LEFT JOIN (SELECT * FROM embeddings WHERE label < 5) e ON e.vec_id = {vec_id_sql('w.token')}
    LEFT JOIN (SELECT DISTINCT token FROM said) i ON i.token = w.token
    LEFT JOIN (SELECT DISTINCT token FROM noted) n ON n.token = w.token),
sizes AS (SELECT (SELECT count(DISTINCT token) FROM said) AS ids, (SELECT count(DISTINCT token) FROM noted) AS notes),
counted AS (SELECT doc_id, count(*) AS n, count(DISTINCT token) AS d, count(DISTINCT token) FILTER (WHERE in_ids) AS mi,
    count(DISTINCT token) FILTER (WHERE in_notes) AS mn,
    {', '.join(f'count(*) FILTER (WHERE cluster = {i}) AS c{i}' for i in range(5))} FROM tagged GROUP BY doc_id)
SELECT doc_id, {label_sql('message')} AS label,
    {', '.join(f'round(coalesce(c{i} / n, 0), 6) AS cluster_{i}_frac' for i in range(5))},
    round(coalesce(ln(1 + n), 0), 6) AS log_token_count, round(coalesce(d / n, 0), 6) AS type_token_ratio,
    round(coalesce(mi / (d + ids - mi), 0), 6) AS id_overlap, round(coalesce(mn / (d + notes - mn), 0), 6) AS comment_overlap
FROM commits LEFT JOIN counted USING (doc_id), sizes""")
def commit_feature_rows(spark, folder):
    # read twice each, to flag tokens and for their size; the prediction plan stores them too
    ids = materialize(speech_tokens(spark, folder).select("token").distinct())
    notes = materialize(page_tokens(spark, folder).select("token").distinct())
    messages = commits(spark, folder)
    tokens = stored(commit_tokens(messages, "doc_id", "message"))
    weights = token_weights(tokens)
    clusters = token_label(weights.select("token"), spark, folder).where(F.col("label") < 5).withColumnRenamed("label", "cluster")
    table = commit_features(messages, "doc_id", "message", clusters, 5, ids, notes, stem=False, tokens=tokens, weights=weights)
    return table.withColumns({name: F.round(name, 6) for name in table.columns if name not in ("doc_id", "label")})


@query("issue_features", f"""WITH {ISSUES_SQL},
living AS (SELECT *, (epoch_us(closed_at) - epoch_us(created_at)) / 1e6 AS seconds FROM issues),
counted AS (SELECT issue_number, count(c.ts) AS n FROM living i
    LEFT JOIN events c ON c.ts >= i.created_at AND c.ts <= i.closed_at
    WHERE seconds >= 0 GROUP BY issue_number)
SELECT issue_number, CAST(coalesce(length(body), 0) AS DOUBLE) AS description_length, CAST(comments_count AS DOUBLE) AS comment_count,
    CAST(n AS DOUBLE) AS concurrent_commits, CAST(n AS DOUBLE) AS commits_in_lifespan,
    CAST(list_has_any(list_transform(string_split(labels, ','), lambda x: lower(trim(x))), [{FEATURE_LIST}]) AS DOUBLE)
        AS is_feature_request, {BIN_SQL.format('seconds')} AS label
FROM living JOIN counted USING (issue_number)""")
def issue_feature_rows(spark, folder):
    commits_made = events(spark, folder).select(F.col("at").alias("commit_ts"))
    return issue_features(issues(spark, folder), commits_made, ["issue_number"])


GUESSED_SQL = """guessed AS (SELECT l_returnflag AS label, CASE WHEN l_linestatus = 'O' THEN 'N' WHEN l_quantity > 40 THEN 'X'
    WHEN l_quantity > 20 THEN 'A' ELSE 'R' END AS prediction FROM lineitem)"""


def guesses(spark, folder):
    """Return flags and a rule of thumb for them; the rule also names a class nobody has."""
    lines = read_table(spark, folder, "lineitem", ["l_returnflag", "l_linestatus", "l_quantity"])
    guess = F.when(F.col("l_linestatus") == "O", "N").when(F.col("l_quantity") > 40, "X").when(
        F.col("l_quantity") > 20, "A").otherwise("R")
    return lines.select(F.col("l_returnflag").alias("label"), guess.alias("prediction"))


@query("class_metrics", f"""WITH {GUESSED_SQL},
c AS (SELECT DISTINCT label AS class FROM guessed),
s AS (SELECT class, (SELECT count(*) FROM guessed WHERE label = class) AS support,
      (SELECT count(*) FROM guessed WHERE label = class AND prediction = class) AS hits,
      (SELECT count(*) FROM guessed WHERE prediction = class) AS made FROM c),
m AS (SELECT class, support, hits, made, coalesce(hits / nullif(made, 0), 0) AS p, coalesce(hits / nullif(support, 0), 0) AS r FROM s),
f AS (SELECT *, coalesce(2 * p * r / nullif(p + r, 0), 0) AS f1 FROM m)
SELECT class, round(p, 9) AS precision, round(r, 9) AS recall, round(f1, 9) AS f1, CAST(support AS BIGINT) AS support FROM f
UNION ALL SELECT CASE WHEN sum(made) = sum(support) THEN 'accuracy' ELSE 'micro avg' END, round(sum(hits) / sum(made), 9),
    round(sum(hits) / sum(support), 9), round(2 * sum(hits) / (sum(made) + sum(support)), 9), CAST(sum(support) AS BIGINT) FROM f
UNION ALL SELECT 'macro avg', round(avg(p), 9), round(avg(r), 9), round(avg(f1), 9), CAST(sum(support) AS BIGINT) FROM f
UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 9), round(sum(r * support) / sum(support), 9),
    round(sum(f1 * support) / sum(support), 9), CAST(sum(support) AS BIGINT) FROM f""")
def metrics(spark, folder):
    table = modeling.class_metrics(guesses(spark, folder))
    return table.withColumns({name: F.round(name, 9) for name in ("precision", "recall", "f1")})


def _report_sql(source: str, classes: str) -> str:
    """Lines of a model report whose metrics and importances come from counts of ``source`` (label, prediction)."""
    return f"""SELECT row_number() OVER (ORDER BY section, place) AS line_no, line FROM (
    SELECT 0 AS section, unnest(range(1, 8)) AS place, unnest(['REPORT', '{"=" * 40}', '', 'Model type:  rule', 'Features:    2', 'Train size:  7', 'Test size:   9']) AS line
    UNION ALL SELECT 1, 1, printf('Accuracy:    %.1f%%', 100.0 * count(*) FILTER (WHERE label = prediction) / count(*)) FROM {source}
    UNION ALL SELECT 2, unnest(range(1, 6)), unnest(['', 'Classification report (test set):', '{"-" * 36}', '              precision    recall  f1-score   support', ''])
    UNION ALL SELECT 3, list_position(['A', 'N', 'R', 'accuracy', 'micro avg', 'macro avg', 'weighted avg'], class),
        CASE WHEN class = 'accuracy' THEN printf('%12s  %9s %9s %9.2f %9d', class, '', '', f1, support)
        ELSE printf('%12s  %9.2f %9.2f %9.2f %9d', class, precision, recall, f1, support) END FROM ({classes})
    UNION ALL SELECT 4, unnest(range(1, 4)), unnest(['', 'Feature importances (descending):', '{"-" * 36}'])
    UNION ALL SELECT 5, row_number() OVER (ORDER BY n DESC, label), printf('  %-25s %.4f', label, n / 1e6) FROM (SELECT label, count(*) AS n FROM {source} GROUP BY label))"""


def _report(rows):
    importances = rows.groupBy(F.col("label").alias("feature")).agg((F.count("*") / 1e6).alias("importance"))
    return model_report("REPORT", "rule", 2, 7, 9, modeling.class_metrics(rows), importances, ["A", "N", "R"])


METRICS_SQL = """c AS (SELECT DISTINCT label AS class FROM rows),
s AS (SELECT class, (SELECT count(*) FROM rows WHERE label = class) AS support,
      (SELECT count(*) FROM rows WHERE label = class AND prediction = class) AS hits,
      (SELECT count(*) FROM rows WHERE prediction = class) AS made FROM c),
m AS (SELECT class, support, hits, made, coalesce(hits / nullif(made, 0), 0) AS p, coalesce(hits / nullif(support, 0), 0) AS r FROM s),
f AS (SELECT *, coalesce(2 * p * r / nullif(p + r, 0), 0) AS f1 FROM m),
metrics AS (SELECT class, p AS precision, r AS recall, f1, CAST(support AS BIGINT) AS support FROM f
UNION ALL SELECT CASE WHEN sum(made) = sum(support) THEN 'accuracy' ELSE 'micro avg' END, sum(hits) / sum(made),
    sum(hits) / sum(support), 2 * sum(hits) / (sum(made) + sum(support)), CAST(sum(support) AS BIGINT) FROM f
UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f1), CAST(sum(support) AS BIGINT) FROM f
UNION ALL SELECT 'weighted avg', sum(p * support) / sum(support), sum(r * support) / sum(support), sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM f)"""


@query("model_report_strangers", f"WITH {GUESSED_SQL}, rows AS (SELECT * FROM guessed), {METRICS_SQL} {_report_sql('rows', 'SELECT * FROM metrics')}")
def report_with_strangers(spark, folder):
    """The report where some predictions are no class of the test set."""
    return _report(guesses(spark, folder))


@query("model_report_lines", f"""WITH {GUESSED_SQL}, rows AS (SELECT label, CASE WHEN prediction = 'X' THEN 'R' ELSE prediction END AS prediction FROM guessed),
{METRICS_SQL} {_report_sql('rows', 'SELECT * FROM metrics')}""")
def report_lines(spark, folder):
    """The report where all predictions are classes of the test set."""
    rows = guesses(spark, folder)
    return _report(rows.withColumn("prediction", F.when(F.col("prediction") == "X", "R").otherwise(F.col("prediction"))))


@query("confusion_matrix", f"""WITH {GUESSED_SQL}
SELECT label, {', '.join(f"count(*) FILTER (WHERE prediction = '{c}') AS {c}" for c in 'ANR')} FROM guessed GROUP BY label""")
def confusion(spark, folder):
    return modeling.confusion_matrix(guesses(spark, folder), ["A", "N", "Q", "R"])


@query("representative_token", f"""WITH {TOKENS},
points AS (SELECT token, n, first_place, label AS cluster, CAST(embedding[1] AS DOUBLE) AS c1, CAST(embedding[2] AS DOUBLE) AS c2
    FROM (SELECT token, count(*) AS n, min(doc_id * 100000 + pos) AS first_place FROM tok GROUP BY token)
    JOIN embeddings ON vec_id = {vec_id_sql('token')}),
centres AS (SELECT cluster, sum(c1 * n) / sum(n) AS m1, sum(c2 * n) / sum(n) AS m2 FROM points GROUP BY cluster)
SELECT cluster, token FROM (SELECT cluster, token, row_number() OVER (
    PARTITION BY cluster ORDER BY sqrt(power(c1 - m1, 2) + power(c2 - m2, 2)), first_place) AS r
    FROM points JOIN centres USING (cluster)) WHERE r = 1""")
def representatives(spark, folder):
    table = vocabulary_table(document_tokens(spark, folder), ["doc_id", "pos"], stem=False)
    points = read_table(spark, folder, "embeddings").select(
        "vec_id", F.col("label").alias("cluster"), F.col("embedding")[0].cast("double").alias("c1"),
        F.col("embedding")[1].cast("double").alias("c2"))
    placed = with_vec_id(table, spark, folder).join(points, "vec_id")
    return representative_tokens(placed)
