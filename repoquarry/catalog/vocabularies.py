"""Tokens, vocabularies, clusters of tokens, alignment, identifier metrics."""

from pyspark.sql import functions as F

from ..operators import vocabulary as ops
from ..operators.identifiers import identifier_features
from ..operators.joins import with_clusters
from ..operators.markup import page_comments
from ..sources.tables import read_table, read_texts
from . import query
from .adaptors import IDENTIFIERS_SQL, identifier_rows, token_label, tokens_sql, vec_id_sql

COMMENT_SQL = r"""page_comments AS (
    SELECT * FROM (SELECT page_id, pos, trim(regexp_replace(regexp_replace(trim(raw, e' \t\n\r'), '^(//|/\*|#)', ''), '\*/$', ''),
                   e' \t\n\r') AS comment_text
    FROM (SELECT page_id, unnest(c) AS raw, unnest(range(len(c))) AS pos
          FROM (SELECT page_id, regexp_extract_all(html, '<!--(.*?)-->', 1, 's') AS c FROM pages))) WHERE comment_text <> '')"""


@query("page_comments", f"WITH {COMMENT_SQL} SELECT page_id, CAST(pos AS INTEGER) AS pos, comment_text FROM page_comments")
def comments(spark, folder):
    return page_comments(read_texts(spark, folder, "pages", ["page_id", "html"]), "page_id", "html")


TOKENS = tokens_sql("tok", "documents", "doc_id", "text")
SPEECH = tokens_sql("said", "(SELECT conv_id * 1000 + turn AS doc_id, text FROM conversations)", "doc_id", "text")
PAGED = tokens_sql("noted", "(SELECT page_id AS doc_id, html FROM pages)", "doc_id", "html")


def document_tokens(spark, folder):
    return ops.token_rows(read_texts(spark, folder, "documents", ["doc_id", "text"]), ["doc_id"], "text")


def speech_tokens(spark, folder):
    spoken = read_texts(spark, folder, "conversations", ["conv_id", "turn", "text"])
    return ops.token_rows(
        spoken.select((F.col("conv_id") * 1000 + F.col("turn")).alias("doc_id"), "text"), ["doc_id"], "text"
    )


def page_tokens(spark, folder):
    """Page sources stand in for the third kind of text; their own comments hold no words."""
    pages = read_texts(spark, folder, "pages", ["page_id", "html"])
    return ops.token_rows(pages.select(F.col("page_id").alias("doc_id"), "html"), ["doc_id"], "html")


@query("token_rows", f"WITH {TOKENS} SELECT doc_id, CAST(pos AS INTEGER) AS pos, token FROM tok")
def tokens(spark, folder):
    return document_tokens(spark, folder)


@query("vocabulary_table", f"""WITH {TOKENS}
SELECT token, count(*) AS n, min(doc_id * 100000 + pos) AS first_place FROM tok GROUP BY token""")
def vocabulary(spark, folder):
    table = ops.vocabulary_table(document_tokens(spark, folder), ["doc_id", "pos"], stem=False)
    return table.select("token", "n", (F.col("first.doc_id") * 100000 + F.col("first.pos")).alias("first_place"))


@query("vocabulary_totals", f"""WITH {TOKENS}, {SPEECH}, {PAGED}
SELECT source, count(*) AS n_tokens, count(DISTINCT token) AS n_distinct FROM (
    SELECT 'commit' AS source, token FROM tok UNION ALL SELECT 'identifier', token FROM said
    UNION ALL SELECT 'comment', token FROM noted) GROUP BY source""")
def totals(spark, folder):
    return ops.vocabulary_totals(three_vocabularies(spark, folder), "source")


def three_vocabularies(spark, folder):
    """Unstemmed vocabularies of documents, conversations and pages."""
    sources = {"commit": document_tokens, "identifier": speech_tokens, "comment": page_tokens}
    union = None
    for name, read in sources.items():
        table = ops.vocabulary_table(read(spark, folder), ["doc_id", "pos"], stem=False)
        part = table.withColumn("source", F.lit(name))
        union = part if union is None else union.unionByName(part)
    return union


@query("token_cluster_lookup", f"""WITH {TOKENS}
SELECT doc_id, CAST(pos AS INTEGER) AS pos, token, e.label AS cluster
FROM tok LEFT JOIN (SELECT * FROM embeddings WHERE label < 8) e ON e.vec_id = {vec_id_sql('token')}""")
def token_clusters(spark, folder):
    found = document_tokens(spark, folder)
    distinct = found.select("token").distinct()
    clusters = token_label(distinct, spark, folder).where(F.col("label") < 8).withColumnRenamed("label", "cluster")
    return with_clusters(found, clusters, ["doc_id", "pos"]).select("doc_id", "pos", "token", "cluster")


@query("cluster_top_tokens", f"""WITH {TOKENS}
SELECT cluster, CAST(rank AS INTEGER) AS rank, token, n FROM (
    SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY n DESC, first_place) AS rank FROM (
        SELECT e.label AS cluster, token, count(*) AS n, min(doc_id * 100000 + pos) AS first_place
        FROM tok JOIN embeddings e ON e.vec_id = {vec_id_sql('token')} GROUP BY ALL))
WHERE rank <= 10""")
def top(spark, folder):
    table = ops.vocabulary_table(document_tokens(spark, folder), ["doc_id", "pos"], stem=False)
    return ops.top_tokens(token_label(table, spark, folder).withColumnRenamed("label", "cluster"), 10)


def labelled_vocabularies(spark, folder):
    """The three vocabularies, each with labels of its own."""
    parts = []
    for source in ("commit", "identifier", "comment"):
        mine = three_vocabularies(spark, folder).where(F.col("source") == source)
        parts.append(token_label(mine, spark, folder, source[:3]))
    table = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return table.select("source", "token", "label", F.col("first").alias("pos"))


def labelled_sql():
    sides = {"commit": "tok", "identifier": "said", "comment": "noted"}
    parts = [
        f"""SELECT '{source}' AS source, token, label FROM (SELECT token, {vec_id_sql('token', source[:3])} AS v FROM (SELECT DISTINCT token FROM {rows}))
            JOIN embeddings ON vec_id = v"""
        for source, rows in sides.items()
    ]
    return f"{TOKENS}, {SPEECH}, {PAGED}, labelled AS ({' UNION ALL '.join(parts)})"


ALIGNMENT_SQL = f"""WITH {labelled_sql()},
pairs(a, b) AS (VALUES ('commit', 'identifier'), ('commit', 'comment'), ('identifier', 'comment')),
sizes AS (SELECT source, count(*) AS size FROM labelled GROUP BY source),
shared AS (SELECT p.a, p.b, x.label AS la, y.label AS lb FROM pairs p JOIN labelled x ON x.source = p.a
           JOIN labelled y ON y.source = p.b AND y.token = x.token),
cells AS (SELECT a, b, sum(n * (n - 1) / 2) AS v FROM (SELECT a, b, la, lb, count(*) AS n FROM shared GROUP BY ALL) GROUP BY a, b),
las AS (SELECT a, b, sum(n * (n - 1) / 2) AS v FROM (SELECT a, b, la, count(*) AS n FROM shared GROUP BY ALL) GROUP BY a, b),
lbs AS (SELECT a, b, sum(n * (n - 1) / 2) AS v FROM (SELECT a, b, lb, count(*) AS n FROM shared GROUP BY ALL) GROUP BY a, b),
tot AS (SELECT a, b, count(*) AS n FROM shared GROUP BY a, b)
SELECT a AS source_a, b AS source_b, round(tot.n / (sa.size + sb.size - tot.n), 9) AS vocab_overlap, tot.n AS shared_vocab_size,
       round((cells.v - las.v * lbs.v / (tot.n * (tot.n - 1) / 2)) /
             ((las.v + lbs.v) / 2 - las.v * lbs.v / (tot.n * (tot.n - 1) / 2)), 9) AS cluster_similarity
FROM tot JOIN cells USING (a, b) JOIN las USING (a, b) JOIN lbs USING (a, b)
JOIN sizes sa ON sa.source = a JOIN sizes sb ON sb.source = b"""


def _rounded(table):
    return table.withColumns({name: F.round(name, 9) for name in ("vocab_overlap", "cluster_similarity")})


@query("pairwise_alignment", ALIGNMENT_SQL)
def pairwise(spark, folder):
    return _rounded(ops.pairwise_alignment(labelled_vocabularies(spark, folder), ["commit", "identifier", "comment"]))


@query("alignment", f"""SELECT vocab_overlap, shared_vocab_size, cluster_similarity FROM ({ALIGNMENT_SQL})
WHERE source_a = 'commit' AND source_b = 'identifier'""")
def alignment(spark, folder):
    table = labelled_vocabularies(spark, folder)
    sides = [table.where(F.col("source") == name) for name in ("commit", "identifier")]
    return _rounded(ops.measure_alignment(*sides))


@query("shared_vocabulary", f"""WITH {TOKENS}, {SPEECH},
both_sides AS MATERIALIZED (SELECT DISTINCT token FROM tok INTERSECT SELECT DISTINCT token FROM said),
placed AS MATERIALIZED (SELECT token, {vec_id_sql('token', 'com')} AS va, {vec_id_sql('token', 'ide')} AS vb FROM both_sides)
SELECT token, x.label AS label_a, y.label AS label_b FROM placed
JOIN embeddings x ON x.vec_id = va JOIN embeddings y ON y.vec_id = vb""")
def shared(spark, folder):
    table = labelled_vocabularies(spark, folder)
    return ops.shared_vocabulary(*[table.where(F.col("source") == name) for name in ("commit", "identifier")])


@query("vocabulary_union", f"WITH {TOKENS}, {SPEECH} SELECT token FROM tok UNION SELECT token FROM said")
def union(spark, folder):
    return ops.vocabulary_union(document_tokens(spark, folder), speech_tokens(spark, folder))


@query("vocabulary_intersection", f"WITH {TOKENS}, {SPEECH} SELECT token FROM tok INTERSECT SELECT token FROM said")
def intersection(spark, folder):
    return ops.vocabulary_intersection(document_tokens(spark, folder), speech_tokens(spark, folder))


PARTS = r"""list_transform(list_filter(regexp_split_to_array(regexp_replace(name, '([A-Z])', ' \1', 'g'), '[_ ]+'),
    lambda x: x <> ''), lambda x: lower(x))"""


def identifier_features_sql(names: str) -> str:
    """Metrics of the (file_path, name) rows of the table ``names``, as the CTE ``measured``."""
    return f"""spelled AS (SELECT file_path, name, length(name) AS chars, {PARTS} AS parts,
    CASE WHEN upper(name) = name AND lower(name) <> name AND (contains(name, '_') OR length(name) > 1) THEN 'SCREAMING_SNAKE'
    WHEN lower(name) = name AND upper(name) <> name THEN 'snake_case'
    WHEN NOT contains(name, '_') AND lower(name[1]) = name[1] AND upper(name[1]) <> name[1] AND lower(name) <> name THEN 'camelCase'
    WHEN NOT contains(name, '_') AND upper(name[1]) = name[1] AND lower(name[1]) <> name[1] THEN 'PascalCase'
    ELSE 'other' END AS convention FROM {names}),
vocab AS (SELECT file_path, count(DISTINCT part) AS vocab_size FROM (SELECT file_path, unnest(parts) AS part FROM spelled) GROUP BY 1),
measured AS (SELECT file_path, count(*) AS n_identifiers, round(avg(chars), 6) AS avg_identifier_length,
       round(avg(len(parts)), 6) AS avg_tokens_per_identifier, any_value(vocab_size) AS vocab_size,
       round(any_value(vocab_size) / sum(len(parts)), 6) AS vocab_diversity,
       round(avg(CAST(convention = 'snake_case' AS INTEGER)), 6) AS pct_snake_case,
       round(avg(CAST(convention = 'camelCase' AS INTEGER)), 6) AS pct_camel_case,
       round(avg(CAST(convention = 'PascalCase' AS INTEGER)), 6) AS pct_pascal_case
FROM spelled JOIN vocab USING (file_path) GROUP BY file_path)"""


def _rounded(table):
    ratios = [name for name in table.columns if name.startswith(("avg", "pct")) or name == "vocab_diversity"]
    return table.withColumns({name: F.round(name, 6) for name in ratios})


@query("identifier_features", f"WITH {IDENTIFIERS_SQL}, {identifier_features_sql('identifiers')} SELECT * FROM measured")
def features(spark, folder):
    return _rounded(identifier_features(identifier_rows(spark, folder)))


METRICS = ("n_identifiers", "avg_identifier_length", "avg_tokens_per_identifier", "vocab_size", "vocab_diversity", "pct_snake_case", "pct_camel_case", "pct_pascal_case")


@query("identifier_features_all_files", f"""WITH larger AS (SELECT p_type AS file_path, p_name AS name FROM part WHERE p_size > 25),
{identifier_features_sql('larger')}
SELECT file_path, {', '.join(f'coalesce({c}, 0) AS {c}' for c in METRICS)} FROM (SELECT DISTINCT p_type AS file_path FROM part) LEFT JOIN measured USING (file_path)""")
def features_all_files(spark, folder):
    parts = read_table(spark, folder, "part", ["p_name", "p_type", "p_size"])
    rows = parts.where("p_size > 25").select(F.col("p_type").alias("file_path"), F.col("p_name").alias("name"))
    files = parts.select(F.col("p_type").alias("file_path"))
    return _rounded(identifier_features(rows, files))
