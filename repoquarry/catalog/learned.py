"""Stems, clusters, projections and classifiers."""

import uuid

from pyspark.sql import functions as F

from ..functions import stemming as st
from ..operators.clustering import cluster_vocabulary, reduce_dimensions, with_vectors
from ..operators.vocabulary import distinct_stems, stemmed_rows, vocabulary_table
from ..plans.analyze import analyze
from ..plans.predict import predict_commit_types
from ..plans.research import predict_resolution_times
from ..session import materialize, shared_folder
from ..sources.stems import StemDictionary
from ..sources.tables import read_table, read_texts
from . import query
from .adaptors import COMMITS_SQL, commits, events, issues, tokens_sql, with_vec_id
from .markup import documents as markup_documents
from .vocabularies import TOKENS, document_tokens


def _when(pairs):
    return " ".join(f"WHEN e = '{ending}' THEN '{new}'" for ending, new in pairs.items())


def _matches(column, pattern):
    return f"regexp_matches({column}, '{pattern}')"


def stems_sql(source: str) -> str:
    """CTEs ending in ``stems`` (token, stem) for the tokens of a table, step by step."""
    base = "w[1:length(w) - length(e)]"

    def endings(table):
        return "(" + "|".join(sorted(table, key=len, reverse=True)) + ")$"

    same = "w[length(w)] = w[length(w) - 1] AND regexp_matches(w, '[^aeiouy]$')"
    steps = [
        f"SELECT token, regexp_replace(token, '^y', 'Y') AS w FROM (SELECT DISTINCT token FROM {source})",
        r"""SELECT token, CASE WHEN regexp_matches(w, '^.ies$') THEN w[:-2] WHEN regexp_matches(w, '(sses|ies)$') THEN w[:-3]
            WHEN regexp_matches(w, 'ss$') OR NOT regexp_matches(w, 's$') THEN w ELSE w[:-2] END AS w FROM {prev}""",
        "SELECT token, w, regexp_extract(w, '(ied|eed|ed|ing)$', 1) AS e FROM {prev}",
        f"""SELECT token, e IN ('ed', 'ing') AND {_matches(base, st.HAS_VOWEL)} AS cut,
            CASE WHEN e = 'ied' THEN {base} || CASE WHEN length(w) = 4 THEN 'ie' ELSE 'i' END
            WHEN e = 'eed' AND {_matches(base, st.POSITIVE)} THEN {base} || 'ee'
            WHEN e IN ('ed', 'ing') AND {_matches(base, st.HAS_VOWEL)} THEN {base} ELSE w END AS w FROM {{prev}}""",
        f"""SELECT token, CASE WHEN NOT cut THEN w WHEN regexp_matches(w, '(at|bl|iz)$') THEN w || 'e'
            WHEN {same} THEN CASE WHEN regexp_matches(w, '[lsz]$') THEN w ELSE w[:-2] END
            WHEN {_matches('w', st.SHORT)} THEN w || 'e' ELSE w END AS w FROM {{prev}}""",
        "SELECT token, CASE WHEN regexp_matches(w, '^.+[^aeiouy]y$') THEN w[:-2] || 'i' ELSE w END AS w FROM {prev}",
        f"""SELECT token, CASE WHEN regexp_matches(w, 'alli$') AND {_matches('w[:-5]', st.POSITIVE)} THEN w[:-3] ELSE w END AS w
            FROM {{prev}}""",
        f"SELECT token, w, regexp_extract(w, '{endings(st.STEP_2)}', 1) AS e FROM {{prev}}",
        f"""SELECT token, CASE WHEN e <> '' AND {_matches(f"({base} || CASE WHEN e = 'logi' THEN 'l' ELSE '' END)", st.POSITIVE)}
            THEN {base} || CASE {_when(st.STEP_2)} END ELSE w END AS w FROM {{prev}}""",
        f"SELECT token, w, regexp_extract(w, '{endings(st.STEP_3)}', 1) AS e FROM {{prev}}",
        f"""SELECT token, CASE WHEN e <> '' AND {_matches(base, st.POSITIVE)} THEN {base} || CASE {_when(st.STEP_3)} END ELSE w END AS w
            FROM {{prev}}""",
        f"SELECT token, w, regexp_extract(w, '{endings(st.STEP_4)}', 1) AS e FROM {{prev}}",
        f"""SELECT token, CASE WHEN e <> '' AND {_matches(base, st.ABOVE_ONE)} AND (e <> 'ion' OR {_matches(base, '[st]$')})
            THEN {base} ELSE w END AS w FROM {{prev}}""",
        f"""SELECT token, CASE WHEN regexp_matches(w, 'e$') AND ({_matches('w[:-2]', st.ABOVE_ONE)} OR
            ({_matches('w[:-2]', st.POSITIVE)} AND NOT {_matches('w[:-2]', st.SHORT)})) THEN w[:-2] ELSE w END AS w FROM {{prev}}""",
        f"""SELECT token, CASE WHEN regexp_matches(w, 'll$') AND {_matches('w[:-2]', st.ABOVE_ONE)} THEN w[:-2] ELSE w END AS w
            FROM {{prev}}""",
    ]
    irregular = " ".join(f"WHEN token = '{word}' THEN '{stem}'" for word, stem in st.IRREGULAR.items())
    chain = [f"stem{i} AS ({step.replace('{prev}', f'stem{i - 1}')})" for i, step in enumerate(steps)]
    last = f"stem{len(steps) - 1}"
    return ", ".join(chain) + (
        f", stems AS (SELECT token, CASE {irregular} WHEN length(token) <= 2 THEN token ELSE lower(w) END AS stem FROM {last})"
    )


@query("stemmed_vocabulary", f"""WITH {TOKENS}, {stems_sql('tok')}
SELECT stem AS token, count(*) AS n, min(doc_id * 100000 + pos) AS first_place FROM tok JOIN stems USING (token) GROUP BY stem""")
def stemmed_vocabulary(spark, folder):
    table = vocabulary_table(document_tokens(spark, folder), ["doc_id", "pos"])
    return table.select("token", "n", (F.col("first.doc_id") * 100000 + F.col("first.pos")).alias("first_place"))


STEMMED_SQL = f"""WITH {COMMITS_SQL}, {tokens_sql('word', 'commits', 'doc_id', 'message')}, {stems_sql('word')}
SELECT doc_id, CAST(pos AS INTEGER) AS pos, stem AS token FROM word JOIN stems USING (token)"""


@query("stemmed_tokens", STEMMED_SQL)
def stemmed_tokens(spark, folder):
    from ..operators.vocabulary import token_rows

    found = token_rows(commits(spark, folder), ["doc_id"], "message")
    return stemmed_rows(found, ["doc_id", "pos"]).select("doc_id", "pos", "token")


@query("stemmed_tokens_stored", STEMMED_SQL)
def stemmed_with_dictionary(spark, folder):
    """The same rows by a stored dictionary that knows the words of half of the texts already."""
    from ..operators.vocabulary import token_rows

    stems = StemDictionary(spark, f"{shared_folder(spark)}/stems-{uuid.uuid4()}", buckets=16)
    found = token_rows(commits(spark, folder), ["doc_id"], "message")
    stems.grow(found.where(F.col("doc_id") % 2 == 0))
    return stems.stemmed_rows(found, ["doc_id", "pos"]).select("doc_id", "pos", "token")


def token_vectors(spark, folder, tokens):
    """Embeddings as vectors of the tokens whose hash points at them."""
    vectors = read_table(spark, folder, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    return with_vec_id(tokens.select("token").distinct(), spark, folder).join(vectors, "vec_id").select("token", "vector")


def document_vocabulary(spark, folder):
    """Stemmed vocabulary, stored because its tokens also select the vectors."""
    return materialize(vocabulary_table(document_tokens(spark, folder), ["doc_id", "pos"]))


@query("cluster_vocabulary")
def clusters(spark, folder):
    table = document_vocabulary(spark, folder)
    clustered, _ = cluster_vocabulary(table, token_vectors(spark, folder, table), 5)
    return clustered.select("token", "n", "cluster")


@query("pca_2d")
def pca(spark, folder):
    table = document_vocabulary(spark, folder)
    points = with_vectors(table, token_vectors(spark, folder, table))
    return reduce_dimensions(points).select("token", F.round("c1", 6).alias("c1"), F.round("c2", 6).alias("c2"))


def study_tables(spark, folder):
    """Commits, identifiers and comments of the study, cleaned, and word vectors."""
    from ..operators import markup
    from ..operators.cleaning import clean_commits

    cleaned = clean_commits(commits(spark, folder))
    identifiers = markup.extract_identifiers(markup_documents(spark, folder))
    spoken = read_texts(spark, folder, "conversations", ["role", "text"])
    comments = spoken.select(F.col("role").alias("file_path"), F.col("text").alias("comment_text"))
    vectors = read_table(spark, folder, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    words = with_vec_id(materialize(distinct_stems(document_tokens(spark, folder))), spark, folder)
    return cleaned, identifiers, comments, words.join(vectors, "vec_id").select("token", "vector")


@query("alignment_report")
def alignment_lines(spark, folder):
    return analyze(*study_tables(spark, folder)).report()


@query("commit_classifier")
def commit_classifier(spark, folder):
    return predict_commit_types(*study_tables(spark, folder)).metrics


@query("commit_forest_importance")
def commit_forest(spark, folder):
    return predict_commit_types(*study_tables(spark, folder), model_type="random_forest", max_depth=5).importances


def resolution(spark, folder, **options):
    made = events(spark, folder).select(F.col("at").alias("commit_ts"))
    return predict_resolution_times(issues(spark, folder), made, **options)


@query("resolution_classifier")
def resolution_classifier(spark, folder):
    return resolution(spark, folder).metrics


@query("resolution_confusion")
def resolution_confusion(spark, folder):
    return resolution(spark, folder, max_depth=5).confusion


@query("resolution_report")
def resolution_lines(spark, folder):
    return resolution(spark, folder, model_type="random_forest", max_depth=5).report
