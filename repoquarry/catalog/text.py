"""Row-level text, time, label and sample-size functions."""

from pyspark.sql import functions as F

from ..functions import text, timing
from ..functions.naming import name_parts, naming_convention
from ..functions.sizing import mean_size, proportion_size
from ..operators.cleaning import clean_commits, clean_titles
from ..operators.features import closed_issues, commit_texts, life_span_report, with_life_span
from ..sources.tables import read_table, read_texts
from . import query
from .adaptors import COMMITS_SQL, EVENTS_SQL, ISSUES_SQL, commits, events, issues, micros

SPACE = text.SPACE


def plain_sql(column: str) -> str:
    """The eight replacements, one regular expression after the other."""
    # Patterns, replacements and flags in the order they apply.
    steps = [
        (r"```(?:[^\n]*)(.*?)```", r"<CODE>\1</CODE>", "gs"), (r"`(.*?)`", r"<CODE>\1</CODE>", "gs"), ("#", "", "g"),
        (rf"^{SPACE}*(?:[-*+]|\p{{Nd}}+\.)", "", ""), (r"\r\n|\r", "\\n", "g"), (r"\n{3,}", "\\n\\n", "g"),
        (r"[ \t]{2,}", " ", "g"), (r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]", "", "g"),
    ]
    for pattern, new, flags in steps:
        new = "'" + new.replace("\\n", "' || chr(10) || '") + "'"
        options = f", '{flags}'" if flags else ""
        column = f"regexp_replace({column}, '{pattern}', {new}{options})"
    return f"({column})"


def label_sql(column: str) -> str:
    cases = " ".join(
        rf"WHEN regexp_matches(lower({column}), '(^|[^\p{{L}}\p{{N}}_])({'|'.join(words)})([^\p{{L}}\p{{N}}_]|$)') THEN '{name}'"
        for name, words in text.COMMIT_TYPES.items()
    )
    return f"CASE {cases} ELSE 'other' END"


BIN_SQL = """CASE WHEN {0} < 3600 THEN 'minutes' WHEN {0} < 86400 THEN 'hours' WHEN {0} < 604800 THEN 'days'
    WHEN {0} < 2592000 THEN 'weeks' ELSE 'months' END"""


def strip_sql(column: str) -> str:
    return rf"regexp_replace({column}, '^{SPACE}+|{SPACE}+$', '', 'g')"


NORM_SQL = f"lower({strip_sql('author')})"
BOT_SQL = f"regexp_matches({NORM_SQL}, 'bot|renovate|github-actions|gitlab-ci')"


@query("canonical_user", f"""WITH {ISSUES_SQL}
SELECT issue_number, {NORM_SQL} AS login_norm, {BOT_SQL} AS is_bot FROM issues""")
def canonical_user(spark, folder):
    return issues(spark, folder).select("issue_number", F.inline(F.array(text.canonical_user(F.col("author")))))


MARKDOWN_SQL = r"""d AS (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN ' - ' WHEN 1 THEN '2. ' ELSE '' END || '# ' || source
    || ' `' || lang || '`  ' || chr(13) || chr(10) || '```py ' || lang || chr(10) || text || chr(10) || '```'
    || CASE doc_id % 2 WHEN 0 THEN ' ```x``` ' ELSE chr(7) || chr(10) || chr(10) || chr(10) || chr(10) END || source AS md
    FROM documents)"""


@query("plain_text", f"WITH {MARKDOWN_SQL} SELECT doc_id, {plain_sql('md')} AS plain FROM d")
def plain_text(spark, folder):
    d = read_texts(spark, folder, "documents", ["doc_id", "text", "lang", "source"])
    start = F.when(F.col("doc_id") % 3 == 0, " - ").when(F.col("doc_id") % 3 == 1, "2. ").otherwise("")
    middle = F.when(F.col("doc_id") % 2 == 0, " ```x``` ").otherwise("\x07\n\n\n\n")
    md = F.concat(start, F.lit("# "), "source", F.lit(" `"), "lang", F.lit("`  \r\n```py "), "lang", F.lit("\n"), "text",
                  F.lit("\n```"), middle, "source")
    return d.select("doc_id", text.plain_text(md).alias("plain"))


CLEAN_MESSAGE_SQL = strip_sql(r"regexp_replace(message, '\r\n|\r', chr(10), 'g')")
HEADER_SQL = rf"'^([\p{{L}}\p{{N}}_]+)(?:\(([^)]+)\))?(!)?:{SPACE}+(.*)$'"
PARTS_SQL = f"""{COMMITS_SQL},
clean AS (SELECT *, {CLEAN_MESSAGE_SQL} AS m FROM commits),
cut AS (SELECT *, split_part(m, chr(10), 1) AS head,
               CASE WHEN contains(m, chr(10)) THEN m[strpos(m, chr(10)) + 1:] ELSE '' END AS rest FROM clean),
parts AS (
    SELECT doc_id, commit_hash,
           CASE WHEN cc THEN regexp_extract(head, {HEADER_SQL}, 4) ELSE head END AS subject,
           {plain_sql(strip_sql('rest'))} AS body,
           CASE WHEN cc THEN lower(regexp_extract(head, {HEADER_SQL}, 1)) END AS cc_type,
           CASE WHEN cc THEN nullif(regexp_extract(head, {HEADER_SQL}, 2), '') END AS cc_scope,
           cc AND regexp_extract(head, {HEADER_SQL}, 3) = '!' AS cc_breaking
    FROM (SELECT *, regexp_matches(head, {HEADER_SQL}) AS cc FROM cut))"""


@query("commit_parts", f"WITH {PARTS_SQL} SELECT doc_id, subject, body, cc_type, cc_scope, cc_breaking FROM parts")
def commit_parts(spark, folder):
    return commits(spark, folder).select("doc_id", F.inline(F.array(text.commit_parts(F.col("message")))))


@query("clean_commits", f"WITH {PARTS_SQL} SELECT commit_hash, cc_type, cc_scope, cc_breaking, subject, body FROM parts")
def cleaned_commits(spark, folder):
    cleaned = clean_commits(commits(spark, folder))
    return cleaned.select("commit_hash", "cc_type", "cc_scope", "cc_breaking", "subject", "body")


@query("clean_issues", f"""WITH {ISSUES_SQL}
SELECT issue_number, {plain_sql('title')} AS title_clean, {NORM_SQL} AS author_norm, {BOT_SQL} AS is_bot FROM issues""")
def cleaned_issues(spark, folder):
    cleaned = clean_titles(issues(spark, folder), ["issue_number"])
    return cleaned.select("issue_number", "title_clean", "author_norm", "is_bot")


@query("clean_limited", f"""WITH {ISSUES_SQL}
SELECT issue_number, {plain_sql('title')} AS title_clean FROM issues ORDER BY repo, issue_number LIMIT 500""")
def cleaned_first(spark, folder):
    cleaned = clean_titles(issues(spark, folder), ["repo", "issue_number"], limit=500)
    return cleaned.select("issue_number", "title_clean")


@query("timestamps_utc", f"""WITH {EVENTS_SQL}
SELECT event_id, CASE k % 6 WHEN 5 THEN epoch_us(date_trunc('day', ts)) WHEN 2 THEN epoch_us(ts)
    WHEN 4 THEN epoch_us(date_trunc('second', ts)) - 5400000000 ELSE epoch_us(date_trunc('second', ts)) END AS us
FROM ev WHERE k % 7 <> 0 UNION ALL SELECT event_id, NULL FROM ev WHERE k % 7 = 0""")
def timestamps(spark, folder):
    e = events(spark, folder)
    shapes = ["yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd'T'HH:mm:ss'+00:00'", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'",
              "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss'+01:30'", "yyyy-MM-dd"]
    value = F.lit("2025-01")
    for number, shape in enumerate(shapes):
        value = F.when(F.col("k") % 6 == number, F.date_format("at", shape)).otherwise(value)
    value = F.when(F.col("k") % 7 != 0, value).when(F.col("k") % 2 == 0, "not a time")
    return e.select("event_id", F.unix_micros(timing.utc_timestamp(value, strict=False)).alias("us"))


@query("commit_label", f"""SELECT doc_id, {label_sql('text')} AS label FROM documents
UNION ALL SELECT -1 - conv_id * 1000 - turn, {label_sql("role || ' ' || text")} FROM conversations""")
def commit_labels(spark, folder):
    d = read_texts(spark, folder, "documents", ["doc_id", "text"])
    c = read_texts(spark, folder, "conversations", ["conv_id", "turn", "role", "text"])
    spoken = c.select((-1 - F.col("conv_id") * 1000 - F.col("turn")).alias("doc_id"),
                      F.concat_ws(" ", "role", "text").alias("text"))
    return d.unionByName(spoken).select("doc_id", text.commit_label(F.col("text")).alias("label"))


LIFE_SQL = f"""{ISSUES_SQL},
living AS (SELECT *, epoch_us(closed_at) / 1e6 - epoch_us(created_at) / 1e6 AS raw,
                  (epoch_us(closed_at) - epoch_us(created_at)) / 1e6 AS seconds FROM issues)"""


@query("resolution_bins", f"""WITH {LIFE_SQL}
SELECT {BIN_SQL.format('seconds')} AS bin, count(*) AS n_issues, round(avg(comments_count), 6) AS avg_comments
FROM living WHERE seconds >= 0 GROUP BY 1""")
def resolution_bins(spark, folder):
    spans = with_life_span(issues(spark, folder))
    return spans.groupBy(timing.resolution_bin(F.col("seconds")).alias("bin")).agg(
        F.count("*").alias("n_issues"), F.round(F.avg("comments_count"), 6).alias("avg_comments")
    )


@query("ship_delay_bins", f"""SELECT {BIN_SQL.format('seconds')} AS bin, count(*) AS n FROM (
    SELECT (epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 1e6 AS seconds FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
WHERE seconds >= 0 GROUP BY 1""")
def ship_delay_bins(spark, folder):
    lines = read_table(spark, folder, "lineitem", ["l_orderkey", "l_shipdate"])
    orders = read_table(spark, folder, "orders", ["o_orderkey", "o_orderdate"])
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_orderdate").alias("created_at"), F.col("l_shipdate").alias("closed_at"))
    return with_life_span(joined).groupBy(timing.resolution_bin(F.col("seconds")).alias("bin")).agg(
        F.count("*").alias("n"))


@query("life_span_skips", f"""WITH {LIFE_SQL}
SELECT count(*) FILTER (WHERE seconds >= 0) AS n_used, count(*) FILTER (WHERE NOT coalesce(seconds >= 0, FALSE)) AS n_skipped
FROM living""")
def life_span_skips(spark, folder):
    return life_span_report(issues(spark, folder))


@query("feature_request_flag", f"""WITH {ISSUES_SQL}
SELECT issue_number, CAST(list_has_any(list_transform(string_split(labels, ','), lambda x: lower(trim(x))),
    [{', '.join(f"'{label}'" for label in text.FEATURE_LABELS)}]) AS INTEGER) AS is_feature FROM issues""")
def feature_flags(spark, folder):
    return issues(spark, folder).select("issue_number", text.is_feature_request(F.col("labels")).alias("is_feature"))


NAMES_SQL = r"""names AS (SELECT DISTINCT name FROM (
    SELECT unnest(regexp_extract_all(text, '[\p{L}\p{N}_]+')) AS name FROM documents
    UNION ALL SELECT replace(p_name, ' ', '_') FROM part
    UNION ALL SELECT string_agg(upper(w[1]) || w[2:], '' ORDER BY i) FROM (
        SELECT p_partkey, unnest(string_split(p_name, ' ')) AS w, unnest(range(len(string_split(p_name, ' ')))) AS i FROM part)
        GROUP BY p_partkey
    UNION ALL SELECT p_type || '_' || p_size FROM part))"""


def spelled_names(spark, folder):
    d = read_texts(spark, folder, "documents", ["text"])
    p = read_table(spark, folder, "part", ["p_name", "p_type", "p_size"])
    found = d.select(F.explode(F.regexp_extract_all("text", F.lit(r"([\p{L}\p{N}_]+)"), 1)).alias("name"))
    made = p.select(F.explode(F.array(F.translate("p_name", " ", "_"), F.translate(F.initcap("p_name"), " ", ""),
                                      F.concat_ws("_", "p_type", "p_size"))).alias("name"))
    return found.unionByName(made).distinct()


@query("naming_convention", f"""WITH {NAMES_SQL}
SELECT name, CASE WHEN upper(name) = name AND lower(name) <> name AND (contains(name, '_') OR length(name) > 1)
        THEN 'SCREAMING_SNAKE'
    WHEN lower(name) = name AND upper(name) <> name THEN 'snake_case'
    WHEN NOT contains(name, '_') AND lower(name[1]) = name[1] AND upper(name[1]) <> name[1] AND lower(name) <> name THEN 'camelCase'
    WHEN NOT contains(name, '_') AND upper(name[1]) = name[1] AND lower(name[1]) <> name[1] THEN 'PascalCase'
    ELSE 'other' END AS convention
FROM names""")
def conventions(spark, folder):
    names = spelled_names(spark, folder)
    return names.select("name", naming_convention(F.col("name")).alias("convention"))


@query("identifier_parts", rf"""WITH {NAMES_SQL}
SELECT name, array_to_string(list_transform(list_filter(
    regexp_split_to_array(regexp_replace(name, '([A-Z])', ' \1', 'g'), '[_ ]+'), lambda x: x <> ''), lambda x: lower(x)), ' ') AS parts
FROM names""")
def identifier_parts(spark, folder):
    names = spelled_names(spark, folder)
    return names.select("name", F.array_join(name_parts(F.col("name")), " ").alias("parts"))


@query("joined_text", f"""WITH {COMMITS_SQL}
SELECT doc_id, coalesce(CASE WHEN doc_id % 3 > 0 THEN message END, '') || ' ' || coalesce(CASE WHEN doc_id % 2 > 0 THEN author_name END, '')
    AS joined FROM commits""")
def joined(spark, folder):
    subject = F.when(F.col("doc_id") % 3 > 0, F.col("message"))
    body = F.when(F.col("doc_id") % 2 > 0, F.col("author_name"))
    return commits(spark, folder).select("doc_id", text.joined_text(subject, body).alias("joined"))


@query("commit_texts", rf"""SELECT doc_id, message FROM (
    SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN ' ' || chr(10) || chr(9) WHEN 1 THEN '' WHEN 2 THEN NULL ELSE text END AS message
    FROM documents) WHERE regexp_matches(message, '[^{SPACE[1:]}')""")
def nonblank_messages(spark, folder):
    d = read_texts(spark, folder, "documents", ["doc_id", "text"])
    case = F.col("doc_id") % 5
    message = F.when(case == 0, " \n\t").when(case == 1, "").when(case > 2, F.col("text"))
    return commit_texts(d.withColumn("message", message), "doc_id")


@query("closed_issues", f"""WITH {ISSUES_SQL}
SELECT issue_number, comments_count, epoch_us(closed_at) AS closed_us FROM issues WHERE closed_at IS NOT NULL""")
def closed(spark, folder):
    rows = closed_issues(issues(spark, folder), ["issue_number"])
    return rows.select("issue_number", "comments_count", micros("closed_at").alias("closed_us"))


@query("sample_size_proportion", """SELECT c_mktsegment, n, CAST(least(ceil(384.16 / (1 + (384.16 - 1) / n)), n) AS BIGINT) AS wanted,
    CAST(385 AS BIGINT) AS unlimited
FROM (SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1)""")
def proportion_sizes(spark, folder):
    sizes = read_table(spark, folder, "customer").groupBy("c_mktsegment").agg(F.count("*").alias("n"))
    return sizes.withColumns({"wanted": proportion_size(F.col("n")),
                              "unlimited": proportion_size(F.lit(None).cast("long"))})


@query("sample_size_mean", """SELECT c_mktsegment, n, CAST(least(ceil(n0 / (1 + (n0 - 1) / n)), n) AS BIGINT) AS wanted, CAST(ceil(n0) AS BIGINT) AS unlimited
FROM (SELECT c_mktsegment, count(*) AS n, 1.96 * 1.96 * power(stddev_samp(c_acctbal), 2) / (200.0 * 200.0) AS n0
      FROM customer GROUP BY 1)""")
def mean_sizes(spark, folder):
    sizes = read_table(spark, folder, "customer").groupBy("c_mktsegment").agg(
        F.count("*").alias("n"), F.stddev_samp("c_acctbal").alias("sigma"))
    return sizes.select("c_mktsegment", "n", mean_size(F.col("sigma"), F.col("n"), 200.0).alias("wanted"),
                        mean_size(F.col("sigma"), F.lit(None).cast("long"), 200.0).alias("unlimited"))
