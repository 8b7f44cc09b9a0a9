"""The queries of the operators in this subpackage, and SQL that returns the same rows where SQL can."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import best_fit_packing, hard_negatives, language_id, licence_classifier, ordinal_quality, parity_join, recurrent_lm, repetition_rules, template_decontamination, token_alignment, toxic_segments, url_rules, warc_index

QUERIES = {}
ORACLES = {}


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _query(function):
    QUERIES[function.__name__] = function
    return function


def in_fold(column: str, folds: int, rest: int = 0) -> Column:
    """Whether crc32 of the id as text leaves ``rest`` when divided by ``folds``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % folds == rest


# --- 1: benchmark decontamination ---------------------------------------------------------------


@_query
def op1_template_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = template_decontamination.contaminated(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "item_id", "item_words", "covered_words", "slots_changed")


# --- 2: quality rules ---------------------------------------------------------------------------


@_query
def op2_repetition_rules(spark: SparkSession, folder: str) -> DataFrame:
    return repetition_rules.measure_repetition(_table(spark, folder, "documents"))


def _window_sql(k: int) -> str:
    key = ", ".join(["word", *(f"lead(word, {i}) OVER w" for i in range(1, k))])
    full = f"lead(word, {k - 1}) OVER w IS NOT NULL"
    return f"CASE WHEN {full} THEN concat_ws(' ', {key}) END AS key{k}"


def _repetition_sql(rules: repetition_rules.Rules) -> str:
    sizes = sorted({rules.base_window, *(k for k, _ in rules.windows)})
    dup = ", ".join(f"key{k} IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, key{k}) > 1 AS dup{k}" for k in sizes)
    cover = ", ".join(f"bool_or(dup{k}) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW) AS cover{k}" for k in sizes)
    chars = ", ".join(f"coalesce(sum(length(word)) FILTER (cover{k}), 0)::BIGINT AS dup_{k}gram_chars" for k, _ in rules.windows)
    names = ", ".join(f"coalesce(dup_{k}gram_chars, 0) AS dup_{k}gram_chars" for k, _ in rules.windows)
    shares = " AND ".join(f"dup_{k}gram_chars <= {share} * greatest(word_chars, 1)" for k, share in rules.windows)
    return rf"""
    WITH words AS (
      SELECT doc_id, unnest(ws) AS word, unnest(range(len(ws))) AS pos
      FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents)),
    keyed AS (SELECT *, {", ".join(_window_sql(k) for k in sizes)} FROM words WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
    marked AS (SELECT doc_id, pos, word, {dup} FROM keyed),
    covers AS (SELECT doc_id, word, {cover} FROM marked),
    by_doc AS (SELECT doc_id, count(*) AS n_words, sum(length(word))::BIGINT AS word_chars,
        count(*) FILTER (cover{rules.base_window}) AS n_repeat_words, {chars} FROM covers GROUP BY doc_id),
    lines AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents),
    line_counts AS (SELECT doc_id, line, count(*) AS n, length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) AS chars
      FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id, line),
    by_line AS (SELECT doc_id, sum(n - 1)::BIGINT AS n_dup_lines, sum((n - 1) * chars)::BIGINT AS dup_line_chars FROM line_counts GROUP BY doc_id),
    joined AS (SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
        length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
        coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(dup_line_chars, 0) AS dup_line_chars, {names}
      FROM documents d LEFT JOIN by_doc USING (doc_id) LEFT JOIN by_line USING (doc_id)),
    based AS (SELECT *, n_words < {rules.min_words} OR 100 * n_repeat_words > {rules.repeat_words_pct} * n_words AS base_failed FROM joined)
    SELECT *, NOT base_failed AND dup_line_chars <= {rules.line_chars} * greatest(word_chars, 1)
      AND {shares} AS kept, n_symbols > {rules.symbols} * n_words AS many_symbols FROM based"""


ORACLES["op2_repetition_rules"] = _repetition_sql(repetition_rules.Rules())


# --- 3: best-fit packing ------------------------------------------------------------------------


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def piece_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@_query
def op3_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return best_fit_packing.pack_documents(_table(spark, folder, "documents"), tokenizer_path())


# --- 4: quality classifier ----------------------------------------------------------------------


@_query
def op4_ordinal_quality(spark: SparkSession, folder: str) -> DataFrame:
    # Grades from the two ratings: 0 poor, 1 good but toxic, 2 good.
    grades = _table(spark, folder, "labels").select("doc_id", (F.col("quality") * (2 - F.col("toxic"))).alias("grade"))
    docs = _table(spark, folder, "documents")
    model = ordinal_quality.fit(docs, grades, 3, ~in_fold("doc_id", 5))
    graded = ordinal_quality.grade_documents(docs, model)
    good = F.col("tail")[0]
    return graded.select("doc_id", in_fold("doc_id", 5).alias("held_out"), "expected_grade", good.alias("p_good"), F.col("tail")[1].alias("p_best"), (good >= 0.5).alias("kept"))


# --- 5: n-gram Jaccard join ---------------------------------------------------------------------


@_query
def op5_parity_join(spark: SparkSession, folder: str) -> DataFrame:
    return parity_join.classes(_table(spark, folder, "documents"), shingle=3, percent=90)


ORACLES["op5_parity_join"] = r"""
    WITH RECURSIVE words AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
      FROM documents),
    shingles AS (SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [list_aggregate(ws, 'string_agg', ' ')]
        ELSE list_distinct([ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] for i in range(1, len(ws) - 1)]) END) AS s FROM words),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    -- a pair that reaches 0.9 shares one of the first tenth of either set, the rarest shingles first
    ranked AS (SELECT doc_id, s, n, row_number() OVER (PARTITION BY doc_id ORDER BY f, s) AS place
      FROM shingles JOIN sizes USING (doc_id) JOIN (SELECT s, count(*) AS f FROM shingles GROUP BY s) USING (s)),
    heads AS (SELECT doc_id, s, n FROM ranked WHERE place <= n - ceil(0.9 * n) + 1),
    candidates AS (SELECT DISTINCT a.doc_id AS x, b.doc_id AS y, a.n AS nx, b.n AS ny
      FROM heads a JOIN heads b ON a.s = b.s AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)),
    shared AS (SELECT x, y, nx, ny, count(*) AS n_both FROM candidates JOIN shingles a ON a.doc_id = x JOIN shingles b ON b.doc_id = y AND a.s = b.s GROUP BY ALL),
    links AS (SELECT x, y FROM shared WHERE 100 * n_both >= 90 * (nx + ny - n_both)),
    edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
    reach(doc_id, other) AS (SELECT x, y FROM edges UNION SELECT r.doc_id, e.y FROM reach r JOIN edges e ON r.other = e.x)
    SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(low, d.doc_id)) AS component_id
    FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN (SELECT doc_id, min(other) AS low FROM reach GROUP BY doc_id) r ON r.doc_id = d.doc_id"""


# --- 6: licence scans ---------------------------------------------------------------------------


@_query
def op6_licence_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return licence_classifier.statements(docs, licence_classifier.fit(docs))


# --- 7: URL filters -----------------------------------------------------------------------------

# The rules of the query.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


@_query
def op7_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_rules.judge_urls(_table(spark, folder, "pages"), rules).select("page_id", "host", "path", "rule", "verdict")


ORACLES["op7_url_rules"] = rf"""
    WITH rules(rule_host, rule_path, rule_verdict) AS (VALUES {", ".join(map(str, URL_RULES))}),
    rest AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
    split AS (SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host) + length(rule_path) DESC NULLS LAST) AS place
      FROM split LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
    SELECT page_id, host, path, rule_host || rule_path AS rule, coalesce(rule_verdict, 'allow') AS verdict FROM ranked WHERE place = 1"""


# --- 8: LM scoring ------------------------------------------------------------------------------


@_query
def op8_recurrent_lm(spark: SparkSession, folder: str) -> DataFrame:
    return recurrent_lm.score_documents(_table(spark, folder, "documents"), in_fold("doc_id", 10))


# --- 9: WARC ------------------------------------------------------------------------------------


@_query
def op9_warc_index(spark: SparkSession, folder: str) -> DataFrame:
    archives = warc_index.new_folder(spark)
    index = warc_index.write_archives(_table(spark, folder, "pages"), archives)
    return warc_index.read_records(index, archives, payload=False)


ORACLES["op9_warc_index"] = f"""
    WITH firsts AS (SELECT page_id, encode(coalesce(html, '')) AS payload, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages)
    SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha256(payload) AS payload_digest,
      CASE WHEN octet_length(payload) >= {warc_index.MIN_SHARED} AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
      CASE WHEN octet_length(payload) >= {warc_index.MIN_SHARED} AND page_id > first THEN first END AS refers_to FROM firsts"""


# --- 10: toxicity -------------------------------------------------------------------------------


@_query
def op10_toxic_segments(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    model = toxic_segments.fit(docs, _table(spark, folder, "labels"), ~in_fold("doc_id", 5))
    scored = toxic_segments.score_documents(docs, model)
    return scored.select("doc_id", in_fold("doc_id", 5).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "segments")


# --- 11: cross-tokenizer alignment --------------------------------------------------------------


@_query
def op11_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return token_alignment.alignment_counts(_table(spark, folder, "documents"), tokenizer_path(), piece_path())


# --- 12: language identification ----------------------------------------------------------------


@_query
def op12_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    model = language_id.fit(docs, ~in_fold("doc_id", 4, 2))
    found = language_id.identify(docs, model)
    return found.select("doc_id", in_fold("doc_id", 4, 2).alias("held_out"), "lang_pred", "score", "accepted")


# --- 13: hard negatives -------------------------------------------------------------------------


@_query
def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    changed = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(_table(spark, folder, "embeddings").withColumn("label", changed), F.col("id") % 100 == 0)


ORACLES["op13_hard_negatives"] = """
    WITH rows AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * x::DOUBLE) for x in embedding] AS v
      FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
    scored AS (SELECT a.vec_id AS anchor_id, r.vec_id AS other, a.label = r.label AS alike, list_inner_product(a.v, r.v)::BIGINT AS score
      FROM rows a JOIN rows r ON a.vec_id % 100 = 0 AND r.vec_id <> a.vec_id),
    positives AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE alike
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
    SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other))::INT AS rank,
      other AS negative_id, positive_score, score AS negative_score
    FROM positives JOIN scored USING (anchor_id)
    WHERE NOT alike AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score QUALIFY rank <= 10"""
