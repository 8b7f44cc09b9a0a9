"""Program markup derived from the parts table, read back into identifiers and comments."""

import uuid

from pyspark.sql import functions as F

from ..operators import markup
from ..operators.identifiers import file_identifier_dataset
from ..session import shared_folder
from ..sources.tables import read_texts
from . import query

# every fiftieth document is cut off and does not parse
FACTS_SQL = """facts AS (SELECT p_partkey, 'src/' || lower(p_type) || '/P' || p_partkey || '.java' AS file_path,
    replace(p_brand, '#', 'No') AS brand, 'LIMIT_' || p_size AS const, 'make' || upper(p_type[1]) || lower(p_type[2:]) AS func,
    replace(p_name, ' ', '_') AS param, 'tmp' || p_size AS local, p_name AS note, p_partkey % 50 = 0 AS broken FROM part)"""


def facts(spark, folder):
    p = read_texts(spark, folder, "part", ["p_partkey", "p_name", "p_type", "p_brand", "p_size"])
    return p.select(
        "p_partkey",
        F.concat(F.lit("src/"), F.lower("p_type"), F.lit("/P"), "p_partkey", F.lit(".java")).alias("file_path"),
        F.regexp_replace("p_brand", "#", "No").alias("brand"),
        F.concat(F.lit("LIMIT_"), "p_size").alias("const"),
        F.concat(F.lit("make"), F.initcap("p_type")).alias("func"),
        F.translate("p_name", " ", "_").alias("param"),
        F.concat(F.lit("tmp"), "p_size").alias("local"),
        F.col("p_name").alias("note"),
        (F.col("p_partkey") % 50 == 0).alias("broken"),
    )


def unit(closing):
    """Markup of one class with a constant and a function, and two comments."""
    template = (
        '<unit xmlns="urn:markup" filename="%s"><comment type="line">// %s</comment>'
        "<class>class <name>%s</name><block>{<decl_stmt><decl><type><name>int</name></type> <name>%s</name></decl></decl_stmt>"
        "<function><type><name>int</name></type> <name>%s</name><parameter_list>(<parameter><decl><name>%s</name></decl></parameter>)"
        "</parameter_list><block>{<comment type=\"block\">/* %s\n */</comment><decl_stmt><decl><name>%s</name></decl></decl_stmt>}"
        "</block></function>}</block></class>"
    )
    body = F.format_string(template, "file_path", "note", "brand", "const", "func", "param", "brand", "local")
    return F.concat(body, closing)


def documents(spark, folder):
    closing = F.when(F.col("broken"), "</unit").otherwise("</unit>")
    return facts(spark, folder).select("file_path", unit(closing).alias("xml"))


IDENTIFIERS_SQL = f"""{FACTS_SQL}, found AS (
    SELECT file_path, 0 AS pos, brand AS name, 'class' AS kind, 'global' AS scope FROM facts WHERE NOT broken
    UNION ALL SELECT file_path, 1, const, 'variable', 'global' FROM facts WHERE NOT broken
    UNION ALL SELECT file_path, 2, func, 'function', 'global' FROM facts WHERE NOT broken
    UNION ALL SELECT file_path, 3, param, 'parameter', 'parameter' FROM facts WHERE NOT broken
    UNION ALL SELECT file_path, 4, local, 'variable', 'local' FROM facts WHERE NOT broken)"""


@query("markup_identifiers", f"""WITH {IDENTIFIERS_SQL}
SELECT file_path, pos, name, kind, scope, CAST(length(name) AS INTEGER) AS length,
    CASE pos WHEN 0 THEN 'PascalCase' WHEN 1 THEN 'SCREAMING_SNAKE' WHEN 2 THEN 'camelCase' ELSE 'snake_case' END AS convention,
    CAST(len(list_filter(regexp_split_to_array(regexp_replace(name, '([A-Z])', ' \\1', 'g'), '[_ ]+'), lambda x: x <> '')) AS INTEGER) AS n_tokens
FROM found""")
def identifiers(spark, folder):
    return markup.extract_identifiers(documents(spark, folder))


@query("markup_comments", f"""WITH {FACTS_SQL}
SELECT file_path, 0 AS pos, note AS comment_text FROM facts WHERE NOT broken
UNION ALL SELECT file_path, 1, brand FROM facts WHERE NOT broken""")
def comments(spark, folder):
    return markup.extract_comments(documents(spark, folder))


def archives(spark, folder):
    """Archives of two units each; the second unit has no file name of its own kind."""
    both = F.concat(F.lit('<unit xmlns="urn:markup" revision="1">'), unit(F.lit("</unit>")),
                    F.lit("<unit><function><name>extra</name></function></unit>"), F.lit("</unit>"))
    return facts(spark, folder).select(F.col("p_partkey").cast("string").alias("document"), both.alias("xml"))


@query("archive_units", f"""WITH {FACTS_SQL}
SELECT CAST(p_partkey AS VARCHAR) AS document, 0 AS unit_no, file_path FROM facts
UNION ALL SELECT CAST(p_partkey AS VARCHAR), 1, '' FROM facts""")
def units(spark, folder):
    return markup.split_units(archives(spark, folder)).select("document", "unit_no", "file_path")


@query("archive_identifiers", f"""WITH {FACTS_SQL}
SELECT kind, count(*) AS n FROM (SELECT unnest(['class', 'variable', 'function', 'parameter', 'variable', 'function']) AS kind
    FROM facts) GROUP BY kind""")
def archive_identifiers(spark, folder):
    found = markup.extract_identifiers(markup.split_units(archives(spark, folder)))
    return found.groupBy("kind").agg(F.count("*").alias("n"))


def archive_files(spark, folder):
    """The folder of four archive files, whose units are in order of their part; where a unit is cut off the next one follows at once."""
    parts = facts(spark, folder)
    units_of = parts.select((F.col("p_partkey") % 4).alias("archive"), F.col("p_partkey").alias("place"),
                            unit(F.when(F.col("broken"), "</unit").otherwise("</unit>")).alias("value"))
    edges = spark.range(4).select(F.col("id").alias("archive"), F.explode(F.array(
        F.struct(F.lit(-1).cast("long").alias("place"), F.lit('<unit xmlns="urn:markup" xmlns:cpp="urn:cpp" revision="1">').alias("value")),
        F.struct(F.lit(1 << 60).alias("place"), F.lit("<unit><function><name>extra</name></function></unit></unit>").alias("value")))).alias("e"))
    lines = units_of.unionByName(edges.select("archive", "e.place", "e.value"))
    path = f"{shared_folder(spark)}/archives-{uuid.uuid4()}"
    lines.repartition(4, "archive").sortWithinPartitions("archive", "place").select("archive", "value").write.partitionBy("archive").text(path)
    return path


@query("archive_file_units", f"""WITH {FACTS_SQL}
SELECT CAST(p_partkey % 4 AS INTEGER) AS archive, CAST(row_number() OVER (PARTITION BY p_partkey % 4 ORDER BY p_partkey) - 1 AS INTEGER) AS unit_no, file_path FROM facts WHERE NOT broken
UNION ALL SELECT CAST(p_partkey % 4 AS INTEGER), CAST(count(*) AS INTEGER), '' FROM facts WHERE NOT broken GROUP BY 1""")
def file_units(spark, folder):
    read = markup.read_units(spark, archive_files(spark, folder))
    return read.select(F.regexp_extract("document", "archive=([0-9]+)", 1).cast("int").alias("archive"), "unit_no", "file_path")


@query("archive_file_identifiers", f"""WITH {IDENTIFIERS_SQL}
SELECT file_path, pos, name, kind, scope FROM found UNION ALL
SELECT '', 0, 'extra', 'function', 'global' FROM (SELECT DISTINCT p_partkey % 4 FROM facts)""")
def file_identifiers(spark, folder):
    read = markup.read_units(spark, archive_files(spark, folder))
    return markup.extract_identifiers(read).select("file_path", "pos", "name", "kind", "scope")


@query("function_names", f"""WITH {FACTS_SQL} SELECT file_path, 2 AS pos, func AS name, CAST(1 AS BIGINT) AS n_functions FROM facts WHERE NOT broken""")
def functions(spark, folder):
    return markup.function_names(markup.extract_identifiers(documents(spark, folder)))


PART_SQL = r"list_filter(regexp_split_to_array(regexp_replace(name, '([A-Z])', ' \1', 'g'), '[_ ]+'), lambda x: x <> '')"


@query("file_identifier_dataset", f"""WITH {IDENTIFIERS_SQL},
parts AS (SELECT file_path, name, pos, {PART_SQL} AS parts FROM found),
vocab AS (SELECT file_path, count(DISTINCT lower(part)) AS v FROM (SELECT file_path, unnest(parts) AS part FROM parts) GROUP BY 1),
sums AS (SELECT file_path, count(*) AS n, sum(length(name)) AS chars, sum(len(parts)) AS tokens FROM parts GROUP BY 1)
SELECT file_path, coalesce(n, 0) AS n_identifiers, round(coalesce(chars / n, 0), 6) AS avg_identifier_length,
    round(coalesce(tokens / n, 0), 6) AS avg_tokens_per_identifier, coalesce(v, 0) AS vocab_size,
    round(coalesce(v / tokens, 0), 6) AS vocab_diversity, CASE WHEN n IS NULL THEN 0 ELSE 0.4 END::DOUBLE AS pct_snake_case,
    CASE WHEN n IS NULL THEN 0 ELSE 0.2 END::DOUBLE AS pct_camel_case, CASE WHEN n IS NULL THEN 0 ELSE 0.2 END::DOUBLE AS pct_pascal_case
FROM facts LEFT JOIN sums USING (file_path) LEFT JOIN vocab USING (file_path)""")
def dataset(spark, folder):
    table = file_identifier_dataset(documents(spark, folder))
    ratios = [name for name in table.columns if name.startswith(("avg", "pct")) or name == "vocab_diversity"]
    return table.withColumns({name: F.round(name, 6) for name in ratios})
