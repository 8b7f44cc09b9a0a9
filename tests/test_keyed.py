"""Stored tables that are merged by bucket."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from repoquarry.operators import upsert as ops
from repoquarry.sources.keyed import KeyedTable

RULES = ops.Rules(("repo", "number"), latest=("title",), least=("created",), filled=("closed",))
SCHEMA = "repo string, number int, title string, created long, closed long, seq long"


def rows(spark, numbers, title, seq=1):
    return spark.createDataFrame([("r", n, f"{title}{n}", 100 - seq, None if n % 2 else seq, seq) for n in numbers], SCHEMA)


def merged(old, new):
    return ops.upsert(old, new, RULES, "seq")


def files(table):
    return {f for f in table.read().select(F.input_file_name()).distinct().toPandas().iloc[:, 0]}


def content(df):
    return sorted(tuple(r) for r in df.collect())


def test_a_small_batch_touches_its_buckets_only(spark, tmp_path):
    table = KeyedTable(spark, f"file://{tmp_path}/t", RULES.keys, buckets=40)
    assert table.read() is None
    first, batch = rows(spark, range(1000), "a"), rows(spark, [3, 77, 2000], "b", 2)
    assert len(table.merge(first, merged)) == 40
    before = files(table)
    touched = table.merge(batch, merged)
    after, expected = files(table), merged(merged(None, first), batch)
    assert len(before) == 40 and 1 <= len(touched) <= 3
    assert len(before & after) == 40 - len(touched) and {f.split("keyed_bucket=")[1].split("/")[0] for f in after - before} == {str(b) for b in touched}
    assert content(table.read()) == content(expected)
    old = table.read()
    assert table.merge(batch, merged) == touched and content(table.read()) == content(expected)  # the same again
    assert content(old) == content(expected)  # a reader keeps its version
    assert table.merge(batch.limit(0), merged) == []
    again = KeyedTable(spark, f"file://{tmp_path}/t", RULES.keys, buckets=7)  # a stored table keeps its number of buckets
    again.merge(rows(spark, range(5, 9), "c", 3), merged)
    assert content(again.read()) == content(merged(expected, rows(spark, range(5, 9), "c", 3)))
    assert len(table.remove_unused(1)) >= 1 and content(table.read()) == content(again.read())


def test_keys_of_another_type_nulls_and_an_empty_table(spark, tmp_path):
    table = KeyedTable(spark, f"file://{tmp_path}/t", RULES.keys, buckets=5)
    assert table.merge(rows(spark, [], "a"), merged) == [] and table.read().count() == 0 and table.read().columns == list(RULES.columns)
    odd = spark.createDataFrame([(None, None, "x", 1, None, 1), ("r", 4, "y", 1, 2, 2)], SCHEMA)
    table.merge(odd, merged)
    table.merge(odd.withColumn("number", F.col("number").cast("long")).withColumn("seq", F.col("seq") + 9), merged)
    assert content(table.read().na.fill("").na.fill(0)) == [("", 0, "x", 1, 0), ("r", 4, "y", 1, 2)]


def test_a_lost_run_and_a_second_writer_change_nothing(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    table = KeyedTable(spark, path, RULES.keys, buckets=5)
    table.merge(rows(spark, range(20), "a"), merged)
    before = content(table.read())
    with pytest.raises(RuntimeError):
        table.merge(rows(spark, range(20), "b", 2), lambda old, new: (_ for _ in ()).throw(RuntimeError("lost")))
    (tmp_path / "t" / "manifest" / "0000000002").mkdir()  # a manifest that was begun and not finished
    assert content(table.read()) == before
    with pytest.raises(AnalysisException):
        table.merge(rows(spark, [1], "b", 2), merged)
    assert content(table.read()) == before
    assert "manifest/0000000002" in table.remove_unused()
    assert table.merge(rows(spark, [1], "b", 2), merged) and ("r", 1, "b1", 98, None) in content(table.read())
    with pytest.raises(ValueError, match="other buckets"):
        other = KeyedTable(spark, f"file://{tmp_path}/u", RULES.keys, buckets=5)
        other.merge(rows(spark, [1], "b"), lambda old, new: merged(old, new.unionByName(rows(spark, range(9), "c"))))


def test_a_corpus_seen_before_stems_nothing(spark, tmp_path):
    from repoquarry.functions.stemming import with_stems
    from repoquarry.operators.vocabulary import stemmed_rows
    from repoquarry.sources.stems import StemDictionary

    words = ["running", "runs", "flies", "flying", "nation", "nationality", "sky", "a", "ponies", "caress"]
    first = spark.createDataFrame([(i, w) for i, w in enumerate(words * 3)] + [(99, None)], "pos int, token string")
    second = first.unionByName(spark.createDataFrame([(100, "relational"), (101, "relational")], "pos int, token string"))
    stems = StemDictionary(spark, f"file://{tmp_path}/stems", buckets=4)
    assert stems.grow(first) == len(words) and stems.grow(first) == 0 and stems.grow(second.limit(0)) == 0
    found = stems.stemmed_rows(second, ["pos"])
    assert content(found) == content(stemmed_rows(second, ["pos"])) and stems.grow(second) == 0
    assert content(stems.table.read()) == content(with_stems(second.where("token IS NOT NULL").select("token").distinct()))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and "__salt" not in plan  # rows of frequent words meet their stems in a broadcast
    empty = StemDictionary(spark, f"file://{tmp_path}/none")
    assert empty.grow(first.limit(0)) == 0 and empty.table.read().count() == 0


def test_words_meet_the_stored_stems_once(spark, tmp_path, monkeypatch):
    from repoquarry.sources import keyed, stems as source
    from repoquarry.sources.stems import StemDictionary

    tokens = spark.createDataFrame([(0, "running"), (1, "runs"), (2, "odd"), (3, None), (4, "runs"), (5, "flies"), (6, "void")], "pos int, token string")
    stems = StemDictionary(spark, f"file://{tmp_path}/stems", buckets=4)
    # a stored stem holds, whatever the stemmer says; so do words that no row has
    kept = spark.createDataFrame([("odd", "strange"), ("void", None), ("other", "other")], "token string, stem string")
    stems.table.merge(kept, lambda old, batch: batch)
    calls = []
    for module in (keyed, source):
        monkeypatch.setattr(module, "materialize", lambda df, f=module.materialize: calls.append("materialize") or f(df))
    monkeypatch.setattr(stems.table, "read", lambda f=stems.table.read: calls.append("read") or f())
    found = stems.stemmed_rows(tokens, ["pos"])
    assert sorted(calls) == ["materialize", "materialize", "read"]
    expected = {(0, "run"), (1, "run"), (2, "strange"), (4, "run"), (5, "fli"), (6, None)}
    assert {(r.pos, r.token) for r in found.collect()} == expected and found.count() == 6 and found.columns == ["pos", "token"]
    assert {tuple(r) for r in stems.table.read().collect()} == {
        ("odd", "strange"), ("void", None), ("other", "other"), ("running", "run"), ("runs", "run"), ("flies", "fli")}
    assert stems.grow(tokens) == 0 and stems.stemmed_rows(tokens.limit(0), ["pos"]).count() == 0
    # a dictionary that is not stored yet, with rows and without
    for name, rows, n in (("none", tokens, 6), ("void", tokens.where("token IS NULL"), 0)):
        fresh = StemDictionary(spark, f"file://{tmp_path}/{name}", buckets=4)
        assert fresh.stemmed_rows(rows, ["pos"]).count() == n and fresh.table.read().count() == max(n - 1, 0)
