"""The registered queries and the pipeline on the smallest tables."""

import os
from pathlib import Path

import pytest
from oracle import compare, connect

import corpus_pipeline
from repoquarry.llm.queries import ORACLES, QUERIES
from repoquarry.session import materialize, shared_folder

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    problem, n, _ = compare(spark, connect(FOLDER), FOLDER, QUERIES[name], ORACLES.get(name))
    assert problem is None and n > 0


def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, left = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, FOLDER))
        assert docs.columns == columns, name
        left.append(docs.count())
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert left == sorted(left, reverse=True) and left[-1] > 0
    assert packed.select("doc_id").distinct().count() == left[-1]
    whole = corpus_pipeline.run(spark, FOLDER)
    assert sorted(r["doc_id"] for r in whole.select("doc_id").distinct().collect()) == sorted(r["doc_id"] for r in docs.collect())


def test_pipeline_writes_every_stage_but_the_last(spark):
    folder = Path(shared_folder(spark).removeprefix("file://"))
    before = set(folder.glob("pipeline-*"))
    whole = corpus_pipeline.run(spark, FOLDER)
    (made,) = set(folder.glob("pipeline-*")) - before
    names = [name for name, _ in corpus_pipeline.STAGES[:-1]]
    assert sorted(p.name for p in made.iterdir()) == [f"{k}-{name}" for k, name in enumerate(names)]
    last = spark.read.parquet(f"file://{made}/{len(names) - 1}-{names[-1]}")
    assert last.columns == spark.read.parquet(f"{FOLDER}/documents.parquet").columns
    assert {r["doc_id"] for r in last.collect()} == {r["doc_id"] for r in whole.select("doc_id").collect()}


def test_pipeline_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, FOLDER))
        assert docs.count() == 0
