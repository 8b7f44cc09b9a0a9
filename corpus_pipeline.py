"""From raw documents to packed training sequences, in stages that are written and read again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from repoquarry.llm import best_fit_packing, parity_join, repetition_rules, template_decontamination, toxic_segments
from repoquarry.llm.queries import in_fold, tokenizer_path
from repoquarry.session import shared_folder


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that the repetition rules reject, and those of many symbols; null texts are rejected."""
    return repetition_rules.keep_unrepetitive(docs)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents whose passages are toxic; labels of the documents that are left teach the scores."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxic_segments.drop_toxic(docs, toxic_segments.fit(docs, labels, ~in_fold("doc_id", 5)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of texts whose 5-word shingles link them at 0.8 or more."""
    return parity_join.keep_one(docs, shingle=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold a benchmark item, as it is or with other slot values."""
    return template_decontamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, with their token ids, and their places in sequences of 2,048 tokens."""
    return best_fit_packing.pack_documents(docs, tokenizer_path(), with_ids=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]

ORACLE_SQL = None  # the toxicity scores are learned


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage over what the others wrote, each to a folder of its own under ``spark.checkpoint.dir``."""
    docs, folder = spark.read.parquet(f"{sf_dir}/documents.parquet"), f"{shared_folder(spark)}/pipeline-{uuid.uuid4()}"
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            schema, path = docs.schema, f"{folder}/{k}-{name}"
            docs.write.parquet(path)
            docs = spark.read.schema(schema).parquet(path)
    return docs
