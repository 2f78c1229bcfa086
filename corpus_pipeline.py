"""Corpus pipeline: five stages from raw documents to a training mix.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes every result
as Parquet in the shared scratch folder and reads it again as the next stage's ``docs``. All
stages but the last return the columns of ``documents``:

1. quality: documents that the quality classifier rejects go;
2. near_duplicates: one document of each near-duplicate group stays;
3. decontaminate: documents that hold a benchmark item go;
4. personal_data: spans of personal data are replaced in the text;
5. mix: documents are sampled towards the target weights of sources, languages and topics.

Nulls, empty texts, repeated rows, empty tables and extra columns are treated as the
operators' docstrings say; no stage drops a row for any other reason than its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from listinglake.llm import decontam, mixing, neardup, pii, quality
from listinglake.llm.tables import configure, table
from listinglake.session import store


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(configure(spark), sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return neardup.keep_first(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.keep_clean(docs, table(configure(spark), sf_dir, "benchmark"))


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return pii.redact(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return mixing.sampled(docs)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontaminate", decontaminate_stage),
    ("personal_data", personal_data_stage),
    ("mix", mix_stage),
]

#: Trained classifiers and MinHash have no SQL; tests hold ``run`` against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(configure(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
