"""A training-data pipeline over `documents`: judge, deduplicate, decontaminate, mix, write ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next one's docs.  All but the last return the columns of docs.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tallyforge.llm import decontaminate, jaccard_join, mix_sources, quality_classifier, token_output
from tallyforge.llm.common import documents, ensure_checkpoints


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality classifier rejects go."""
    return quality_classifier.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that the n-gram Jaccard join links, the one with the smallest doc_id stays.

    Texts link at 0.8 over shingles of five words, a wider definition than the query op5's own.
    """
    return jaccard_join.one_of_each(docs, width=5, num=80, den=100)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold a window of a benchmark item go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as many times as its source's target takes it."""
    return mix_sources.mixed(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each record of the files written."""
    return token_output.token_output(docs)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("benchmark", benchmark), ("mixture", mixture), ("token_ids", token_ids)]

#: The classifier and the tokenizer can't be expressed in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of `documents`, each written to the shared checkpoint folder and read again."""
    ensure_checkpoints(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs.write.parquet(f"{folder}/{name}")
            docs = spark.read.parquet(f"{folder}/{name}")
    return docs
