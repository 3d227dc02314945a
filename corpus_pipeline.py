"""Corpus pipeline: stages over ``documents``, each written and read again by the next.

Toxic documents go, one document of each near-duplicate group stays, long repeats are cut out, the rest is sampled to target
weights and packed into sequences. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from editsieve.llm.common import documents, scratch_path
from editsieve.llm.mixing import sample_to_targets
from editsieve.llm.packing import packed_documents
from editsieve.llm.repeats import remove_passages
from editsieve.llm.simhash import NEAR, keep_one
from editsieve.llm.toxicity import reject_toxic


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return reject_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs, **NEAR)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return remove_passages(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sample_to_targets(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packed_documents(spark, docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", drop_near_duplicates),
    ("suffix-array dedup", cut_repeats),
    ("mixing sources", mix_sources),
    ("best-fit packing", pack_sequences),
]

# Trained models, links and token ids are beyond SQL: the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage works on what the one before has written."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
