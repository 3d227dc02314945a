"""The registered queries of this package, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from editsieve.llm import mixing
from editsieve.llm.collocations import ORACLE as COLLOCATIONS_SQL
from editsieve.llm.collocations import collocations
from editsieve.llm.common import documents
from editsieve.llm.fertility import quality_rules
from editsieve.llm.maxent_lm import language_model_scores
from editsieve.llm.packing import packed_documents
from editsieve.llm.quality_cnn import quality_scores
from editsieve.llm.repeats import repeat_report
from editsieve.llm.simhash import simhash_components
from editsieve.llm.sketch import edited_pairs
from editsieve.llm.token_cache import cached_counts
from editsieve.llm.token_frames import token_frames
from editsieve.llm.toxicity import toxicity
from editsieve.llm.vector_codes import compress_vectors

QUERIES = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(spark, documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@query
def op2_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model_scores(spark, documents(spark, sf_dir))


@query
def op3_token_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_frames(spark, documents(spark, sf_dir))


@query
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(spark, documents(spark, sf_dir))


@query
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cached_counts(spark, documents(spark, sf_dir))


@query
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(spark, documents(spark, sf_dir))


@query
def op7_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(spark, documents(spark, sf_dir))


@query
def op8_scaled_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_pairs(spark, documents(spark, sf_dir))


@query
def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_report(spark, documents(spark, sf_dir), texts=True)


@query
def op10_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture_report(spark, documents(spark, sf_dir))


ORACLES["op10_mixture"] = mixing.oracle()


@query
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress_vectors(spark, spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(spark, documents(spark, sf_dir))


ORACLES["op12_collocations"] = COLLOCATIONS_SQL


@query
def op13_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(spark, documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
