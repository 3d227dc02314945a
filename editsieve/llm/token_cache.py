"""Token counts with a digest cache.

The cache is a Parquet table of (content digest, tokenizer digest, number of tokens). A run
computes the digest of each text in the scan, looks the digests up, fetches one text for each digest
that is missing, encodes those, appends their counts and answers from the table. Nothing is counted
twice: not copies within a run, nor texts of earlier runs with the same vocabulary file.

Normalisation is "null is empty" and nothing else, since any other change could change the count.
Defined results: empty texts have 0 tokens; equal rows give equal rows; null ids are kept; an empty table
gives no row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editsieve.llm.bpe import PieceEncoder, tokenizer_path, tokenizer_version
from editsieve.llm.common import id_text, scratch_path

LIMIT = 1024
CACHE = "content string, version string, n_tokens long"


def _count_json(path: str, texts: pa.Array) -> list[int]:
    return [len(ids) // 4 for ids in PieceEncoder.of(path).stream(texts)]


def _count_model(path: str, texts: pa.Array) -> list[int]:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [len(model.encode(text.as_py())) for text in texts]


def count_texts(texts: DataFrame, path: str, version: str) -> DataFrame:
    """One row (content, version, n_tokens) per row of (content, text)."""
    count = _count_model if path.endswith(".model") else _count_json

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            n = count(path, batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("content"), pa.array([version] * len(n), pa.string()), pa.array(n, pa.int64())],
                names=["content", "version", "n_tokens"],
            )

    return texts.mapInArrow(run, CACHE)


def read_cache(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """Stored counts of one tokenizer version, one row per digest; an absent cache is an empty one.

    The same digest may be stored more than once (two runs at once, a repeated append); its counts are equal, and the
    smallest is taken, so a lookup never multiplies rows. Copies combine on the map side.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(cache)
    found = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)
    table = spark.read.schema(CACHE).parquet(cache) if found else spark.createDataFrame([], CACHE)
    return table.where(F.col("version") == version).groupBy("content").agg(F.min("n_tokens").alias("n_tokens"))


def refresh_cache(docs: DataFrame, cache: str, path: str) -> str:
    """Encode the distinct texts that the cache lacks and append them; returns the tokenizer digest."""
    spark, version = docs.sparkSession, tokenizer_version(path)
    rows = id_text(docs).withColumn("content", F.sha2("text", 256))
    # One owner per digest. Copies combine before the shuffle, so a text that makes up a third of the
    # table is one row per task here.
    owners = rows.groupBy("content").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id")).alias("o"))
    missing = owners.join(read_cache(spark, cache, version), "content", "left_anti").select(
        F.col("content").alias("c"), F.col("o.doc_id").alias("d")
    )
    # Joined by id and digest, so texts spread evenly and a copy that is not the owner drops out at once.
    own = (F.col("content") == F.col("c")) & F.col("doc_id").eqNullSafe(F.col("d"))
    texts = rows.join(missing.hint("shuffle_hash"), own, "left_semi").select("content", "text")
    # Rows equal in id and text share an owner: their counts are equal and become one row again.
    counted = count_texts(texts, path, version).groupBy("content", "version").agg(F.min("n_tokens").alias("n_tokens"))
    counted.write.mode("append").parquet(cache)
    return version


def token_counts(docs: DataFrame, cache: str, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every document."""
    version = refresh_cache(docs, cache, path)
    spark = docs.sparkSession
    light = id_text(docs).select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("content"))
    return light.join(read_cache(spark, cache, version), "content").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )


def cached_counts(spark: SparkSession, docs: DataFrame, path: str | None = None, cache: str | None = None) -> DataFrame:
    return token_counts(docs, cache or scratch_path(spark, "token-cache"), path or tokenizer_path("byte_bpe_50k.json"))
