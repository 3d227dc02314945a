"""Helpers shared by the operators of this package.

Null texts count as empty and null ids sort first everywhere. Operators that return digest
rows read only ``doc_id`` and ``text`` (plus what they name), so other columns of the input
cannot clash; those that return documents carry the input columns in one struct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from editsieve.operators.scale import scratch_path, settle

__all__ = ["bucket_bounds", "bucket_of", "documents", "id_text", "scratch_path", "settle", "shuffle_width"]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_text(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bucket_bounds(docs: DataFrame, column: str, rows_per_bucket: int) -> list:
    """Upper bounds that cut ``column`` into ranges of about ``rows_per_bucket`` rows.

    Only this column is scanned. The list has one number per bucket, as a range exchange has.
    """
    n = docs.select(F.count(column)).first()[0]
    k = -(-n // rows_per_bucket)
    if k <= 1:
        return []
    cuts = [i / k for i in range(1, k)]
    found = docs.select(F.percentile_approx(column, cuts, max(10_000, 20 * k))).first()[0]
    return sorted(set(found))


def bucket_of(value: Column, bounds: list) -> Column:
    """Number of bounds below ``value``; null goes to bucket 0. Two short scans instead of one long one."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    coarse = F.array(*(F.lit(b) for b in bounds[step - 1 :: step]))
    fine = F.array(*(F.lit(b) for b in bounds))
    whole = F.size(F.filter(coarse, lambda b: b < value)) * F.lit(step)
    rest = F.size(F.filter(F.slice(fine, whole + F.lit(1), F.lit(step)), lambda b: b < value))
    return F.when(value.isNull(), F.lit(0)).otherwise(whole + rest).cast("int")
