"""Deduplicating, rebalancing, shuffling and splitting the training table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.features import row_hash
from ..functions.text import parse_ts
from ..schemas import DEDUP_COLUMNS
from .scale import first_per_key, mark_first, null_safe_join, rank_cuts, settle

SEED = 42
TAIL_ROWS = 200
_LAST = (1 << 63) - 1


def _hash_levels(h: Column) -> list[Column]:
    return [F.substring(h, 1, 4), F.substring(h, 1, 8), F.substring(h, 1, 12)]


def drop_duplicates(df: DataFrame, priority: list[str], keys: list[str] | None = None) -> DataFrame:
    """First row per identity columns; ``priority`` (ascending) says which row is first."""
    return first_per_key(df, keys or DEDUP_COLUMNS, [F.col(c) for c in priority])


def label_counts(df: DataFrame, by: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg")
    )


def with_caps(counts: DataFrame, ratio: int) -> DataFrame:
    """Negatives allowed per language. A null language never has positives of its own."""
    own = F.when(F.col("lang").isNull(), F.lit(0)).otherwise(F.col("pos"))
    return counts.withColumn("cap", F.when(own > 0, own * ratio).otherwise(F.lit(ratio * 50)))


def rebalance(
    df: DataFrame, ratio: int = 6, seed: int = SEED, id_columns: list[str] | None = None, task_rows: int | None = None
) -> DataFrame:
    """All positives, and per language at most ``ratio`` negatives per positive.

    Negatives are chosen by a seeded hash of ``id_columns`` (unique per row): the same rows
    on every run, whatever the partitioning. With one class missing the input is unchanged.
    """
    counts = settle(with_caps(label_counts(df, ["lang"]), ratio), "label-counts")
    totals = counts.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n")).first()
    if not totals.p or not totals.n:
        return df
    h = row_hash(id_columns or DEDUP_COLUMNS, seed)
    order = [h]
    cuts = rank_cuts(
        df.where(F.col("label") == 0), ["lang"], order, _hash_levels(h), F.col("cap"),
        counts.select("lang", "cap"), task_rows,
    )
    marked = mark_first(df, cuts, ["lang"], order, "__kept")
    return marked.where((F.col("label") == 1) | ((F.col("label") == 0) & F.col("__kept"))).drop("__kept")


def shuffled(df: DataFrame, seed: int = SEED, id_columns: list[str] | None = None) -> DataFrame:
    """Rows in seeded hash order (a range-partitioned sort)."""
    return df.orderBy(row_hash(id_columns or DEDUP_COLUMNS, seed))


# --- splits ------------------------------------------------------------------------------

def _time_order(tie: Column) -> tuple[list[Column], list[Column]]:
    micros = F.coalesce(F.unix_micros(parse_ts(F.col("timestamp"))), F.lit(_LAST))
    return [micros, tie], [F.floor(micros / F.lit(3_600_000_000)).cast("bigint"), micros, *_hash_levels(tie)]


def temporal_split(df: DataFrame, id_columns: list[str] | None = None, task_rows: int | None = None) -> DataFrame:
    """Add ``split``: the oldest four fifths of each language are ``train``, the rest ``holdout``.

    Unreadable times count as newest. Rows of the same time are ordered by a hash of
    ``id_columns``.
    """
    order, levels = _time_order(row_hash(id_columns or DEDUP_COLUMNS, SEED))
    quota = F.greatest(F.floor(F.col("total") * 4 / 5), F.lit(1))
    cuts = rank_cuts(df, ["lang"], order, levels, quota, task_rows=task_rows)
    marked = mark_first(df, cuts, ["lang"], order, "__in")
    return marked.withColumn("split", F.when(F.col("__in"), "train").otherwise("holdout")).drop("__in")


def tail_holdout(train: DataFrame, rows: int = TAIL_ROWS) -> DataFrame:
    """Last rows of the training part, for an empty holdout. They stay in training as well.

    Only reached when every language has a single row, so the input is one row per language.
    """
    micros = F.unix_micros(parse_ts(F.col("timestamp")))
    return train.orderBy(F.desc_nulls_first("lang"), F.desc_nulls_first(micros)).limit(rows)


def stratified_split(
    df: DataFrame, seed: int = SEED, id_columns: list[str] | None = None, task_rows: int | None = None
) -> DataFrame:
    """Add ``split``: a seeded random fifth of each label is ``holdout``."""
    h = row_hash(id_columns or DEDUP_COLUMNS, seed)
    cuts = rank_cuts(df, ["label"], [h], _hash_levels(h), F.ceil(F.col("total") * 0.2), task_rows=task_rows)
    marked = mark_first(df, cuts, ["label"], [h], "__in")
    return marked.withColumn("split", F.when(F.col("__in"), "holdout").otherwise("train")).drop("__in")


def stratified_folds(
    df: DataFrame, folds: int = 3, seed: int = SEED, id_columns: list[str] | None = None, task_rows: int | None = None
) -> DataFrame:
    """Add ``fold`` 1..folds, equal shares of each label in hash order (the first folds take the rest)."""
    h = row_hash(id_columns or DEDUP_COLUMNS, seed)
    share, rest = F.floor(F.col("total") / folds), F.col("total") % folds
    fold = F.lit(1)
    for i in range(1, folds):
        upto = share * i + F.least(rest, F.lit(i))
        cuts = rank_cuts(df, ["label"], [h], _hash_levels(h), upto, task_rows=task_rows)
        df = mark_first(df, cuts, ["label"], [h], f"__in{i}")
        fold = fold + F.when(F.col(f"__in{i}"), 0).otherwise(1)
    return df.withColumn("fold", fold).drop(*(f"__in{i}" for i in range(1, folds)))


def split_label_counts(split: DataFrame) -> DataFrame:
    """Distinct labels per part; a part with fewer than two triggers the stratified fallback."""
    return split.groupBy("split").agg(F.count_distinct("label").alias("labels"), F.count(F.lit(1)).alias("rows"))


def train_holdout(df: DataFrame, id_columns: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Temporal split with its two fallbacks. ``df`` is read once per part: the cuts are found first and compared row by row, so
    no second copy of the rows is written."""
    split = temporal_split(df, id_columns)
    seen = {r.split: r for r in split_label_counts(split).collect()}
    train, hold = (split.where(F.col("split") == s).drop("split") for s in ("train", "holdout"))
    hold_labels = seen["holdout"].labels if "holdout" in seen else None
    if hold_labels is None:
        hold = settle(tail_holdout(train), "tail")
        hold_labels = hold.select("label").distinct().count()
    if seen["train"].labels < 2 or hold_labels < 2:
        split = stratified_split(df, SEED, id_columns)
        train, hold = (split.where(F.col("split") == s).drop("split") for s in ("train", "holdout"))
    return train, hold


def class_weights(df: DataFrame, out: str = "weight") -> DataFrame:
    """Balanced weight ``n / (2 * n_label)`` per row."""
    counts = settle(df.groupBy("label").agg(F.count(F.lit(1)).alias("__c")), "classes")
    total = counts.agg(F.sum("__c")).first()[0]
    joined = null_safe_join(df, counts, ["label"], "left")
    return joined.withColumn(out, F.lit(float(total or 0)) / (F.lit(2.0) * F.col("__c"))).drop("__c")


