"""All edit features in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import features as fx
from ..functions.text import null_to_empty
from ..schemas import FEATURE_COLUMNS
from .scale import attach_count

_TEXT_COLUMNS = ("title", "user", "comment", "added_text", "removed_text")


def safe_text(df: DataFrame) -> DataFrame:
    """Null text becomes empty; a missing ``user`` column is added empty."""
    if "user" not in df.columns:
        df = df.withColumn("user", F.lit(""))
    return df.withColumns({c: null_to_empty(F.col(c)) for c in _TEXT_COLUMNS if c in df.columns})


def with_text(df: DataFrame) -> DataFrame:
    return df.withColumn("text", fx.text_blob(*(F.col(c) for c in ("title", "comment", "added_text", "removed_text"))))


def with_burst(df: DataFrame, user_counts: DataFrame | None = None, given: bool = False) -> DataFrame:
    """Rows per user over the whole input, looked up in ``user_counts(user, burst_count)``, or ``given`` in the rows."""
    if given:
        return df
    if user_counts is None:
        return attach_count(df, null_to_empty(F.col("user")), "burst_count")
    joined = df.join(user_counts.select("user", "burst_count"), "user", "left")
    return joined.withColumn("burst_count", F.coalesce("burst_count", F.lit(1).cast("bigint")))


def row_features() -> dict:
    """Features that need only their own row (``text`` must exist)."""
    c = F.col
    return {
        "url_count": fx.url_count(c("text")),
        "symbol_ratio": fx.symbol_ratio(c("text")),
        "title_sensitive": fx.title_sensitive(c("title")),
        "delta_len": fx.delta_len(c("added_text"), c("removed_text")),
        "is_ip_user": fx.is_ip_user(c("user")),
        "digit_ratio": fx.digit_ratio(c("text")),
        "upper_ratio": fx.upper_ratio(c("added_text")),
        "repeat_char_flag": fx.repeat_char_flag(c("text")),
        "comment_revert_hint": fx.comment_revert_hint(c("comment")),
    }


def enrich_features(df: DataFrame, user_counts: DataFrame | None = None, given: bool = False) -> DataFrame:
    """Input columns plus ``text`` and the ten numeric features.

    The user count joins the raw rows first, so the derived text is never shuffled. ``given``: the rows carry
    ``burst_count`` already (live counts of a stream).
    """
    return with_text(with_burst(safe_text(df), user_counts, given)).withColumns(row_features())


def project_features(df: DataFrame, wanted: list[str] | None = None) -> DataFrame:
    """Feature columns, or the non-empty list the model metadata names."""
    return df.select(*(wanted or FEATURE_COLUMNS))
