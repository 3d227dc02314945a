"""Filters, caps and column choices on edits and samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..schemas import SAMPLE_COLUMNS
from .scale import checked, keep_first, mark_first, rank_cuts

_LAST = (1 << 63) - 1


def canonical(df: DataFrame) -> DataFrame:
    """The nine sample columns; missing ones are added empty, ``label`` becomes an int."""
    have = set(df.columns)
    out = []
    for c in SAMPLE_COLUMNS:
        if c == "label":
            out.append((F.col(c) if c in have else F.lit(0)).cast("int").alias(c))
        else:
            out.append((tx.null_to_empty(F.col(c)) if c in have else F.lit("")).alias(c))
    return df.select(*out)


def reverts_only(df: DataFrame) -> DataFrame:
    return df.where(tx.is_revert(F.col("comment"), F.col("tags")))


def has_revisions(revid: Column, old_revid: Column) -> Column:
    return (F.coalesce(revid, F.lit(0)) != 0) & (F.coalesce(old_revid, F.lit(0)) != 0)


def valid_revision(df: DataFrame) -> DataFrame:
    return df.where(has_revisions(F.col("revid"), F.col("old_revid")))


def within_days(df: DataFrame, days: int, run_ts: Column, ts: str = "ts") -> DataFrame:
    """Rows of the last ``days`` days up to ``run_ts``. Plain comparisons on the raw column, so
    they reach the file scan."""
    return df.where((F.col(ts) >= run_ts - F.expr(f"INTERVAL {int(days)} DAYS")) & (F.col(ts) <= run_ts))


def newest_order(ts: Column, revid: Column, tie: Column) -> list[Column]:
    """Ascending key that puts the newest row first; unknown times come last."""
    return [
        F.coalesce(-F.unix_micros(ts.cast("timestamp")), F.lit(_LAST)),
        -F.coalesce(revid, F.lit(0)),
        tie,
    ]


def newest_levels(ts: Column, revid: Column, tie: Column) -> list[Column]:
    """Hour, exact time, id range, id, prefix of the tie-break: coarse to fine along ``newest_order``."""
    t, r, tie = newest_order(ts, revid, tie)
    hour = F.floor(t / F.lit(3_600_000_000)).cast("bigint")
    return [hour, t, F.floor(r / F.lit(1 << 16)).cast("bigint"), r, F.substring(tie, 1, 4)]


def limit_newest(
    df: DataFrame, n: int | None, tie: str, group: tuple[str, ...] = ("lang",), task_rows: int | None = None
) -> DataFrame:
    """Newest ``n`` rows of each language, counted before any other filter."""
    if n is None:
        return df
    args = (F.col("ts"), F.col("revid"), F.col(tie))
    return keep_first(df, group, newest_order(*args), newest_levels(*args), F.lit(n), task_rows=task_rows)


def mark_budget(
    df: DataFrame, n: int | None, tie: str, out: str = "in_budget", group: tuple[str, ...] = ("lang",),
    task_rows: int | None = None,
) -> DataFrame:
    """Flag the newest ``n`` rows per language that have both revision ids."""
    eligible = has_revisions(F.col("revid"), F.col("old_revid"))
    if n is None:
        return df.withColumn(out, eligible)
    args = (F.col("ts"), F.col("revid"), F.col(tie))
    cuts = rank_cuts(df.where(eligible), group, newest_order(*args), newest_levels(*args), F.lit(n), task_rows=task_rows)
    return mark_first(df, cuts, group, newest_order(*args), out).withColumn(out, F.col(out) & eligible)


def spend_budget(df: DataFrame, flag: str = "in_budget") -> DataFrame:
    """Rows outside the budget stay, with empty diff text."""
    return df.withColumns(
        {c: F.when(F.col(flag), tx.null_to_empty(F.col(c))).otherwise(F.lit("")) for c in ("added_text", "removed_text")}
    )


def after_cursor(df: DataFrame, state: DataFrame | None) -> DataFrame:
    """Drop rows at or before their language's cursor ``(last_timestamp, last_revid)``.

    Rows with no readable time, and languages with no cursor, pass. ``state`` has one row
    per language and is read from storage, so its size is known to the planner.
    """
    if state is None:
        return df
    s = state.select(
        F.col("lang").alias("__lang"),
        tx.parse_ts(F.col("last_timestamp")).alias("__last_ts"),
        F.coalesce("last_revid", F.lit(0)).alias("__last_revid"),
    )
    j = df.join(s, F.col("lang").eqNullSafe(F.col("__lang")), "left")
    ts, last = F.col("ts"), F.col("__last_ts")
    newer = (ts > last) | ((ts == last) & (F.coalesce("revid", F.lit(0)) > F.col("__last_revid")))
    return j.where(ts.isNull() | last.isNull() | newer).drop("__lang", "__last_ts", "__last_revid")


def swap_texts(df: DataFrame) -> DataFrame:
    """A revert deletes the bad text: what it removed is the suspect's added text."""
    return df.withColumns({"added_text": F.col("removed_text"), "removed_text": F.col("added_text")})


def drop_null_labels(df: DataFrame) -> DataFrame:
    return df.na.drop(subset=["label"]).withColumn("label", F.col("label").cast("int"))


def guard_min_rows(df: DataFrame, floor: int) -> DataFrame:
    return checked(df, lambda n: n >= floor, lambda n: f"training table too small: {n} < {floor} rows")
