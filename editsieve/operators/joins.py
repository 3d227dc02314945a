"""Changes with their diffs, rows against the key index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from .scale import null_safe_join, settle

KEY = ["lang", "dedup_key"]
# Id pairs up to which the payloads are narrowed to them before their text is extracted.
FEW_IDS = 200_000


def attach_diffs(
    changes: DataFrame, payloads: DataFrame, mode: str = "collapsed", how: str = "left", wanted: Column | None = None,
    found: str | None = None,
) -> DataFrame:
    """Join each change with its compare payload and extract (added, removed) text.

    ``how='inner'`` drops changes without a payload, ``'left'`` keeps them with empty text.
    Rows that want no diff get a negative join id made from their own columns, so they match
    nothing and still spread evenly (ids are positive). Text is extracted in the scan of the payloads,
    so raw HTML is never shuffled; then only the payloads that ``changes`` asks for go on (an inner join
    with their distinct ids: a semi join would be pushed below the extraction). Where few ids are asked for, as under a
    cap, they are broadcast, and only their payloads are extracted at all. Of several payloads
    with the same ids the smallest pair of texts counts. Pass a settled table of changes, it is read twice.
    ``found`` names a boolean column that tells whether a payload was there.
    """
    keys = ["old_revid", "revid"]
    wanted = F.lit(True) if wanted is None else wanted
    asked = settle(changes.where(wanted).select(*keys).distinct(), "asked-ids")
    if asked.count() <= FEW_IDS:
        payloads = payloads.join(F.broadcast(asked), keys, "left_semi")
    added, removed = tx.diff_texts(F.col("compare_html"), mode)
    texts = payloads.select(*keys, added.alias("added_text"), removed.alias("removed_text")).join(asked, keys)
    least = F.min(F.struct("added_text", "removed_text")).alias("d")
    diffs = texts.groupBy(*keys).agg(least).select(
        F.col("old_revid").alias("__old"), F.col("revid").alias("__new"), "d.added_text", "d.removed_text"
    )
    spread = -F.abs(F.shiftright(F.xxhash64("title", "user", "timestamp", "revid"), 1)) - 1
    left = changes.drop("added_text", "removed_text").withColumn("__id", F.when(wanted, F.col("revid")).otherwise(spread))
    joined = left.join(diffs, (F.col("old_revid") == F.col("__old")) & (F.col("__id") == F.col("__new")), how)
    if found:
        joined = joined.withColumn(found, F.col("__new").isNotNull())
    return joined.withColumns(
        {c: tx.null_to_empty(F.col(c)) for c in ("added_text", "removed_text")}
    ).drop("__id", "__old", "__new")


def payload_table(raw: DataFrame) -> DataFrame:
    """(old_revid, revid, compare_html) from landed compare payloads."""
    return raw.select("old_revid", "revid", tx.payload_html(F.col("compare")).alias("compare_html"))


def drop_known_keys(rows: DataFrame, index: DataFrame) -> DataFrame:
    """Rows whose key is not in the index. A null language is a language like any other."""
    return flag_known_keys(settle(rows, "rows"), index).where(~F.col("known")).drop("known")


def flag_known_keys(rows: DataFrame, index: DataFrame) -> DataFrame:
    """Add boolean ``known``.

    The index outgrows every batch. It is first reduced to the keys this batch asks for: when
    the batch is small on disk the planner broadcasts the batch's keys and the index is only
    scanned; when both are large, both shuffle by the (uniform) hash key.
    """
    asked = settle(rows.select(*KEY).distinct(), "asked")
    hits = settle(null_safe_join(index.select(*KEY), asked, KEY, "left_semi").distinct(), "known")
    joined = null_safe_join(rows, hits.withColumn("known", F.lit(True)), KEY, "left")
    return joined.withColumn("known", F.coalesce("known", F.lit(False)))
