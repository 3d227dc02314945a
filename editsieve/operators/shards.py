"""Change events to labelled, deduplicated, sampled shard rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import HarvestConfig
from ..functions import features as fx
from ..functions import text as tx
from ..schemas import SHARD_COLUMNS, SIMPLE_SHARD_COLUMNS
from . import select as sel
from .joins import KEY, attach_diffs, flag_known_keys
from .scale import first_per_key, null_safe_join, settle

IDENTITY = ("lang", "revid", "old_revid", "timestamp", "title", "user", "comment", "added_text", "removed_text")


def prepare_changes(changes: DataFrame, run_ts: str) -> DataFrame:
    """Edits only, text made safe, time completed and parsed, exact second deliveries removed."""
    df = changes
    if "type" in df.columns:
        df = df.where(F.col("type") == "edit").drop("type")
    df = df.select(
        "lang", *(tx.null_to_empty(F.col(c)).alias(c) for c in ("title", "user", "comment")),
        tx.to_iso(F.col("timestamp"), run_ts).alias("timestamp"),
        F.coalesce("tags", F.array().cast("array<string>")).alias("tags"),
        F.coalesce("revid", F.lit(0)).cast("bigint").alias("revid"),
        F.coalesce("old_revid", F.lit(0)).cast("bigint").alias("old_revid"),
    ).distinct()
    # Distinct rows, hence a distinct hash: it makes every order below unique.
    tie = fx.row_hash(["title", "user", "comment", "timestamp", "tag_text", "old_revid"])
    return (
        df.withColumn("ts", tx.parse_ts(F.col("timestamp")))
        .withColumn("tag_text", F.to_json("tags")).withColumn("tie", tie).drop("tag_text")
    )


def candidates(
    changes: DataFrame,
    payloads: DataFrame,
    state: DataFrame | None,
    cfg: HarvestConfig,
    run_ts: str,
    mode: str = "collapsed",
    found: str | None = None,
) -> DataFrame:
    """Cap -> cursor -> revert switch -> diff budget -> diff text, in that order. ``found``: see ``attach_diffs``."""
    # The caps below look at the changes several times; they carry no diff text yet.
    df = settle(prepare_changes(changes, run_ts), "changes")
    df = sel.limit_newest(df, cfg.scan_cap, "tie")
    df = sel.after_cursor(df, state)
    if not cfg.include_non_reverts:
        df = sel.reverts_only(df)
    df = sel.mark_budget(df, cfg.max_diffs, "tie")
    return attach_diffs(settle(df, "batch"), payloads, mode, "left", F.col("in_budget"), found)


def with_dedup_key(df: DataFrame, lengths: tuple[int | None, int | None, int | None] = (None, None, None)) -> DataFrame:
    return df.withColumn("dedup_key", fx.dedup_key({c: F.col(c) for c in IDENTITY}, lengths))


def dedup_newest(df: DataFrame, tie: str = "tie") -> DataFrame:
    """Newest row of each key."""
    return first_per_key(df, KEY, sel.newest_order(F.col("ts"), F.col("revid"), F.col(tie)))


def bucket(is_revert: Column, score: Column, key: Column, cfg: HarvestConfig) -> Column:
    """Sampling bucket; null means the row is sampled out."""
    out = F.when(is_revert, F.lit("positive"))
    if not cfg.auto_sampling:
        return out.otherwise(F.lit("negative_full"))
    easy = score < F.lit(cfg.min_context_score)
    kept = fx.hash_kept(key, cfg.easy_negative_rate)
    return out.when(easy & kept, F.lit("easy_negative_sampled")).when(~easy, F.lit("hard_negative"))


def score_rows(df: DataFrame, cfg: HarvestConfig) -> DataFrame:
    """Add ``label``, ``context_score`` and ``sampling_bucket``."""
    blob = fx.raw_blob(*(F.col(c) for c in ("title", "comment", "added_text", "removed_text")))
    revert = tx.is_revert(F.col("comment"), F.col("tags"))
    df = df.withColumn("context_score", fx.context_score(blob, F.col("comment"), F.col("tags")))
    df = df.withColumn("label", F.when(revert, 1).otherwise(0))
    return df.withColumn("sampling_bucket", bucket(F.col("label") == 1, F.col("context_score"), F.col("dedup_key"), cfg))


def stage_shard(
    changes: DataFrame, payloads: DataFrame, index: DataFrame | Callable[[DataFrame], DataFrame] | None,
    state: DataFrame | None, cfg: HarvestConfig, run_ts: str,
    ready: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Every key with its fate, written once.

    Copies of a key are looked at from the newest on. One that is sampled out does not claim the key, so the
    newest copy that is *not* sampled out stands for it (or the newest, if all are). ``copies`` says how many
    candidates a row stands for, ``sampled_copies`` how many of them were sampled out before the key was claimed,
    ``diffs_spent`` how many used the diff budget; ``known`` keys are in the index already; a null bucket is sampled out.
    ``index`` is a table of keys, or a function that gives the index keys that matter for the staged keys (a pruned index).
    ``ready`` decides which candidates go on now: it gets them with a boolean ``has_diff`` and returns those that go on
    (as ``harvest.pending_payloads`` does for payloads that land late).
    """
    if ready is None:
        found = with_dedup_key(candidates(changes, payloads, state, cfg, run_ts))
    else:
        found = with_dedup_key(ready(candidates(changes, payloads, state, cfg, run_ts, found="has_diff")).drop("has_diff"))
    scored = score_rows(found, cfg).withColumn("source", F.concat(F.lit(cfg.source_prefix + "_"), "lang"))
    newest = sel.newest_order(F.col("ts"), F.col("revid"), F.col("tie"))
    out = F.col("sampling_bucket").isNull()
    scored = settle(scored.withColumn("tags", written_tags(cfg)), "scored")
    unique = settle(
        first_per_key(
            scored, KEY, [out.cast("int"), *newest], copies=F.count(F.lit(1)),
            diffs_spent=F.sum(F.col("in_budget").cast("bigint")), copies_out=F.count_if(out),
        ),
        "unique",
    )
    # Only keys with both kinds of copies need the order of their copies.
    place = F.struct(*(o.alias(f"o{i}") for i, o in enumerate(newest)))
    both = unique.where(~out & (F.col("copies_out") > 0)).select(*KEY, place.alias("kept_at"))
    before = null_safe_join(scored.where(out).select(*KEY, place.alias("at")), settle(both, "both"), KEY, "inner")
    counted = before.groupBy(*KEY).agg(F.count_if(F.col("at") < F.col("kept_at")).alias("newer_out"))
    staged = null_safe_join(unique, counted, KEY, "left").withColumn(
        "sampled_copies", F.when(out, F.col("copies")).otherwise(F.coalesce("newer_out", F.lit(0)))
    )
    staged = settle(staged.drop("newer_out", "copies_out"), "staged")
    if index is None:
        return staged.withColumn("known", F.lit(False))
    return flag_known_keys(staged, index(staged) if callable(index) else index)


def written_tags(cfg: HarvestConfig) -> Column:
    tags = F.col("tags") if cfg.max_tags is None else F.slice("tags", 1, cfg.max_tags)
    return F.array_join(tags, ",")


def shard_rows(staged: DataFrame) -> DataFrame:
    return staged.where(~F.col("known") & F.col("sampling_bucket").isNotNull()).select(*SHARD_COLUMNS)


def run_counters(staged: DataFrame, index: DataFrame | None = None, sizes: DataFrame | None = None) -> DataFrame:
    """Per-language counters of one run. The index size comes from ``sizes`` (lang, size) if given, else from counting ``index``."""
    written = ~F.col("known") & F.col("sampling_bucket").isNotNull()
    n = F.sum(F.when(written, 1).otherwise(0))
    out = staged.groupBy("lang").agg(
        n.alias("rows_written"),
        F.sum("diffs_spent").alias("diffs_done"),
        n.alias("changes_seen"),
        F.sum(
            F.when(F.col("known"), F.col("copies")).otherwise(F.col("copies") - F.col("sampled_copies") - written.cast("int"))
        ).alias("dedup_dropped"),
        F.sum(F.when(~F.col("known"), F.col("sampled_copies")).otherwise(0)).alias("sampled_dropped"),
    )
    if index is None and sizes is None:
        return out.withColumn("dedup_index_size", F.col("rows_written"))
    if sizes is not None:
        size = sizes.select("lang", F.col("size").alias("__size"))
    else:
        size = index.groupBy("lang").agg(F.count(F.lit(1)).alias("__size"))
    joined = null_safe_join(out, size, ["lang"], "left")
    return joined.withColumn("dedup_index_size", F.coalesce("__size", F.lit(0)) + F.col("rows_written")).drop("__size")


def newest_cursor(rows: DataFrame) -> DataFrame:
    """Largest ``(timestamp string, revid)`` per language."""
    best = F.max(F.struct("timestamp", "revid")).alias("m")
    return rows.groupBy("lang").agg(best).select(
        "lang", F.col("m.timestamp").alias("last_timestamp"), F.col("m.revid").alias("last_revid")
    )


def build_shard(
    changes: DataFrame, payloads: DataFrame, index: DataFrame | None = None, state: DataFrame | None = None,
    cfg: HarvestConfig = HarvestConfig(), run_ts: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    return shard_rows(stage_shard(changes, payloads, index, state, cfg, run_ts))


def build_shard_simple(
    changes: DataFrame, payloads: DataFrame, state: DataFrame | None = None,
    cfg: HarvestConfig = HarvestConfig(), run_ts: str = "1970-01-01T00:00:00Z", raw_chars: int | None = None,
) -> DataFrame:
    """Variant without dedup, score or sampling; the diff text is the raw HTML, or its first ``raw_chars`` characters."""
    df = candidates(changes, payloads, state, cfg, run_ts, mode="raw" if raw_chars is None else f"raw:{raw_chars}")
    return df.withColumns(
        {
            "label": F.when(tx.is_revert(F.col("comment"), F.col("tags")), 1).otherwise(0),
            "source": F.concat(F.lit(cfg.source_prefix + "_"), "lang"),
            "tags": written_tags(cfg),
        }
    ).select(*SIMPLE_SHARD_COLUMNS)
