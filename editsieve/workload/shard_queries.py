"""The shard builder: keys, dedup, scoring, sampling, whole chain."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import HarvestConfig
from ..functions import features as fx
from ..operators import shards as sh
from ..operators.scale import settle
from . import sqltext as s
from .fixtures import edits, over_edits
from .registry import query
from .select_queries import (
    BASE_CTE, PAYLOAD_CTE, _ADDED, _REMOVED, _STATE, payloads,
)

ID = ["revid", "source"]
_KEYED = f", k AS (SELECT *, {s.dedup_key()} AS dedup_key FROM edits)"


def _keyed(spark, sf_dir):
    return sh.with_dedup_key(edits(spark, sf_dir))


@query(over_edits(f" SELECT revid, source, {s.dedup_key(short=True)} AS dedup_key FROM edits"))
def dedup_key(spark, sf_dir):
    return sh.with_dedup_key(edits(spark, sf_dir), fx.SHORT_KEY).select(*ID, "dedup_key")


_KEPT = _KEYED + """, o AS (SELECT *, row_number() OVER (PARTITION BY lang, dedup_key ORDER BY ts DESC, revid DESC, source) AS rn FROM k)"""


@query(over_edits(_KEPT + " SELECT revid, source, title, dedup_key FROM o WHERE rn = 1"))
def dedup_within_batch(spark, sf_dir):
    return sh.dedup_newest(_keyed(spark, sf_dir), "source").select(*ID, "title", "dedup_key")


@query(over_edits(_KEYED + """ SELECT lang, CAST(count(*) - count(DISTINCT dedup_key) AS BIGINT) AS dropped FROM k GROUP BY lang"""))
def dedup_drop_count(spark, sf_dir):
    # Copies per key are combined before the second, per-language sum.
    per_key = _keyed(spark, sf_dir).groupBy("lang", "dedup_key").agg((F.count(F.lit(1)) - 1).alias("extra"))
    return per_key.groupBy("lang").agg(F.sum("extra").alias("dropped"))


_CTX_CTE = f", b AS (SELECT *, {s.BLOB} AS blob FROM edits), c AS (SELECT *, string_split(blob, '') AS ch FROM b)"


@query(over_edits(_CTX_CTE + " SELECT revid, source, " + ", ".join(
    f"{s.flag(h)} AS p{i}" for i, h in enumerate(s.context_hits("blob", "ch"), 1)) + " FROM c"))
def context_patterns(spark, sf_dir):
    df = edits(spark, sf_dir).withColumn(
        "blob", fx.raw_blob(*(F.col(c) for c in ("title", "comment", "added_text", "removed_text")))
    )
    hits = fx.context_matches(F.col("blob"))
    return df.select(*ID, *(fx.flag(h).alias(f"p{i}") for i, h in enumerate(hits, 1)))


@query(over_edits(_CTX_CTE + f" SELECT revid, source, {s.context_score('blob', 'ch')} AS context_score FROM c"))
def context_score(spark, sf_dir):
    blob = fx.raw_blob(*(F.col(c) for c in ("title", "comment", "added_text", "removed_text")))
    score = fx.context_score(blob, F.col("comment"), F.col("tags"))
    return edits(spark, sf_dir).select(*ID, score.alias("context_score"))


@query(over_edits(_KEYED + f" SELECT revid, source FROM k WHERE {s.hash_fraction('dedup_key')} < 0.2"))
def hash_sample(spark, sf_dir):
    return _keyed(spark, sf_dir).where(fx.hash_kept(F.col("dedup_key"), 0.2)).select(*ID)


_BUCKET = f"""CASE WHEN {s.IS_REVERT} THEN 'positive' WHEN context_score >= 4 THEN 'hard_negative'
 WHEN {s.hash_fraction('dedup_key')} < 0.2 THEN 'easy_negative_sampled' END"""


@query(over_edits(_CTX_CTE + f""", sc AS (SELECT *, {s.context_score('blob', 'ch')} AS context_score,
 {s.dedup_key()} AS dedup_key FROM c), bk AS (SELECT *, {_BUCKET} AS sampling_bucket FROM sc)
 SELECT revid, source, context_score, sampling_bucket FROM bk WHERE sampling_bucket IS NOT NULL"""))
def sampling_bucket(spark, sf_dir):
    scored = sh.score_rows(_keyed(spark, sf_dir), HarvestConfig())
    kept = scored.where(F.col("sampling_bucket").isNotNull())
    return kept.select(*ID, "context_score", "sampling_bucket")


# --- whole chain ---------------------------------------------------------------------------

BACKFILL = HarvestConfig(max_diffs=150)
SIMPLE = HarvestConfig(max_diffs=150, max_tags=20)


def changes(spark, sf_dir):
    """Edits as landed change events. A first delivery that has a second one lacks its tags, so the two are
    records with the same dedup key that fall into different sampling buckets."""
    df = edits(spark, sf_dir)
    twice = (F.col("event_type") == "purchase") & ~F.col("source").endswith("_dup")
    return df.select(
        "lang", F.lit("edit").alias("type"), "title", "user", "comment", "timestamp",
        F.when(twice, F.array().cast("array<string>")).otherwise(F.col("tags")).alias("tags"), "revid", "old_revid",
        "event_type",
    )


def seen_index(spark, sf_dir):
    """Keys an earlier run has stored: those of the sign-ups, with full diff text."""
    from ..operators.joins import attach_diffs

    df = changes(spark, sf_dir).where(F.col("event_type") == "signup").drop("event_type")
    ready = settle(sh.prepare_changes(df, s.RUN_TS), "seen")
    keyed = sh.with_dedup_key(attach_diffs(ready, payloads(spark, sf_dir)))
    return settle(keyed.select("lang", "dedup_key").distinct(), "index")


_TIE = s.row_hash(["title", "u", "comment", "tsx", "tag_text", "old_revid"])
_CHANGES = f""", ch0 AS (SELECT DISTINCT lang, {s.safe('title')} AS title, {s.safe('"user"')} AS u, {s.safe('comment')} AS comment,
 "timestamp" AS tsx, CASE WHEN event_type = 'purchase' AND NOT suffix(source, '_dup') THEN CAST([] AS VARCHAR[]) ELSE tags END AS tags,
 revid, old_revid, event_type FROM edits),
 ch AS (SELECT *, CAST(to_json(tags) AS VARCHAR) AS tag_text FROM ch0),
 cht AS (SELECT *, {_TIE} AS tie FROM ch)"""
_PAY = BASE_CTE + PAYLOAD_CTE + f""", pay AS (SELECT old_revid, revid, CASE WHEN event_type = 'view' THEN '' ELSE html END AS html FROM payload),
 ptext AS (SELECT *, {_ADDED} AS a, {_REMOVED} AS r FROM pay)"""


def _chain(after_cursor: str, budget: int, added: str, removed: str) -> str:
    return _CHANGES + _PAY + f""", inc AS ({after_cursor}),
 bud AS (SELECT *, CASE WHEN revid <> 0 AND old_revid <> 0 AND row_number() OVER (PARTITION BY lang,
   (revid <> 0 AND old_revid <> 0) ORDER BY tsx DESC, revid DESC, tie) <= {budget} THEN 1 ELSE 0 END AS in_budget FROM inc),
 txt AS (SELECT b.*, coalesce(CASE WHEN in_budget = 1 THEN {added} END, '') AS added_text,
   coalesce(CASE WHEN in_budget = 1 THEN {removed} END, '') AS removed_text
   FROM bud b LEFT JOIN ptext p ON p.old_revid = b.old_revid AND p.revid = b.revid)"""


_INC = """SELECT e.* FROM cht e LEFT JOIN cursor c ON c.lang = e.lang WHERE c.lang IS NULL OR e.tsx > c.last_ts
 OR (e.tsx = c.last_ts AND e.revid > c.last_revid)"""
# Start from the oldest click, so that a good part of the table is new.
_OLD_STATE = _STATE.replace("max(\"timestamp\")", "min(\"timestamp\")").replace("'error'", "'click'")


def old_state(spark, sf_dir):
    df = edits(spark, sf_dir).where(F.col("event_type") == "click")
    oldest = df.groupBy("lang").agg(F.min("timestamp").alias("last_timestamp"))
    at = df.join(oldest, (df.lang == oldest.lang) & (df.timestamp == oldest.last_timestamp)).drop(oldest.lang)
    return settle(at.groupBy("lang", "last_timestamp").agg(F.max("revid").alias("last_revid")), "state")


_INDEX = f""", idx AS (SELECT DISTINCT lang, {s.dedup_key('u', 'tsx', 'a', 'r')} AS dedup_key
 FROM (SELECT c.*, coalesce(p.a, '') AS a, coalesce(p.r, '') AS r FROM cht c LEFT JOIN ptext p USING (old_revid, revid)
 WHERE c.event_type = 'signup'))"""
_STAGED = over_edits(_OLD_STATE + _chain(_INC, 150, "p.a", "p.r") + _INDEX + f""",
 kk AS (SELECT *, {s.dedup_key('u', 'tsx')} AS dedup_key FROM txt),
 kb AS (SELECT *, {s.BLOB} AS blob FROM kk),
 uc AS (SELECT *, string_split(blob, '') AS ch FROM kb),
 sc AS (SELECT *, {s.context_score('blob', 'ch')} AS context_score FROM uc),
 bc AS (SELECT *, {_BUCKET} AS sampling_bucket FROM sc),
 rn AS (SELECT *, row_number() OVER (PARTITION BY lang, dedup_key ORDER BY tsx DESC, revid DESC, tie) AS rn,
   count(*) OVER (PARTITION BY lang, dedup_key) AS copies, sum(in_budget) OVER (PARTITION BY lang, dedup_key) AS spent FROM bc),
 kn AS (SELECT *, min(CASE WHEN sampling_bucket IS NOT NULL THEN rn END) OVER (PARTITION BY lang, dedup_key) AS claimed FROM rn),
 bk AS (SELECT *, (lang, dedup_key) IN (SELECT lang, dedup_key FROM idx) AS known,
   CASE WHEN claimed IS NULL THEN copies ELSE claimed - 1 END AS sampled_copies FROM kn WHERE rn = coalesce(claimed, 1))""")


@query(_STAGED + f""" SELECT lang, title, u AS "user", comment, added_text, removed_text, {s.flag(s.IS_REVERT)} AS label,
 concat('harvest_', lang) AS source, tsx AS "timestamp", revid, old_revid, array_to_string(tags, ',') AS tags, context_score,
 sampling_bucket, dedup_key FROM bk WHERE NOT known AND sampling_bucket IS NOT NULL""")
def build_shard(spark, sf_dir):
    return sh.build_shard(
        changes(spark, sf_dir).drop("event_type"), payloads(spark, sf_dir), seen_index(spark, sf_dir),
        old_state(spark, sf_dir), BACKFILL, s.RUN_TS,
    )


@query(_STAGED + """ SELECT lang, CAST(count(*) FILTER (WHERE NOT known AND sampling_bucket IS NOT NULL) AS BIGINT) AS rows_written,
 CAST(sum(spent) AS BIGINT) AS diffs_done,
 CAST(count(*) FILTER (WHERE NOT known AND sampling_bucket IS NOT NULL) AS BIGINT) AS changes_seen,
 CAST(sum(CASE WHEN known THEN copies ELSE copies - sampled_copies - CASE WHEN claimed IS NULL THEN 0 ELSE 1 END END) AS BIGINT) AS dedup_dropped,
 CAST(sum(CASE WHEN known THEN 0 ELSE sampled_copies END) AS BIGINT) AS sampled_dropped,
 CAST(count(*) FILTER (WHERE NOT known AND sampling_bucket IS NOT NULL)
   + (SELECT count(*) FROM idx WHERE idx.lang = bk.lang) AS BIGINT) AS dedup_index_size
 FROM bk GROUP BY lang""")
def agg_run_counters(spark, sf_dir):
    index = seen_index(spark, sf_dir)
    staged = sh.stage_shard(
        changes(spark, sf_dir).drop("event_type"), payloads(spark, sf_dir), index, old_state(spark, sf_dir),
        BACKFILL, s.RUN_TS,
    )
    out = sh.run_counters(staged, index)
    return out.select("lang", *(F.col(c).cast("bigint") for c in out.columns if c != "lang"))


@query(over_edits(_OLD_STATE + _chain(_INC, 150, "substr(p.html, 1, 4000)", "''") + f"""
 SELECT lang, title, u AS "user", comment, added_text, removed_text, {s.flag(s.IS_REVERT)} AS label,
 concat('harvest_', lang) AS source, tsx AS "timestamp", revid, old_revid, array_to_string(tags[1:20], ',') AS tags FROM txt"""))
def build_shard_simple(spark, sf_dir):
    return sh.build_shard_simple(
        changes(spark, sf_dir).drop("event_type"), payloads(spark, sf_dir), old_state(spark, sf_dir), SIMPLE, s.RUN_TS, raw_chars=4000
    )


@query(over_edits("""SELECT lang, max("timestamp") AS last_timestamp, arg_max(revid, ("timestamp", revid)) AS last_revid
FROM edits GROUP BY lang"""))
def agg_newest_cursor(spark, sf_dir):
    return sh.newest_cursor(edits(spark, sf_dir))
