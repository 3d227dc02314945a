"""Sources (parsers over strings and tables made from the driver tables), sinks as round trips."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import shards as sh
from ..operators.scale import scratch_path, settle
from ..sources import readers as rd
from ..sources import sinks
from . import sqltext as s
from .fixtures import base_edits, edits, over_edits, table
from .registry import query
from .select_queries import BASE_CTE, _HTML, html_column
from .shard_queries import _keyed

ID = ["revid", "source"]


# --- JSON ------------------------------------------------------------------------------------------
# Each edit becomes a JSON line; its event type decides what is wrong with it.

def corpus_lines(spark, sf_dir):
    obj = F.to_json(F.struct("title", F.col("user").alias("reverter"), F.col("comment"), "added_text", "removed_text",
                             "timestamp"), {"ignoreNullFields": "false"})
    kind = F.col("event_type")
    body = F.substring(obj, 2, 1 << 30)
    line = (
        F.when(kind == "view", F.concat(F.lit('{"lang":null,'), body))
        .when(kind == "click", obj)
        .when(kind == "signup", F.concat(F.lit("["), obj, F.lit("]")))
        .when(kind == "purchase", F.concat(F.lit('{"lang":"'), "lang", F.lit('",'), body))
        .otherwise(F.concat(F.lit("not json "), obj))
    )
    df = base_edits(spark, sf_dir)
    lines = df.select(line.alias("value"))
    return lines.unionByName(df.select(F.when(kind == "click", F.lit("  ")).otherwise(F.lit("5")).alias("value")))


_SRC = f"""{s.safe('title')} AS title, {s.safe('"user"')} AS "user", {s.safe('comment')} AS comment, {s.safe('added_text')} AS added_text,
 {s.safe('removed_text')} AS removed_text"""


@query(over_edits(BASE_CTE + f""" SELECT CASE event_type WHEN 'view' THEN '' WHEN 'click' THEN 'fr' ELSE lang END AS lang, {_SRC},
 1 AS label, 'human_revert' AS source, "timestamp" FROM base_edits WHERE event_type IN ('view', 'click', 'purchase')"""))
def src_jsonl_corpus(spark, sf_dir):
    return rd.parse_corpus(corpus_lines(spark, sf_dir), s.RUN_TS)


def bot_documents(spark, sf_dir):
    """One JSON object per edit: an entry, a number and a text that only looks like an object."""
    entry = F.to_json(F.struct("title", F.col("user").alias("creator"), "comment", "added_text", "removed_text", "timestamp"))
    key = F.col("revid").cast("string")
    root = F.concat(F.lit('{"'), key, F.lit('":'), entry, F.lit(',"n'), key, F.lit('":5,"s'), key, F.lit('":"{}","e'), key,
                    F.lit('":{}}'))
    broken = F.concat(F.lit("["), root, F.lit("]"))
    return base_edits(spark, sf_dir).select(F.when(F.col("event_type") == "error", broken).otherwise(root).alias("value"))


@query(over_edits(BASE_CTE + f""" SELECT 'fr' AS lang, {_SRC}, 1 AS label, 'bot_revert' AS source, "timestamp"
 FROM base_edits WHERE event_type <> 'error' UNION ALL
 SELECT 'fr', '', '', '', '', '', 1, 'bot_revert', '{s.RUN_TS}' FROM base_edits WHERE event_type <> 'error'"""))
def src_json_map(spark, sf_dir):
    return rd.parse_bot_db(bot_documents(spark, sf_dir), "fr", s.RUN_TS)


@query(over_edits(BASE_CTE + """ SELECT revid, 'v' || revid AS model_version,
 CASE WHEN event_type = 'purchase' THEN NULL ELSE 0.5::DOUBLE END AS threshold, 'title,text' AS features
 FROM base_edits WHERE event_type NOT IN ('error', 'signup') UNION ALL
 SELECT revid, NULL, NULL, '' FROM base_edits WHERE event_type IN ('error', 'signup')"""))
def src_metadata_json(spark, sf_dir):
    kind, key = F.col("event_type"), F.col("revid").cast("string")
    doc = (
        F.when(kind == "error", F.lit("{broken"))
        .when(kind == "signup", F.lit("[1]"))
        .when(kind == "purchase", F.concat(F.lit('{"model_version":"v'), key, F.lit('","threshold":"high","features":["title","text"]}')))
        .otherwise(F.concat(F.lit('{"model_version":"v'), key, F.lit('","threshold":0.5,"features":["title","text"]}')))
    )
    docs = base_edits(spark, sf_dir).select("revid", doc.alias("value"))
    v = F.try_parse_json("value")
    meta = rd.metadata_fields(docs.select("revid", v.alias("v")), keep=("revid",))
    return meta.select("revid", "model_version", "threshold", F.coalesce(F.array_join("features", ","), F.lit("")).alias("features"))


# --- change events -------------------------------------------------------------------------------------

def change_events(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    kind = F.col("event_type")
    return e.select(
        F.col("event_id").alias("id"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("ts_utc"),
        F.when(kind == "view", F.lit(None)).otherwise(F.lit("en")).alias("lang"), F.col("props").alias("title"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("creator"),
        F.when(kind == "error", F.lit("Reverted")).otherwise(kind).alias("action"), F.col("value").alias("score"),
        F.lit(None).cast("string").alias("reason"), kind.alias("matched_patterns"),
        (F.col("event_id") % 97).cast("int").alias("added_len"), F.lit(None).cast("int").alias("removed_len"),
    )


_EVENTS = """SELECT CASE WHEN event_type = 'view' THEN 'fr' ELSE 'en' END AS lang, props AS title,
 concat('u', user_id) AS "user", '' AS comment,
 concat('len_added=', event_id % 97, ' score=', format('{:.3f}', value), ' patterns=', event_type) AS added_text,
 'len_removed=0' AS removed_text, CAST(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS INTEGER) AS label,
 'intel_change_events' AS source, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS "timestamp"
 FROM events ORDER BY event_id DESC LIMIT """


@query(_EVENTS + "3000")
def src_change_events(spark, sf_dir):
    return rd.parse_change_events(change_events(spark, sf_dir), s.RUN_TS, 3000)


@query("SELECT event_id, event_type, value FROM events ORDER BY event_id DESC LIMIT 3000")
def sort_desc_limit(spark, sf_dir):
    from ..operators.scale import newest_global

    return newest_global(table(spark, sf_dir, "events"), "event_id", 3000).select("event_id", "event_type", "value")


# --- landed changes --------------------------------------------------------------------------------------

def landed(spark, sf_dir):
    """Edits as landed change events (second deliveries are the same record)."""
    return edits(spark, sf_dir).select(
        "lang", F.lit("edit").alias("type"), "title", "user", "comment", "timestamp", "tags", "revid", "old_revid"
    )


def landed_payloads(spark, sf_dir):
    """Payloads of all edits but the views, whose diff failed."""
    df = base_edits(spark, sf_dir).where(F.col("event_type") != "view")
    return df.select("old_revid", "revid", html_column().alias("compare_html"))


_TIE2 = s.row_hash(["title", "u", "comment", "tsx", "tag_text", "old_revid"])
_LANDED = BASE_CTE + f""", ld AS (SELECT lang, {s.safe('title')} AS title, {s.safe('"user"')} AS u, {s.safe('comment')} AS comment,
 "timestamp" AS tsx, tags, CAST(to_json(tags) AS VARCHAR) AS tag_text, revid, old_revid, ts,
 CASE WHEN event_type <> 'view' THEN {_HTML} END AS html FROM base_edits),
 nw AS (SELECT *, {_TIE2} AS tie FROM ld)"""
_ORDER = "PARTITION BY lang ORDER BY tsx DESC, revid DESC, tie"


@query(over_edits(_LANDED + f""" SELECT lang, title, u AS "user", comment, coalesce(CASE WHEN revid <> 0 AND old_revid <> 0 THEN
 {s.strip_html('html')} END, '') AS added_text, '' AS removed_text, {s.flag(s.IS_REVERT)} AS label, 'recentchanges' AS source,
 tsx AS "timestamp" FROM nw QUALIFY row_number() OVER ({_ORDER}) <= 300"""))
def src_recentchanges(spark, sf_dir):
    return rd.recent_changes(landed(spark, sf_dir), landed_payloads(spark, sf_dir), 300, s.RUN_TS)


_HUMAN = _LANDED + f""", win AS (SELECT * FROM nw WHERE strptime(tsx, '%Y-%m-%dT%H:%M:%SZ') BETWEEN
 TIMESTAMP '2024-01-31' - INTERVAL 30 DAY AND TIMESTAMP '2024-01-31'),
 scan AS (SELECT * FROM win QUALIFY row_number() OVER ({_ORDER}) <= 4000),
 rev AS (SELECT * FROM scan WHERE {s.IS_REVERT} AND revid <> 0 AND old_revid <> 0 AND html IS NOT NULL),
 kept AS (SELECT * FROM rev QUALIFY row_number() OVER ({_ORDER}) <= 100)"""


@query(over_edits(_HUMAN + f""" SELECT lang, title, u AS "user", comment,
 {s.strip_html(s.unescape(s.cells('html', 'diff-deletedline')))} AS added_text,
 {s.strip_html(s.unescape(s.cells('html', 'diff-addedline')))} AS removed_text, 1 AS label, 'human_revert_api' AS source,
 tsx AS "timestamp" FROM kept"""))
def src_human_reverts(spark, sf_dir):
    return rd.human_reverts(landed(spark, sf_dir), landed_payloads(spark, sf_dir), 30, 4000, 100, s.RUN_TS)


# --- union ---------------------------------------------------------------------------------------------------

_SAMPLE = 'lang, title, "user", comment, added_text, removed_text, label, source, "timestamp"'


@query(over_edits(BASE_CTE + f""", a AS (SELECT CASE event_type WHEN 'view' THEN '' WHEN 'click' THEN 'fr' ELSE lang END AS lang, {_SRC},
 1 AS label, 'human_revert' AS source, "timestamp" FROM base_edits WHERE event_type IN ('view', 'click', 'purchase')),
 b AS (SELECT 'fr' AS lang, {_SRC}, 1 AS label, 'bot_revert' AS source, "timestamp" FROM base_edits WHERE event_type <> 'error'
   UNION ALL SELECT 'fr', '', '', '', '', '', 1, 'bot_revert', '{s.RUN_TS}' FROM base_edits WHERE event_type <> 'error'),
 c AS ({_EVENTS}30000), d AS (SELECT lang, {_SRC}, coalesce(label, 0) AS label, source, "timestamp" FROM edits)
 SELECT {_SAMPLE}, 0 AS source_rank FROM a UNION ALL SELECT {_SAMPLE}, 1 FROM b UNION ALL SELECT {_SAMPLE}, 2 FROM c
 UNION ALL SELECT {_SAMPLE}, 3 FROM d"""))
def union_sources(spark, sf_dir):
    shards = edits(spark, sf_dir).withColumn("file_name", F.lit("none"))
    return rd.union_ranked([
        rd.parse_corpus(corpus_lines(spark, sf_dir), s.RUN_TS),
        rd.parse_bot_db(bot_documents(spark, sf_dir), "fr", s.RUN_TS),
        rd.parse_change_events(change_events(spark, sf_dir), s.RUN_TS),
        rd.parse_shards(shards, s.RUN_TS),
    ])


# --- files: write, then read back ----------------------------------------------------------------------------------

@query(over_edits(f"""SELECT lang, {_SRC}, coalesce(label, 0) AS label, CASE WHEN event_type = 'view' THEN 'unnamed' ELSE source END AS source,
 "timestamp" FROM edits"""))
def src_shards(spark, sf_dir):
    path = scratch_path(spark, "shards")
    df = edits(spark, sf_dir).withColumn("source", F.when(F.col("event_type") != "view", F.col("source")))
    df.select("lang", "title", "user", "comment", "added_text", "removed_text", F.col("label").cast("bigint").alias("label"),
              "source", "timestamp", "revid").write.parquet(path)
    out = rd.parse_shards(rd.read_shards(spark, path), s.RUN_TS)
    # The fallback name is that of the file, which differs from run to run.
    return out.withColumn("source", F.when(F.col("source").rlike(r"^shard:.*\.parquet$"), "unnamed").otherwise(F.col("source")))


def _shard_rows(spark, sf_dir):
    from ..config import HarvestConfig

    scored = sh.score_rows(_keyed(spark, sf_dir), HarvestConfig(auto_sampling=False))
    return scored.withColumn("tags", F.array_join("tags", ",")).select(*_SHARD_COLS)


_SHARD_COLS = ["lang", "title", "user", "comment", "added_text", "removed_text", "label", "source", "timestamp", "revid",
               "old_revid", "tags", "context_score", "sampling_bucket", "dedup_key"]


@query(over_edits(f""", b AS (SELECT *, {s.BLOB} AS blob FROM edits), c AS (SELECT *, string_split(blob, '') AS ch FROM b)
 SELECT lang, title, "user", comment, added_text, removed_text, {s.flag(s.IS_REVERT)} AS label, source, "timestamp", revid, old_revid,
 array_to_string(tags, ',') AS tags, {s.context_score('blob', 'ch')} AS context_score,
 CASE WHEN {s.IS_REVERT} THEN 'positive' ELSE 'negative_full' END AS sampling_bucket, {s.dedup_key()} AS dedup_key FROM c"""))
def sink_shards(spark, sf_dir):
    path = scratch_path(spark, "shards")
    sinks.write_shards(_shard_rows(spark, sf_dir), path, "0001")
    return sinks.read_shard_table(spark, path).select(*_SHARD_COLS)


@query(over_edits(f", k AS (SELECT lang, {s.dedup_key()} AS dedup_key FROM edits) SELECT DISTINCT lang, dedup_key FROM k"))
def sink_dedup_keys(spark, sf_dir):
    path = scratch_path(spark, "keys")
    sinks.append_dedup_keys(_keyed(spark, sf_dir), path, "0001")
    return sinks.read_dedup_keys(spark, path)


@query(over_edits("""SELECT lang, max("timestamp") AS last_timestamp, arg_max(revid, ("timestamp", revid)) AS last_revid,
 CAST(count(*) AS BIGINT) AS rows_written FROM edits GROUP BY lang"""))
def sink_cursor_state(spark, sf_dir):
    path = scratch_path(spark, "state")
    df = settle(edits(spark, sf_dir).select("lang", "timestamp", "revid", "event_type"), "edits")
    sizes = df.groupBy("lang").agg(F.count(F.lit(1)).alias("rows_written"))
    older = sh.newest_cursor(df.where(F.col("event_type") == "click"))
    sinks.append_cursor_state(older, path, "0001")
    sinks.append_cursor_state(sh.newest_cursor(df).join(sizes, "lang"), path, "0002")
    return sinks.read_cursor_state(spark, path).select("lang", "last_timestamp", "last_revid", "rows_written")


_TSPLIT = f""", lab AS (SELECT *, {s.row_hash(ID)} AS h FROM edits WHERE label IS NOT NULL),
 sp AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY lang ORDER BY date_trunc('second', ts) NULLS LAST, h)
   <= greatest(count(*) OVER (PARTITION BY lang) * 4 // 5, 1) THEN 'train' ELSE 'holdout' END AS split FROM lab)"""


def _write_split(spark, sf_dir):
    from ..operators.balance import temporal_split
    from ..operators.select import drop_null_labels

    df = temporal_split(drop_null_labels(edits(spark, sf_dir)), id_columns=ID)
    split = settle(df.select(*ID, "lang", "title", "user", "comment", "added_text", "removed_text", "label", "timestamp", "split"))
    parts = [split.where(F.col("split") == p).drop("split") for p in ("train", "holdout")]
    return sinks.write_train_eval(*parts, scratch_path(spark, "data"))


@query(over_edits(_TSPLIT + " SELECT revid, source, label, split FROM sp"))
def sink_train_eval(spark, sf_dir):
    paths = _write_split(spark, sf_dir)
    train, hold = (spark.read.parquet(paths[p]).select(*ID, "label") for p in ("train_dataset", "eval_dataset"))
    return train.withColumn("split", F.lit("train")).unionByName(hold.withColumn("split", F.lit("holdout")))


@query(over_edits(_TSPLIT + f""", hold AS (SELECT *, {s.TEXT} AS text FROM sp WHERE split = 'holdout')
 SELECT revid, source, label, text, {s.FEATURE_SQL['symbol_ratio']} AS symbol_ratio,
 CAST(count(*) OVER (PARTITION BY "user") AS BIGINT) AS burst_count FROM hold"""))
def src_eval_dataset(spark, sf_dir):
    from ..operators.enrich import enrich_features

    enriched = enrich_features(spark.read.parquet(_write_split(spark, sf_dir)["eval_dataset"]))
    return enriched.select(*ID, "label", "text", F.round("symbol_ratio", 9).alias("symbol_ratio"), "burst_count")


@query(over_edits(_TSPLIT + """ SELECT CAST(count(*) AS BIGINT) AS rows_total, CAST(sum(label) AS BIGINT) AS labels_positive,
 CAST(sum(1 - label) AS BIGINT) AS labels_negative, CAST(count(*) FILTER (WHERE split = 'train') AS BIGINT) AS train_rows,
 CAST(count(*) FILTER (WHERE split = 'holdout') AS BIGINT) AS holdout_rows FROM sp"""))
def sink_reports(spark, sf_dir):
    from .training_queries import agg_label_counts

    report = agg_label_counts(spark, sf_dir)
    path = sinks.write_report(report, scratch_path(spark, "report"))
    return spark.read.schema(report.schema).json(path)
