"""``edits``: the driver tables in the shape of wiki edits, in Spark and in DuckDB.

Each document becomes one edit: its first 40 characters are the title, the next 60 the
comment, four fifths of the rest the added text and all that remains the removed text.
The event with the same id supplies user, time and tags. Purchases are delivered twice,
which plants exact duplicates that differ only in ``source``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_BASE = """
  SELECT CAST(d.doc_id + 1 AS BIGINT) AS revid,
         CAST(d.doc_id AS BIGINT) AS old_revid,
         d.lang AS lang,
         CASE WHEN d.doc_id % 17 = 0 THEN 'Donald Trump' ELSE substr(d.text, 1, 40) END AS title,
         CASE WHEN e.event_type = 'error' THEN concat('10.0.0.', CAST(e.user_id % 256 AS VARCHAR(20)))
              ELSE concat('u', CAST(e.user_id AS VARCHAR(20))) END AS user_name,
         CASE WHEN d.doc_id % 13 = 0 THEN NULL
              WHEN d.doc_id % 7 = 0 THEN 'Rv vandalisme'
              WHEN d.doc_id % 11 = 0 THEN 'Annulation des modifications'
              ELSE substr(d.text, 41, 60) END AS comment,
         concat(CASE WHEN d.doc_id % 19 = 0 THEN 'HAAAAAAAAA lol http://x.example/ ' ELSE '' END,
                substr(d.text, 101, CAST(floor(length(d.text) * 0.8) AS INTEGER))) AS added_text,
         substr(d.text, 101 + CAST(floor(length(d.text) * 0.8) AS INTEGER)) AS removed_text,
         CAST(CASE WHEN l.doc_id IS NULL THEN NULL WHEN l.quality = 0 OR l.toxic = 1 THEN 1 ELSE 0 END AS INTEGER) AS label,
         d.source AS source,
         e.event_type AS event_type,
         e.ts AS ts,
         CASE e.event_type WHEN 'signup' THEN 'mw-rollback' WHEN 'purchase' THEN 'mobile edit,MW-Undo' ELSE '' END AS tag_list
  FROM documents d
  JOIN events e ON e.event_id = d.doc_id
  LEFT JOIN labels l ON l.doc_id = d.doc_id
"""

_TWICE = """
  SELECT revid, old_revid, lang, title, user_name, comment, added_text, removed_text, label, source, event_type, ts, tag_list
  FROM base
  UNION ALL
  SELECT revid, old_revid, lang, title, user_name, comment, added_text, removed_text, label,
         concat(source, '_dup') AS source, event_type, ts, tag_list
  FROM base WHERE event_type = 'purchase'
"""

# The same view for DuckDB; ``user`` and ``timestamp`` are quoted there.
EDITS_CTE = f"""
WITH base AS ({_BASE}),
twice AS ({_TWICE}),
edits AS (
  SELECT revid, old_revid, lang, title, user_name AS "user", comment, added_text, removed_text, label, source,
         event_type, ts, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS "timestamp",
         CASE WHEN tag_list = '' THEN CAST([] AS VARCHAR[]) ELSE string_split(tag_list, ',') END AS tags
  FROM twice)
"""


def over_edits(body: str) -> str:
    """Check SQL on the ``edits`` view; ``body`` may go on with ``, cte AS (...) SELECT``."""
    return EDITS_CTE + body


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table. A table in fewer files than cores is spread by its first column;
    a table in many files is left as it lies."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    if name in ("documents", "pages") and len(df.inputFiles()) < cores:
        df = df.repartition(cores, df.columns[0])
    return df


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``_BASE`` with the pieces of the text cut before the joins, so that a query carries only those it reads through them."""
    docs, events, labels = (table(spark, sf_dir, n) for n in ("documents", "events", "labels"))
    every = lambda n: F.col("doc_id") % n == 0
    share = F.floor(F.length("text") * 0.8).cast("int")
    cut = docs.select(
        "doc_id", (F.col("doc_id") + 1).cast("bigint").alias("revid"), F.col("doc_id").cast("bigint").alias("old_revid"), "lang",
        F.when(every(17), F.lit("Donald Trump")).otherwise(F.substring("text", 1, 40)).alias("title"),
        F.when(every(13), F.lit(None).cast("string")).when(every(7), F.lit("Rv vandalisme"))
        .when(every(11), F.lit("Annulation des modifications")).otherwise(F.substring("text", 41, 60)).alias("comment"),
        F.concat(F.when(every(19), F.lit("HAAAAAAAAA lol http://x.example/ ")).otherwise(F.lit("")), F.substring("text", F.lit(101), share)).alias("added_text"),
        F.expr("substr(text, 101 + CAST(floor(length(text) * 0.8) AS INTEGER))").alias("removed_text"), "source",
    )
    user = F.col("user_id")
    seen = events.select(
        F.col("event_id").alias("doc_id"),
        F.when(F.col("event_type") == "error", F.concat(F.lit("10.0.0."), (user % 256).cast("string")))
        .otherwise(F.concat(F.lit("u"), user.cast("string"))).alias("user_name"),
        "event_type", "ts",
        F.when(F.col("event_type") == "signup", F.lit("mw-rollback")).when(F.col("event_type") == "purchase", F.lit("mobile edit,MW-Undo"))
        .otherwise(F.lit("")).alias("tag_list"),
    )
    bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0).cast("int")
    return cut.join(seen, "doc_id").join(labels.select("doc_id", bad.alias("label")), "doc_id", "left").drop("doc_id")


def _finish(df: DataFrame) -> DataFrame:
    return df.select(
        "revid", "old_revid", "lang", "title", F.col("user_name").alias("user"), "comment", "added_text",
        "removed_text", "label", "source", "event_type", "ts",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"),
        F.when(F.col("tag_list") == "", F.array().cast("array<string>"))
        .otherwise(F.split("tag_list", ",")).alias("tags"),
    )


def base_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edits without the second deliveries."""
    return _finish(_base(spark, sf_dir))


def edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second deliveries are made in their row (``_TWICE`` in the check SQL), so the tables are read and joined once."""
    twice = F.when(F.col("event_type") == "purchase", F.array(F.lit(""), F.lit("_dup"))).otherwise(F.array(F.lit("")))
    base = _base(spark, sf_dir)
    copies = base.withColumn("__end", F.explode(twice))
    return _finish(copies.withColumn("source", F.concat("source", "__end")).drop("__end"))
