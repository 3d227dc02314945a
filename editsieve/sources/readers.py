"""Input tables. Each source is split into reading (files -> raw columns) and parsing
(DataFrame -> sample rows), so parsing also runs on any other table."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import CollectConfig
from ..functions import text as tx
from ..operators import select as sel
from ..operators.joins import attach_diffs, payload_table
from ..operators.scale import newest_global, settle
from ..operators.shards import prepare_changes
from ..schemas import CHANGE, CHANGE_EVENT, DIFF_PAYLOAD, METADATA, SAMPLE, SAMPLE_COLUMNS

_LINES = T.StructType([T.StructField("value", T.StringType())])
# Shard files of any age: a column a file lacks reads as null, so no schema pass over all footers.
_SHARD_READ = T.StructType(
    [T.StructField(f.name, T.LongType() if f.name == "label" else f.dataType) for f in SAMPLE.fields]
)


def or_empty(spark: SparkSession, read, schema: T.StructType) -> DataFrame:
    """The table, or an empty one when its path does not exist."""
    try:
        return read()
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return or_empty(spark, lambda: spark.read.text(path), _LINES)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per file with its whole text. Many files spread over the cluster; a file is one task."""
    return or_empty(spark, lambda: spark.read.text(path, wholetext=True), _LINES)


# A JSON document of more bytes may not fit in one variant value.
VARIANT_BYTES = 100_000_000
TOO_LARGE = "a JSON map of more than 100 MB cannot be parsed as one document: land it as one entry per line"

# --- tolerant JSON -----------------------------------------------------------------------------

def is_object(v: Column) -> Column:
    return F.schema_of_variant(v).startswith("OBJECT")


def _present(v: Column, name: str) -> Column:
    return F.try_variant_get(v, f"$.{name}", "variant").isNotNull()


def field_text(v: Column, name: str) -> Column:
    """Field as text; missing, null, zero, false and empty containers are the empty string."""
    kind = F.coalesce(F.schema_of_variant(F.try_variant_get(v, f"$.{name}", "variant")), F.lit("VOID"))
    text = F.try_variant_get(v, f"$.{name}", "string")
    out = (
        F.when(kind == "STRING", text)
        .when(kind == "VOID", F.lit(""))
        .when(kind == "BOOLEAN", F.when(text == "true", F.lit("True")).otherwise(F.lit("")))
        .when(kind.startswith("ARRAY") | kind.startswith("OBJECT"),
              F.when(text.isin("[]", "{}"), F.lit("")).otherwise(text))
        .otherwise(F.when(text.try_cast("double") == 0, F.lit("")).otherwise(text))
    )
    return F.coalesce(out, F.lit(""))


def _sample(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    return df.select(*(columns[c].alias(c) for c in SAMPLE_COLUMNS))


def parse_corpus(lines: DataFrame, run_ts: str, default_lang: str = "fr") -> DataFrame:
    """JSON lines of human reverts; blank, malformed and non-object lines are skipped."""
    v = F.col("v")
    objects = lines.select(F.try_parse_json(F.col("value")).alias("v")).where(is_object(v))
    text = {c: field_text(v, c) for c in ("title", "comment", "added_text", "removed_text")}
    lang = F.when(_present(v, "lang"), field_text(v, "lang")).otherwise(F.lit(default_lang))
    return _sample(
        objects,
        text | {
            "lang": lang, "user": field_text(v, "reverter"), "label": F.lit(1), "source": F.lit("human_revert"),
            "timestamp": tx.to_iso(field_text(v, "timestamp"), run_ts),
        },
    )


def parse_bot_db(documents: DataFrame, lang: str, run_ts: str) -> DataFrame:
    """JSON objects keyed by change id; entries that are not objects are skipped."""
    # A document beyond what one variant holds would look like a malformed one: say so instead of skipping it.
    parsed = F.try_parse_json(F.col("value"))
    too_large = parsed.isNull() & (F.octet_length("value") > F.lit(VARIANT_BYTES))
    root = F.when(too_large, F.raise_error(F.lit(TOO_LARGE)).cast("variant")).otherwise(parsed)
    roots = documents.select(root.alias("root")).where(is_object(F.col("root")))
    entries = documents.sparkSession.sql(
        "SELECT e.value AS v FROM {roots}, LATERAL variant_explode(root) AS e(pos, key, value)", roots=roots
    ).where(is_object(F.col("v")))
    v = F.col("v")
    text = {c: field_text(v, c) for c in ("title", "comment", "added_text", "removed_text")}
    return _sample(
        entries,
        text | {
            "lang": F.lit(lang), "user": field_text(v, "creator"), "label": F.lit(1), "source": F.lit("bot_revert"),
            "timestamp": tx.to_iso(field_text(v, "timestamp"), run_ts),
        },
    )


# --- tables -----------------------------------------------------------------------------------------

def read_change_events(spark: SparkSession, path: str) -> DataFrame:
    return or_empty(spark, lambda: spark.read.schema(CHANGE_EVENT).parquet(path), CHANGE_EVENT)


def read_change_events_jdbc(spark: SparkSession, url: str, table: str = "change_events", **options: str) -> DataFrame:
    """The same table over JDBC; pass ``partitionColumn``/``lowerBound``/``upperBound``/``numPartitions``
    to read it in parallel."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def newest_change_events(events: DataFrame, limit: int | None) -> DataFrame:
    return events if limit is None else newest_global(events, "id", limit)


def parse_change_events(events: DataFrame, run_ts: str, limit: int | None = None, default_lang: str = "fr") -> DataFrame:
    """Newest events as samples; lengths, score and patterns are written out as text."""
    score = F.format_string("%.3f", F.coalesce("score", F.lit(0.0)))
    length = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("string")
    lang = F.coalesce(F.nullif("lang", F.lit("")), F.lit(default_lang))
    return _sample(
        newest_change_events(events, limit),
        {
            "lang": lang,
            "title": tx.null_to_empty(F.col("title")),
            "user": tx.null_to_empty(F.col("creator")),
            "comment": tx.null_to_empty(F.col("reason")),
            "added_text": F.concat(
                F.lit("len_added="), length("added_len"), F.lit(" score="), score, F.lit(" patterns="),
                tx.null_to_empty(F.col("matched_patterns")),
            ),
            "removed_text": F.concat(F.lit("len_removed="), length("removed_len")),
            "label": F.when(F.lower(tx.null_to_empty(F.col("action"))) == "reverted", 1).otherwise(0),
            "source": F.lit("intel_change_events"),
            "timestamp": tx.to_iso(F.col("ts_utc"), run_ts),
        },
    )


def _shard_files(spark: SparkSession, path: str, label: T.DataType) -> DataFrame:
    fields = [T.StructField(f.name, label if f.name == "label" else f.dataType) for f in SAMPLE.fields]
    reader = spark.read.schema(T.StructType(fields)).option("ignoreCorruptFiles", "true").option("pathGlobFilter", "*.parquet")
    return reader.parquet(path).select(*SAMPLE_COLUMNS, F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_path").alias("file_path"))


def _readable(files: DataFrame) -> DataFrame:
    """Files that give rows. The condition keeps the label column in the scan, whose type is in question."""
    labels = files.groupBy("file_path").agg(F.count("label").alias("n"))
    return labels.where("n >= 0").select("file_path")


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """Shard files with the name of the file each row came from; unreadable files are skipped (``skipped_shards`` lists them).

    A writer stores a label column that has a null as DOUBLE, and a file of another type than asked for counts as
    unreadable. So files are read with a whole-number label, and those that gave no row are read again with a
    floating one. Which files gave rows is seen from their label column alone.
    """
    def read() -> DataFrame:
        whole, floating = (_shard_files(spark, path, t) for t in (T.LongType(), T.DoubleType()))
        seen, also = _readable(whole), _readable(floating)
        more = floating.join(also.join(seen, "file_path", "left_anti"), "file_path", "left_semi")
        both = (df.withColumn("label", F.col("label").cast("bigint")) for df in (whole, more))
        return reduce(DataFrame.unionByName, both).drop("file_path")

    return or_empty(spark, read, T.StructType([*_SHARD_READ.fields, T.StructField("file_name", T.StringType())]))


def skipped_shards(spark: SparkSession, path: str) -> list[str]:
    """Files under ``path`` that give no row under either label type."""
    found = set()
    for kind in (T.LongType(), T.DoubleType()):
        found |= {r.file_path for r in _readable(_shard_files(spark, path, kind)).collect()}
    listed = spark.read.schema(_SHARD_READ).option("pathGlobFilter", "*.parquet").parquet(path).inputFiles()
    ends = {f.rsplit("/", 1)[-1] for f in found}
    return sorted(f for f in listed if f.rsplit("/", 1)[-1] not in ends)


def parse_shards(shards: DataFrame, run_ts: str, default_lang: str = "fr") -> DataFrame:
    text = {c: tx.null_to_empty(F.col(c)) for c in ("title", "user", "comment", "added_text", "removed_text")}
    named = F.nullif(tx.null_to_empty(F.col("source")), F.lit(""))
    return _sample(
        shards,
        text | {
            "lang": F.coalesce("lang", F.lit(default_lang)),
            "label": F.coalesce(F.col("label"), F.lit(0)).cast("int"),
            "source": F.coalesce(named, F.concat(F.lit("shard:"), "file_name")),
            "timestamp": tx.to_iso(F.col("timestamp"), run_ts),
        },
    )


# --- landed change events -------------------------------------------------------------------------

def read_changes(spark: SparkSession, path: str) -> DataFrame:
    return or_empty(spark, lambda: spark.read.schema(CHANGE).json(path), CHANGE)


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    return payload_table(or_empty(spark, lambda: spark.read.schema(DIFF_PAYLOAD).json(path), DIFF_PAYLOAD))


def recent_changes(changes: DataFrame, payloads: DataFrame, cap: int | None, run_ts: str) -> DataFrame:
    """Newest edits of each language, labelled by the revert rule; the stripped diff is the added text."""
    # Written first: the cap reads the changes several times.
    df = settle(prepare_changes(changes, run_ts), "changes")
    df = settle(sel.limit_newest(df, cap, "tie"), "recent")
    df = attach_diffs(df, payloads, "whole", "left", sel.has_revisions(F.col("revid"), F.col("old_revid")))
    revert = tx.is_revert(F.col("comment"), F.col("tags"))
    return sel.canonical(df.withColumns({"label": F.when(revert, 1).otherwise(0), "source": F.lit("recentchanges")}))


def human_reverts(
    changes: DataFrame, payloads: DataFrame, days: int, max_changes: int | None, max_diffs: int | None, run_ts: str
) -> DataFrame:
    """Reverts of the last ``days`` days with the suspect's text: what the revert removed was added before.

    The change cap counts scanned rows, the diff cap rows that have a diff.
    """
    now = F.lit(run_ts).cast("timestamp")
    # Written first: the caps read the changes several times, and a condition on the parsed time would be pushed down into
    # the scans below, where the parser's steps are repeated for every row of a table, joined or not.
    df = sel.within_days(settle(prepare_changes(changes, run_ts), "changes"), days, now)
    df = sel.valid_revision(sel.reverts_only(sel.limit_newest(df, max_changes, "tie")))
    df = attach_diffs(settle(df, "reverts"), payloads, "unescaped", "inner")
    df = sel.swap_texts(sel.limit_newest(settle(df, "diffs"), max_diffs, "tie"))
    return sel.canonical(df.withColumns({"label": F.lit(1), "source": F.lit("human_revert_api")}))


# --- union --------------------------------------------------------------------------------------------

def union_ranked(parts: list[DataFrame | None]) -> DataFrame:
    """Bag union by name; ``source_rank`` keeps the priority of each part (it decides which duplicate
    survives). Parts that are switched off are ``None``."""
    out = None
    for rank, part in enumerate(parts):
        if part is None:
            continue
        ranked = part.select(*SAMPLE_COLUMNS).withColumn("source_rank", F.lit(rank))
        out = ranked if out is None else out.unionByName(ranked)
    if out is None:
        raise ValueError("no source is switched on")
    return out


def collect_training_samples(
    spark: SparkSession, paths: dict[str, str], run_ts: str, cfg: CollectConfig = CollectConfig()
) -> DataFrame:
    """All configured sources in priority order. ``paths`` may hold ``corpus``, ``bot_db_<lang>``,
    ``change_events``, ``shards``, ``changes`` and ``payloads``."""
    parts: list[DataFrame | None] = []
    if "corpus" in paths:
        parts.append(parse_corpus(read_lines(spark, paths["corpus"]), run_ts, cfg.default_lang))
    for name in (n for n in paths if n.startswith("bot_db_")):
        parts.append(parse_bot_db(read_documents(spark, paths[name]), name.removeprefix("bot_db_"), run_ts))
    if "change_events" in paths:
        events = read_change_events(spark, paths["change_events"])
        parts.append(parse_change_events(events, run_ts, cfg.change_events_limit, cfg.default_lang))
    if "shards" in paths:
        parts.append(parse_shards(read_shards(spark, paths["shards"]), run_ts, cfg.default_lang))
    if "changes" in paths and "payloads" in paths:
        changes, payloads = read_changes(spark, paths["changes"]), read_payloads(spark, paths["payloads"])
        if cfg.human_reverts:
            parts.append(human_reverts(changes, payloads, *cfg.revert_scan, run_ts))
        if cfg.recent_changes:
            parts.append(recent_changes(changes, payloads, cfg.recent_changes_cap, run_ts))
    return union_ranked(parts)


def to_dataframe(samples: DataFrame) -> DataFrame:
    return sel.canonical(samples)


# --- documents --------------------------------------------------------------------------------------------

def metadata_fields(parsed: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Model metadata out of the variant column ``v``. A malformed or non-object document gives nulls
    only, and so does a field of the wrong type."""
    v = F.col("v")
    objects = parsed.withColumn("v", F.when(is_object(v), v))
    return objects.select(
        *keep, *(F.try_variant_get(v, f"$.{f.name}", f.dataType.simpleString()).alias(f.name) for f in METADATA.fields)
    )


def parse_metadata(documents: DataFrame) -> DataFrame:
    return metadata_fields(documents.select(F.try_parse_json(F.col("value")).alias("v")))


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    return parse_metadata(read_documents(spark, path))
