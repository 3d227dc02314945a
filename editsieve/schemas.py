"""Row shapes shared by all jobs."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: column names and order of the tables on disk -------------
SAMPLE_COLUMNS = [
    "lang", "title", "user", "comment", "added_text", "removed_text", "label", "source", "timestamp",
]
SHARD_COLUMNS = SAMPLE_COLUMNS + [
    "revid", "old_revid", "tags", "context_score", "sampling_bucket", "dedup_key",
]
SIMPLE_SHARD_COLUMNS = SAMPLE_COLUMNS + ["revid", "old_revid", "tags"]
NUMERIC_FEATURES = [
    "url_count", "symbol_ratio", "burst_count", "title_sensitive", "delta_len", "is_ip_user",
    "digit_ratio", "upper_ratio", "repeat_char_flag", "comment_revert_hint",
]
FEATURE_COLUMNS = ["text", *NUMERIC_FEATURES]
DEDUP_COLUMNS = ["lang", "title", "user", "comment", "added_text", "removed_text", "label"]
# -----------------------------------------------------------------------------


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "strings": T.ArrayType(T.StringType()),
    "texts": T.MapType(T.StringType(), T.StringType()),
}


def _struct(text: str) -> T.StructType:
    """``"a string, b bigint"`` -> struct type, without needing a running session."""
    fields = (f.split() for f in text.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


SAMPLE = _struct(
    "lang string, title string, user string, comment string, added_text string, "
    "removed_text string, label int, source string, timestamp string"
)
SHARD = _struct(
    "lang string, title string, user string, comment string, added_text string, "
    "removed_text string, label int, source string, timestamp string, revid bigint, "
    "old_revid bigint, tags string, context_score int, sampling_bucket string, dedup_key string"
)
CHANGE = _struct(
    "lang string, type string, title string, user string, comment string, timestamp string, "
    "tags strings, revid bigint, old_revid bigint"
)
DIFF_PAYLOAD = _struct("old_revid bigint, revid bigint, compare texts")
CORPUS_LINE = _struct(
    "lang string, title string, reverter string, comment string, added_text string, "
    "removed_text string, timestamp string"
)
BOT_ENTRY = _struct(
    "title string, creator string, comment string, added_text string, removed_text string, timestamp string"
)
CHANGE_EVENT = _struct(
    "id bigint, ts_utc string, lang string, title string, creator string, action string, score double, "
    "reason string, matched_patterns string, added_len int, removed_len int"
)
CURSOR = _struct(
    "lang string, last_timestamp string, last_revid bigint, rows_written bigint, diffs_done bigint, "
    "changes_seen bigint, dedup_dropped bigint, sampled_dropped bigint, dedup_index_size bigint, "
    "updated_at string, latest_file string"
)
METADATA = _struct(
    "model_version string, rows_total bigint, train_rows bigint, holdout_rows bigint, labels_positive bigint, "
    "labels_negative bigint, created_at_utc string, features strings, threshold double, "
    "target_precision double"
)
