"""Feature expressions, one by one and all together."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import features as fx
from ..functions import tokens as tk
from ..functions.text import normalize, null_to_empty
from ..operators.enrich import enrich_features as enrich
from ..operators.enrich import project_features, safe_text, with_burst, with_text
from . import sqltext as s
from .fixtures import edits, over_edits
from .registry import query

ID = ["revid", "source"]
_TEXT_CTE = f", t0 AS (SELECT *, {s.TEXT} AS text FROM edits), t AS (SELECT *, string_split(text, '') AS ch FROM t0)"
RUN5 = s.repeat_run("ch", 5)
_BURST = f"""CAST(count(*) OVER (PARTITION BY {s.safe('"user"')}) AS BIGINT)"""


def _text(spark, sf_dir):
    return with_text(safe_text(edits(spark, sf_dir)))


def _one(expr: str, alias: str) -> str:
    return over_edits(f"{_TEXT_CTE} SELECT revid, source, {expr} AS {alias} FROM t")


@query(over_edits(f"SELECT revid, source, {s.TEXT} AS text FROM edits"))
def feat_text_blob(spark, sf_dir):
    return _text(spark, sf_dir).select(*ID, "text")


@query(f"SELECT doc_id, {s.norm('text')} AS text FROM documents")
def text_normalize(spark, sf_dir):
    from .fixtures import table

    return table(spark, sf_dir, "documents").select("doc_id", normalize(null_to_empty(F.col("text"))).alias("text"))


@query(_one(s.FEATURE_SQL["url_count"], "url_count"))
def feat_url_count(spark, sf_dir):
    return _text(spark, sf_dir).select(*ID, fx.url_count(F.col("text")).cast("bigint").alias("url_count"))


@query(_one(s.FEATURE_SQL["symbol_ratio"], "symbol_ratio"))
def feat_symbol_ratio(spark, sf_dir):
    return _text(spark, sf_dir).select(*ID, F.round(fx.symbol_ratio(F.col("text")), 9).alias("symbol_ratio"))


@query(_one(s.FEATURE_SQL["delta_len"], "delta_len"))
def feat_delta_len(spark, sf_dir):
    d = fx.delta_len(F.col("added_text"), F.col("removed_text")).cast("bigint")
    return edits(spark, sf_dir).select(*ID, d.alias("delta_len"))


@query(_one(s.FEATURE_SQL["title_sensitive"], "title_sensitive"))
def feat_title_sensitive(spark, sf_dir):
    return edits(spark, sf_dir).select(*ID, fx.title_sensitive(F.col("title")).alias("title_sensitive"))


@query(over_edits(f"SELECT revid, source, {_BURST} AS burst_count FROM edits"))
def feat_burst_count(spark, sf_dir):
    return with_burst(edits(spark, sf_dir).select(*ID, "user")).select(*ID, "burst_count")


@query(_one(s.FEATURE_SQL["is_ip_user"], "is_ip_user"))
def feat_is_ip_user(spark, sf_dir):
    return edits(spark, sf_dir).select(*ID, fx.is_ip_user(F.col("user")).alias("is_ip_user"))


@query(_one(s.FEATURE_SQL["digit_ratio"], "digit_ratio"))
def feat_digit_ratio(spark, sf_dir):
    return _text(spark, sf_dir).select(*ID, F.round(fx.digit_ratio(F.col("text")), 9).alias("digit_ratio"))


@query(_one(s.FEATURE_SQL["upper_ratio"], "upper_ratio"))
def feat_upper_ratio(spark, sf_dir):
    return edits(spark, sf_dir).select(*ID, F.round(fx.upper_ratio(F.col("added_text")), 9).alias("upper_ratio"))


@query(_one(s.flag(RUN5), "repeat_char_flag"))
def feat_repeat_char(spark, sf_dir):
    return _text(spark, sf_dir).select(*ID, fx.repeat_char_flag(F.col("text")).alias("repeat_char_flag"))


@query(_one(s.FEATURE_SQL["comment_revert_hint"], "comment_revert_hint"))
def feat_comment_revert_hint(spark, sf_dir):
    return edits(spark, sf_dir).select(*ID, fx.comment_revert_hint(F.col("comment")).alias("comment_revert_hint"))


_ALL_SQL = ", ".join(f"{sql} AS {name}" for name, sql in s.FEATURE_SQL.items()) \
    + f", {s.flag(RUN5)} AS repeat_char_flag, {_BURST} AS burst_count"
_TYPES = {"url_count": "bigint", "delta_len": "bigint"}
_ROUNDED = ("symbol_ratio", "digit_ratio", "upper_ratio")


def _comparable(df):
    df = df.withColumns({c: F.col(c).cast(t) for c, t in _TYPES.items()})
    return df.withColumns({c: F.round(c, 9) for c in _ROUNDED})


@query(over_edits(f"{_TEXT_CTE} SELECT revid, source, text, {_ALL_SQL} FROM t"))
def enrich_features(spark, sf_dir):
    from ..schemas import FEATURE_COLUMNS

    return _comparable(enrich(edits(spark, sf_dir))).select(*ID, *FEATURE_COLUMNS)


@query(over_edits(f"{_TEXT_CTE} SELECT text, {_ALL_SQL} FROM t"))
def project_feature_columns(spark, sf_dir):
    return _comparable(project_features(enrich(edits(spark, sf_dir))))


_TOKENS = "regexp_extract_all(text, '[a-z0-9à-öø-ÿ_''\\x{17f}\\x{131}-]{3,40}')"


def top_tokens_sql(k: int) -> str:
    return over_edits(f"""{_TEXT_CTE},
    tok AS (SELECT revid, source, unnest({_TOKENS}) AS token, unnest(range(len({_TOKENS}))) AS pos FROM t),
    cnt AS (SELECT revid, source, token, count(*) AS n, min(pos) AS first FROM tok GROUP BY ALL),
    rnk AS (SELECT *, row_number() OVER (PARTITION BY revid, source ORDER BY n DESC, first) AS rn FROM cnt),
    top AS (SELECT revid, source, string_agg(token, ' ' ORDER BY rn) AS tokens FROM rnk WHERE rn <= {k} GROUP BY ALL)
    SELECT edits.revid, edits.source, coalesce(tokens, '') AS tokens FROM edits LEFT JOIN top USING (revid, source)""")


@query(top_tokens_sql(5))
def top_tokens(spark, sf_dir):
    out = tk.top_tokens(_text(spark, sf_dir).select(*ID, "text"), "text", 5, "tokens")
    return out.select(*ID, F.array_join("tokens", " ").alias("tokens"))


@query(top_tokens_sql(4))
def explain_edits(spark, sf_dir):
    out = tk.top_tokens(_text(spark, sf_dir).select(*ID, "text"), "text", 4, "tokens")
    return out.select(*ID, F.array_join("tokens", " ").alias("tokens"))
