"""Projections, filters, caps, joins and HTML extraction."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import joins
from ..operators import select as sel
from ..operators.scale import attach_count, settle
from ..operators.shards import with_dedup_key
from . import sqltext as s
from .fixtures import base_edits, edits, over_edits, table
from .registry import query

ID = ["revid", "source"]
_SAMPLE_SQL = ", ".join(
    f"{s.safe(c)} AS {c}" for c in ("lang", "title", '"user"', "comment", "added_text", "removed_text")
) + ', label, source, "timestamp"'


@query(over_edits(f"SELECT {_SAMPLE_SQL} FROM edits"))
def proj_canonical_sample(spark, sf_dir):
    return sel.canonical(edits(spark, sf_dir))


@query(over_edits("SELECT revid, source, coalesce(comment, '') AS comment FROM edits"))
def null_to_empty(spark, sf_dir):
    return edits(spark, sf_dir).select(*ID, tx.null_to_empty(F.col("comment")).alias("comment"))


# Each event type writes its time in another ISO form: complete, without zone, with either
# offset, or not at all.
_RAW_TS = """CASE event_type WHEN 'view' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
  WHEN 'click' THEN strftime(ts, ' %Y-%m-%dT%H:%M:%S+02:00') WHEN 'signup' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S-05:00')
  WHEN 'error' THEN '  ' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END"""


def _raw_ts():
    base = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    kind = F.col("event_type")
    return (
        F.when(kind == "view", base).when(kind == "click", F.concat(F.lit(" "), base, F.lit("+02:00")))
        .when(kind == "signup", F.concat(base, F.lit("-05:00"))).when(kind == "error", F.lit("  "))
        .otherwise(F.concat(base, F.lit("Z")))
    )


@query(f"""WITH r AS (SELECT event_id, trim({_RAW_TS}) AS t FROM events)
SELECT event_id, CASE WHEN t = '' THEN '{s.RUN_TS}' WHEN suffix(t, 'Z') OR contains(substr(t, 11), '+') THEN t
  ELSE concat(t, 'Z') END AS iso FROM r""")
def ts_to_iso(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", tx.to_iso(_raw_ts(), s.RUN_TS).alias("iso"))


@query("""SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE epoch_us(date_trunc('second', ts)
  + to_hours(CASE event_type WHEN 'click' THEN -2 WHEN 'signup' THEN 5 ELSE 0 END)) END AS micros FROM events""")
def ts_parse(spark, sf_dir):
    parsed = F.unix_micros(tx.parse_ts(_raw_ts()))
    return table(spark, sf_dir, "events").select("event_id", parsed.alias("micros"))


@query(over_edits(f"SELECT revid, source, {s.flag(s.IS_REVERT)} AS is_revert FROM edits"))
def revert_classify(spark, sf_dir):
    hit = tx.is_revert(F.col("comment"), F.col("tags"))
    return edits(spark, sf_dir).select(*ID, F.when(hit, 1).otherwise(0).alias("is_revert"))


@query(over_edits(f"SELECT revid, source FROM edits WHERE {s.IS_REVERT}"))
def filter_reverts_only(spark, sf_dir):
    return sel.reverts_only(edits(spark, sf_dir)).select(*ID)


@query(over_edits("SELECT revid, source FROM edits WHERE coalesce(revid, 0) <> 0 AND coalesce(old_revid, 0) <> 0"))
def filter_valid_revision(spark, sf_dir):
    return sel.valid_revision(edits(spark, sf_dir)).select(*ID)


@query("""SELECT event_id, event_type, value FROM events
WHERE ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 10 DAY AND ts <= TIMESTAMP '2024-01-31 00:00:00'""")
def filter_time_range(spark, sf_dir):
    now = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    return sel.within_days(table(spark, sf_dir, "events"), 10, now).select("event_id", "event_type", "value")


_STATE = """, state AS (SELECT lang, max("timestamp") AS last_ts FROM edits WHERE event_type = 'error' GROUP BY lang),
cursor AS (SELECT s.lang, s.last_ts, max(e.revid) AS last_revid FROM state s JOIN edits e
  ON e.lang = s.lang AND e."timestamp" = s.last_ts AND e.event_type = 'error' GROUP BY s.lang, s.last_ts)"""


def cursor_state(df):
    """A cursor per language: its newest error edit."""
    from ..operators.shards import newest_cursor

    return settle(newest_cursor(df.where(F.col("event_type") == "error")), "state")


@query(over_edits(_STATE + """ SELECT e.revid, e.source FROM edits e LEFT JOIN cursor c ON c.lang = e.lang
WHERE c.lang IS NULL OR e."timestamp" > c.last_ts OR (e."timestamp" = c.last_ts AND e.revid > c.last_revid)"""))
def filter_after_cursor(spark, sf_dir):
    df = edits(spark, sf_dir)
    seconds = df.withColumn("ts", tx.parse_ts(F.col("timestamp")))
    return sel.after_cursor(seconds, cursor_state(df)).select(*ID)


@query(over_edits("""SELECT revid, source FROM edits
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY ts DESC, revid DESC, source) <= 120"""))
def limit_newest(spark, sf_dir):
    return sel.limit_newest(edits(spark, sf_dir), 120, "source").select(*ID)


_BUDGET = """, r AS (SELECT *, CASE WHEN revid <> 0 AND old_revid <> 0 THEN row_number() OVER (PARTITION BY lang,
  (revid <> 0 AND old_revid <> 0) ORDER BY ts DESC, revid DESC, source) END AS rn FROM edits)"""


@query(over_edits(_BUDGET + """ SELECT revid, source, CASE WHEN rn <= 150 THEN added_text ELSE '' END AS added_text,
CASE WHEN rn <= 150 THEN removed_text ELSE '' END AS removed_text FROM r"""))
def diff_budget(spark, sf_dir):
    marked = sel.mark_budget(edits(spark, sf_dir), 150, "source")
    return sel.spend_budget(marked).select(*ID, "added_text", "removed_text")


@query(over_edits(f"""SELECT revid, source, removed_text AS added_text, added_text AS removed_text FROM edits
WHERE {s.IS_REVERT}"""))
def swap_revert_diff(spark, sf_dir):
    return sel.swap_texts(sel.reverts_only(edits(spark, sf_dir))).select(*ID, "added_text", "removed_text")


@query(over_edits("SELECT revid, source, label FROM edits WHERE label IS NOT NULL"))
def drop_null_labels(spark, sf_dir):
    return sel.drop_null_labels(edits(spark, sf_dir)).select(*ID, "label")


@query(over_edits("SELECT CAST(count(*) AS BIGINT) AS n, count(*) >= 1000 AS enough FROM edits"))
def guard_min_rows(spark, sf_dir):
    df = edits(spark, sf_dir)
    try:
        passed = sel.guard_min_rows(df, 1000).agg(F.count(F.lit(1)).alias("n"), F.lit(True).alias("enough"))
    except ValueError:
        passed = df.agg(F.count(F.lit(1)).alias("n"), F.lit(False).alias("enough"))
    return passed


# --- joins ------------------------------------------------------------------------------

_HTML = """concat('<table><tr><TD CLASS="diff-deletedline" id="d">', removed_text,
 '</TD><td class="diff-addedline"><div>', added_text, '</div></td></tr><tr><td class="diff-addedline">&lt;b&gt;A&amp;nbsp;B&nbsp;',
 coalesce(title, ''), '</td></tr></table>')"""
PAYLOAD_CTE = f""", payload AS (SELECT DISTINCT old_revid, revid, {_HTML} AS html, event_type FROM base_edits)"""
BASE_CTE = """, base_edits AS (SELECT * FROM edits WHERE NOT suffix(source, '_dup'))"""


def html_column():
    return F.concat(
        F.lit('<table><tr><TD CLASS="diff-deletedline" id="d">'), "removed_text",
        F.lit('</TD><td class="diff-addedline"><div>'), "added_text",
        F.lit('</div></td></tr><tr><td class="diff-addedline">&lt;b&gt;A&amp;nbsp;B&nbsp;'),
        F.coalesce("title", F.lit("")), F.lit("</td></tr></table>"),
    )


def payloads(spark, sf_dir):
    """Compare payloads as landed: the HTML under ``*``, or under ``body``, or missing (views)."""
    kind = F.col("event_type")
    h = F.col("h")
    compare = (
        F.when(kind == "view", F.create_map(F.lit("*"), F.lit("")))
        .when(kind == "click", F.create_map(F.lit("*"), F.lit(""), F.lit("body"), h))
        .otherwise(F.create_map(F.lit("*"), h))
    )
    raw = base_edits(spark, sf_dir).withColumn("h", html_column()).select("old_revid", "revid", compare.alias("compare"))
    return joins.payload_table(raw)


_ADDED = s.strip_html_collapse(s.cells("html", "diff-addedline"))
_REMOVED = s.strip_html_collapse(s.cells("html", "diff-deletedline"))


@query(over_edits(BASE_CTE + PAYLOAD_CTE + f""", d AS (SELECT *, CASE WHEN event_type = 'view' THEN '' ELSE {_ADDED} END AS a,
 CASE WHEN event_type = 'view' THEN '' ELSE {_REMOVED} END AS r FROM payload)
 SELECT e.revid, e.source, coalesce(d.a, '') AS added_text, coalesce(d.r, '') AS removed_text
 FROM edits e LEFT JOIN d ON d.old_revid = e.old_revid AND d.revid = e.revid"""))
def join_change_to_diff(spark, sf_dir):
    out = joins.attach_diffs(settle(edits(spark, sf_dir), "edits"), payloads(spark, sf_dir), "collapsed", "left")
    return out.select(*ID, "added_text", "removed_text")


_KEYED = f", k AS (SELECT *, {s.dedup_key()} AS dedup_key FROM edits)"


@query(over_edits(_KEYED + """ SELECT revid, source, dedup_key FROM k
WHERE (lang, dedup_key) NOT IN (SELECT lang, dedup_key FROM k WHERE event_type = 'click')"""))
def anti_join_dedup_index(spark, sf_dir):
    keyed = with_dedup_key(edits(spark, sf_dir))
    index = keyed.where(F.col("event_type") == "click")
    return joins.drop_known_keys(keyed.select(*ID, "lang", "dedup_key"), index).select(*ID, "dedup_key")


@query(over_edits("""SELECT e.revid, e.source, CAST(c.n AS BIGINT) AS user_rows FROM edits e
JOIN (SELECT "user", count(*) AS n FROM edits GROUP BY 1) c ON c."user" = e."user" """))
def equi_join_user_counts(spark, sf_dir):
    df = edits(spark, sf_dir).select(*ID, "user")
    return attach_count(df, F.col("user"), "user_rows").select(*ID, "user_rows")


@query(over_edits("""SELECT n.lang, n.negatives, CAST(coalesce(p.positives, 0) AS BIGINT) AS positives
FROM (SELECT lang, count(*) AS negatives FROM edits WHERE label = 0 GROUP BY lang) n
LEFT JOIN (SELECT lang, count(*) AS positives FROM edits WHERE label = 1 GROUP BY lang) p ON p.lang = n.lang"""))
def equi_join_lang_pos_counts(spark, sf_dir):
    from ..operators.balance import label_counts

    counts = label_counts(edits(spark, sf_dir), ["lang"]).where(F.col("neg") > 0)
    own = F.when(F.col("lang").isNull(), F.lit(0).cast("bigint")).otherwise(F.col("pos"))
    return counts.select("lang", F.col("neg").alias("negatives"), own.alias("positives"))


@query(over_edits(f"SELECT revid, source FROM edits WHERE {s.TAGGED}"))
def semi_join_tags(spark, sf_dir):
    return edits(spark, sf_dir).where(tx.has_revert_tag(F.col("tags"))).select(*ID)


@query(over_edits(f"""SELECT revid, source, array_to_string(list_sort(list_filter(list_transform(tags, lambda t: lower(t)),
 lambda t: list_contains({s.TAGS}, t))), ',') AS hit_tags FROM edits"""))
def set_intersect_tags(spark, sf_dir):
    hits = F.sort_array(tx.matching_revert_tags(F.col("tags")))
    return edits(spark, sf_dir).select(*ID, F.array_join(hits, ",").alias("hit_tags"))


# --- HTML --------------------------------------------------------------------------------

@query(f"SELECT page_id, {s.strip_html('html')} AS text FROM pages")
def html_strip(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", tx.strip_html(F.col("html")).alias("text"))


@query(f"SELECT page_id, {s.strip_html_collapse('html')} AS text FROM pages")
def html_strip_collapse(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", tx.strip_html_collapse(F.col("html")).alias("text"))


def _diff_query(spark, sf_dir, mode):
    df = edits(spark, sf_dir).withColumn("html", html_column())
    added, removed = tx.diff_texts(F.col("html"), mode)
    return df.select(*ID, added.alias("added_text"), removed.alias("removed_text"))


def _diff_sql(added, removed):
    return over_edits(f", h AS (SELECT revid, source, {_HTML} AS html FROM edits) "
                      f"SELECT revid, source, {added} AS added_text, {removed} AS removed_text FROM h")


@query(_diff_sql(s.strip_html(s.unescape(s.cells("html", "diff-addedline"))),
                 s.strip_html(s.unescape(s.cells("html", "diff-deletedline")))))
def diff_cells_unescaped(spark, sf_dir):
    return _diff_query(spark, sf_dir, "unescaped")


@query(_diff_sql(_ADDED, _REMOVED))
def diff_cells_collapsed(spark, sf_dir):
    return _diff_query(spark, sf_dir, "collapsed")


@query("SELECT page_id, " + s.strip_html("html") + " AS added_text, '' AS removed_text FROM pages")
def diff_whole_stripped(spark, sf_dir):
    added, removed = tx.diff_texts(F.col("html"), "whole")
    return table(spark, sf_dir, "pages").select("page_id", added.alias("added_text"), removed.alias("removed_text"))


@query("SELECT page_id, substr(html, 1, 4000) AS added_text, '' AS removed_text FROM pages")
def diff_raw_truncated(spark, sf_dir):
    added, removed = tx.diff_texts(F.col("html"), "raw:4000")
    return table(spark, sf_dir, "pages").select("page_id", added.alias("added_text"), removed.alias("removed_text"))
