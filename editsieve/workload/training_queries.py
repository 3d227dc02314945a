"""Dedup, rebalance, splits, metrics and reports of the training table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.features import hash_fraction, row_hash
from ..operators import aggregates as ag
from ..operators import balance as bal
from ..operators import metrics as mt
from ..operators.select import drop_null_labels
from . import sqltext as s
from .fixtures import edits, over_edits
from .registry import query

ID = ["revid", "source"]
_DEDUP = 'lang, title, "user", comment, added_text, removed_text, label'
HASH = s.row_hash(ID)


@query(over_edits(f"""SELECT revid, source, label FROM edits
QUALIFY row_number() OVER (PARTITION BY {_DEDUP} ORDER BY source, revid) = 1"""))
def drop_duplicates_samples(spark, sf_dir):
    return bal.drop_duplicates(edits(spark, sf_dir), ["source", "revid"]).select(*ID, "label")


_LAB = f", lab AS (SELECT *, {HASH} AS h FROM edits WHERE label IS NOT NULL)"
_REB = _LAB + """, pos AS (SELECT lang, count(*) AS p FROM lab WHERE label = 1 GROUP BY lang),
 neg AS (SELECT l.*, row_number() OVER (PARTITION BY l.lang ORDER BY h) AS rn,
   CASE WHEN coalesce(p, 0) > 0 THEN p * 2 ELSE 100 END AS cap FROM lab l LEFT JOIN pos USING (lang) WHERE label = 0),
 reb AS (SELECT revid, source, lang, label, h FROM lab WHERE label = 1 UNION ALL
   SELECT revid, source, lang, label, h FROM neg WHERE rn <= cap)"""


def _labelled(spark, sf_dir):
    return drop_null_labels(edits(spark, sf_dir))


@query(over_edits(_REB + " SELECT revid, source, lang, label FROM reb"))
def rebalance_negatives(spark, sf_dir):
    narrow = _labelled(spark, sf_dir).select(*ID, "lang", "label")
    return bal.rebalance(narrow, ratio=2, id_columns=ID)


@query(over_edits(_LAB + " SELECT revid, source, h, CAST(row_number() OVER (ORDER BY h) AS BIGINT) AS place FROM lab"))
def shuffle_rows(spark, sf_dir):
    """The shuffled order, with each row's place made visible by an exact running count."""
    from ..operators.scale import running_totals

    rows = bal.shuffled(_labelled(spark, sf_dir).select(*ID), id_columns=ID)
    numbered = running_totals(rows.withColumn("h", row_hash(ID)).withColumn("one", F.lit(1)), "h", {"one": "before"})
    return numbered.select(*ID, "h", (F.col("before") + 1).cast("bigint").alias("place"))


_TSPLIT = _LAB + """, sp AS (SELECT revid, source, lang, label, CASE WHEN row_number() OVER (PARTITION BY lang
   ORDER BY date_trunc('second', ts) NULLS LAST, h) <= greatest(count(*) OVER (PARTITION BY lang) * 4 // 5, 1)
   THEN 'train' ELSE 'holdout' END AS split FROM lab)"""


@query(over_edits(_TSPLIT + " SELECT revid, source, lang, label, split FROM sp"))
def temporal_split(spark, sf_dir):
    narrow = _labelled(spark, sf_dir).select(*ID, "lang", "label", "timestamp")
    return bal.temporal_split(narrow, id_columns=ID).select(*ID, "lang", "label", "split")


@query(over_edits(""", one AS (SELECT lang, max(ts) AS ts FROM edits GROUP BY lang)
SELECT e.lang, e.revid, e.source FROM edits e JOIN one USING (lang, ts)
QUALIFY row_number() OVER (PARTITION BY e.lang ORDER BY e.revid DESC, e.source) = 1"""))
def temporal_split_fallback_tail(spark, sf_dir):
    """The newest edit of each language: a table in which every language has one row."""
    from ..operators.scale import first_per_key
    from ..operators.select import newest_order

    df = edits(spark, sf_dir).select(*ID, "lang", "ts", "timestamp")
    order = newest_order(F.col("ts"), F.col("revid"), F.col("source"))
    return bal.tail_holdout(first_per_key(df, ["lang"], order)).select("lang", *ID)


@query(over_edits(_LAB + """ SELECT revid, source, label, CASE WHEN row_number() OVER (PARTITION BY label ORDER BY h)
  <= ceil(0.2 * count(*) OVER (PARTITION BY label)) THEN 'holdout' ELSE 'train' END AS split FROM lab"""))
def stratified_split_fallback(spark, sf_dir):
    narrow = _labelled(spark, sf_dir).select(*ID, "label")
    return bal.stratified_split(narrow, id_columns=ID).select(*ID, "label", "split")


@query(over_edits(_LAB + """ SELECT revid, source, label,
  CAST(ntile(3) OVER (PARTITION BY label ORDER BY h) AS INTEGER) AS fold FROM lab"""))
def stratified_folds(spark, sf_dir):
    narrow = _labelled(spark, sf_dir).select(*ID, "label")
    return bal.stratified_folds(narrow, 3, id_columns=ID).select(*ID, "label", "fold")


@query(over_edits(_LAB + """ SELECT revid, source, CAST(count(*) OVER () AS DOUBLE)
  / (2.0 * count(*) OVER (PARTITION BY label)) AS weight FROM lab"""))
def class_weights(spark, sf_dir):
    return bal.class_weights(_labelled(spark, sf_dir).select(*ID, "label")).select(*ID, "weight")


# --- aggregates ----------------------------------------------------------------------------

@query(over_edits(_TSPLIT + """ SELECT CAST(count(*) AS BIGINT) AS rows_total, CAST(sum(label) AS BIGINT) AS labels_positive,
 CAST(sum(1 - label) AS BIGINT) AS labels_negative, CAST(count(*) FILTER (WHERE split = 'train') AS BIGINT) AS train_rows,
 CAST(count(*) FILTER (WHERE split = 'holdout') AS BIGINT) AS holdout_rows FROM sp"""))
def agg_label_counts(spark, sf_dir):
    return ag.label_summary(temporal_split(spark, sf_dir))


@query(over_edits(_TSPLIT + """ SELECT split, CAST(count(DISTINCT label) AS BIGINT) AS labels,
 CAST(count(*) AS BIGINT) AS rows FROM sp GROUP BY split"""))
def agg_distinct_labels(spark, sf_dir):
    return bal.split_label_counts(temporal_split(spark, sf_dir))


@query(over_edits("""SELECT "user", CAST(count(*) AS BIGINT) AS burst_count FROM edits GROUP BY 1"""))
def agg_user_counts(spark, sf_dir):
    return ag.user_counts(edits(spark, sf_dir))


@query(over_edits("SELECT lang, label, CAST(count(*) AS BIGINT) AS rows FROM edits GROUP BY lang, label"))
def agg_lang_label(spark, sf_dir):
    return ag.lang_label_counts(edits(spark, sf_dir))


# --- metrics on a repeatable score -------------------------------------------------------------

_SC = _LAB + f", sc AS (SELECT label, round({s.hash_fraction('h')}, 3) AS score FROM lab)"


def scored(spark, sf_dir):
    """Labelled edits with a hash as score (three decimals, so that ties occur)."""
    df = _labelled(spark, sf_dir)
    return df.select("label", F.round(hash_fraction(row_hash(ID)), 3).alias("score"))


def _conf(thr: str) -> str:
    return f"""count(*) FILTER (WHERE score < {thr} AND label = 0) AS tn, count(*) FILTER (WHERE score >= {thr} AND label = 0) AS fp,
 count(*) FILTER (WHERE score < {thr} AND label = 1) AS fn, count(*) FILTER (WHERE score >= {thr} AND label = 1) AS tp"""


_PRF = """CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END AS precision,
 CASE WHEN tp + fn = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fn) END AS recall,
 CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) END AS f1"""
_AUC = """, ranked AS (SELECT label, count(*) FILTER (WHERE label = 0) OVER (ORDER BY score RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS le,
   count(*) FILTER (WHERE label = 0) OVER (PARTITION BY score) AS eq FROM sc),
 auc AS (SELECT sum(CASE WHEN label = 1 THEN le - 0.5::DOUBLE * eq ELSE 0 END)
   / (CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE) * count(*) FILTER (WHERE label = 0)) AS auc FROM ranked)"""
_SWEEP = f""", th AS (SELECT unnest(range(5, 96, 5)) / 100.0::DOUBLE AS threshold),
 cm AS (SELECT threshold, count(*) FILTER (WHERE score >= threshold AND label = 0) AS fp,
   count(*) FILTER (WHERE score < threshold AND label = 1) AS fn, count(*) FILTER (WHERE score >= threshold AND label = 1) AS tp
   FROM th, sc GROUP BY threshold), sw AS (SELECT threshold, {_PRF} FROM cm)"""


def _rounded(df, *cols):
    return df.withColumns({c: F.round(c, 9) for c in cols})


@query(over_edits(_SC + f" SELECT {_conf('0.5')} FROM sc"))
def confusion_matrix(spark, sf_dir):
    return mt.confusion(scored(spark, sf_dir), 0.5)


@query(over_edits(_SC + f", c AS (SELECT {_conf('0.5')} FROM sc), p AS (SELECT {_PRF} FROM c) "
                  "SELECT round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1 FROM p"))
def precision_recall_f1(spark, sf_dir):
    c = mt.confusion(scored(spark, sf_dir), 0.5)
    rates = mt.prf(F.col("tp"), F.col("fp"), F.col("fn"))
    return _rounded(c.select(*(v.alias(k) for k, v in rates.items())), "precision", "recall", "f1")


@query(over_edits(_SC + _AUC + " SELECT round(auc, 9) AS auc FROM auc"))
def roc_auc(spark, sf_dir):
    return _rounded(mt.roc_auc(scored(spark, sf_dir)), "auc")


@query(over_edits(_SC + _SWEEP + """ SELECT threshold, round(precision, 9) AS precision, round(recall, 9) AS recall,
 round(f1, 9) AS f1 FROM sw"""))
def threshold_sweep(spark, sf_dir):
    return _rounded(mt.sweep(scored(spark, sf_dir)), "precision", "recall", "f1")


def _select_sql(target: str) -> str:
    return over_edits(_SC + _SWEEP + f""" SELECT threshold, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1
 FROM sw ORDER BY precision >= {target} DESC, CASE WHEN precision >= {target} THEN recall ELSE f1 END DESC, threshold LIMIT 1""")


@query(_select_sql("0.9"))
def threshold_select(spark, sf_dir):
    return _rounded(mt.select_threshold(mt.sweep(scored(spark, sf_dir)), 0.9), "precision", "recall", "f1")


@query(over_edits(_SC + _AUC + f""", c AS (SELECT {_conf('0.5')} FROM sc), p AS (SELECT *, {_PRF} FROM c),
 m AS (SELECT unnest(['precision', 'recall', 'f1', 'auc', 'tn', 'fp', 'fn', 'tp', 'threshold']) AS metric,
   unnest([precision, recall, f1, (SELECT auc FROM auc), tn::DOUBLE, fp::DOUBLE, fn::DOUBLE, tp::DOUBLE, 0.5::DOUBLE]) AS value FROM p)
 SELECT metric, round(value, 4) AS value FROM m ORDER BY metric"""))
def metrics_long(spark, sf_dir):
    return mt.metrics_long(mt.full_metrics(scored(spark, sf_dir), 0.5))
