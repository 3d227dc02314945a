"""N-gram tables, vectors, model fitting, evaluation and scoring."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.ml import PipelineModel
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..config import SERVING_THRESHOLD, TrainConfig
from ..functions.features import hash_fraction, row_hash
from ..operators.balance import stratified_folds
from ..operators.enrich import enrich_features as enrich
from ..operators.enrich import safe_text, with_text
from ..operators.scale import release, scratch_path, settle
from ..operators.select import drop_null_labels
from ..plans import model as md
from ..plans import scoring as sc
from ..plans import training as tr
from ..plans import vocabulary as vo
from ..schemas import NUMERIC_FEATURES
from . import sqltext as s
from .feature_queries import top_tokens_sql
from .fixtures import edits, over_edits
from .registry import query

ID = ["revid", "source"]
# The training defaults, without the row floor at small scale.
CFG = TrainConfig(min_rows=50)

_T = f", t AS (SELECT *, {s.TEXT} AS text FROM edits)"
_WORDS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')"
_WORD = _T + f""", w AS (SELECT revid, source, {_WORDS} AS words FROM t),
 g AS (SELECT revid, source, unnest(list_concat(words, list_transform(range(1, len(words)), lambda i: concat(words[i], ' ', words[i + 1])))) AS gram FROM w)"""
_CHAR = _T + f""", w AS (SELECT revid, source, unnest(list_filter(regexp_split_to_array(lower(text), '[{s.WS}]+'), lambda x: x <> '')) AS w0 FROM t),
 p AS (SELECT revid, source, concat(' ', w0, ' ') AS w FROM w),
 n AS (SELECT revid, source, w, unnest([3, 4, 5]) AS n FROM p),
 g AS (SELECT revid, source, unnest(list_transform(range(1, length(w) - n + 2), lambda i: substr(w, i, n))) AS gram FROM n WHERE length(w) >= n)"""
_DF = """, d AS (SELECT revid, source, gram, count(*) AS n FROM g GROUP BY ALL),
 st AS (SELECT gram, count(*) AS df, sum(n) AS tf FROM d GROUP BY gram HAVING count(*) >= 2),
 vo AS (SELECT gram, df, tf, ln((1.0::DOUBLE + (SELECT count(*) FROM edits)) / (1 + df)) + 1 AS idf FROM st ORDER BY tf DESC, gram LIMIT {size})"""
_VOCAB = " SELECT gram, CAST(df AS BIGINT) AS df, CAST(tf AS BIGINT) AS tf, round(idf, 9) AS idf FROM vo"
_VECTOR = """, x AS (SELECT revid, source, n * idf AS v FROM d JOIN vo USING (gram)),
 vec AS (SELECT revid, source, count(*) AS terms, sum(v) / sqrt(sum(v * v)) AS weight FROM x GROUP BY ALL)
 SELECT e.revid, e.source, CAST(coalesce(terms, 0) AS INTEGER) AS terms, round(coalesce(weight, 0.0), 6) AS weight
 FROM edits e LEFT JOIN vec USING (revid, source)"""


def _text(spark, sf_dir):
    return with_text(safe_text(edits(spark, sf_dir))).select(*ID, "text")


def _table(spark, sf_dir, kind, size):
    return vo.df_table(_text(spark, sf_dir), kind, size).select("gram", "df", "tf", F.round("idf", 9).alias("idf"))


@query(over_edits(_WORD + _DF.format(size=60000) + _VOCAB))
def word_ngram_df(spark, sf_dir):
    return _table(spark, sf_dir, "word", CFG.word_vocabulary)


@query(over_edits(_CHAR + _DF.format(size=40000) + _VOCAB))
def char_ngram_df(spark, sf_dir):
    return _table(spark, sf_dir, "char", CFG.char_vocabulary)


def _vectors(spark, sf_dir, kind):
    rows = _text(spark, sf_dir)
    model = PipelineModel(md.tfidf_stages(rows, kind, CFG))
    values = F.unwrap_udt(F.col(f"{kind}_tfidf"))["values"]
    out = model.transform(vo.with_grams(rows, kind, "text", f"{kind}_grams")).select(*ID, values.alias("v"))
    total = F.aggregate("v", F.lit(0.0), lambda acc, x: acc + x)
    return out.select(*ID, F.size("v").alias("terms"), F.round(total, 6).alias("weight"))


@query(over_edits(_WORD + _DF.format(size=60000) + _VECTOR))
def tfidf_word(spark, sf_dir):
    return _vectors(spark, sf_dir, "word")


@query(over_edits(_CHAR + _DF.format(size=40000) + _VECTOR))
def tfidf_char(spark, sf_dir):
    return _vectors(spark, sf_dir, "char")


@query()
def assemble_features(spark, sf_dir):
    rows = enrich(edits(spark, sf_dir)).select(*ID, "text", *NUMERIC_FEATURES)
    out = md.feature_stages(rows, CFG).transform(md.gram_columns(rows))
    u = F.unwrap_udt("features")
    return out.select(*ID, F.size(u["values"]).alias("stored_values"), u["size"].isNotNull().alias("sparse"))


# --- fitting --------------------------------------------------------------------------------------

def _training_rows(spark, sf_dir):
    rows = tr.training_table(edits(spark, sf_dir), CFG)
    return rows.select(*ID, "label", "text", *NUMERIC_FEATURES)


@query()
def train_logreg(spark, sf_dir):
    """One uncalibrated fit on all labelled rows, scored on the same rows."""
    rows = _training_rows(spark, sf_dir).withColumn("fold", F.lit(0))
    vectors = md.feature_stages(rows, CFG).stages[:-1]
    bags = md.stored_counts(rows, vectors)
    base = md.logistic(bags, rows, CFG, [None], [""])
    release(bags.table)
    scored, [margin] = md.with_margins(rows, vectors, base)
    return scored.select(*ID, "label", md.sigmoid(margin).alias("score"))


@query()
def calibrate_platt(spark, sf_dir):
    """Sigmoid calibration over all folds: every row with its margin under the model that leaves its fold out and the calibrated
    score of that model, and the mean of the calibrated scores of all folds' models."""
    rows = settle(stratified_folds(_training_rows(spark, sf_dir), CFG.folds, id_columns=ID), "folds")
    scored, margins, probs = md.fit_folded(rows, CFG).calibrated(rows)
    own = lambda columns: F.element_at(F.array(*columns), F.col("fold"))
    return scored.select(*ID, "label", own(margins).alias("margin"), own(probs).alias("score"), md.mean(probs).alias("mean_score"))


_STORED: dict[tuple[str, str], tuple[dict, str]] = {}


def stored_model(spark, sf_dir) -> tuple[dict, str]:
    """Result and folder of one training run per session and table set."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STORED:
        out = scratch_path(spark, "training")
        _STORED[key] = (tr.train_and_export(edits(spark, sf_dir), out, CFG), out)
    return _STORED[key]


@query()
def train_and_export(spark, sf_dir):
    out = scratch_path(spark, "training")
    result = tr.train_and_export(edits(spark, sf_dir), out, CFG)
    _STORED[(spark.sparkContext.applicationId, sf_dir)] = (result, out)
    return result["metadata"].drop("model_version", "created_at_utc")


@query(over_edits(" SELECT revid, source, true AS same, true AS is_probability FROM edits"))
def sink_model(spark, sf_dir):
    """A stored model read back: every edit gets the same score from the latest and the archived copy."""
    result, out = stored_model(spark, sf_dir)
    rows = enrich(edits(spark, sf_dir)).select(*ID, "text", *NUMERIC_FEATURES)
    latest = md.CalibratedModel.load(spark, f"{out}/model/latest/model").transform(rows, "latest")
    both = md.CalibratedModel.load(spark, result["paths"]["archive"] + "/model").transform(latest, "archived")
    return both.select(
        *ID, (F.abs(F.col("latest") - F.col("archived")) < 1e-12).alias("same"), F.col("latest").between(0, 1).alias("is_probability")
    )


@query("SELECT unnest(['precision', 'recall', 'f1', 'auc', 'tn', 'fp', 'fn', 'tp', 'threshold']) AS metric, true AS same")
def evaluate_model(spark, sf_dir):
    """The stored model on the stored evaluation set gives the metrics that training has stored."""
    result, out = stored_model(spark, sf_dir)
    again = tr.evaluate_saved_model(spark, f"{out}/model/latest", result["paths"]["eval_dataset"])
    long = lambda df, name: df.unpivot([], df.columns, "metric", name)
    both = long(again, "now").join(long(result["metrics"], "then"), "metric")
    return both.select("metric", (F.abs(F.col("now") - F.col("then")) < 1e-9).alias("same"))


@query("SELECT CAST((i + 1) * 5 AS DOUBLE) / 100 AS threshold, true AS falls, true AS in_range FROM range(19) t(i)")
def threshold_eval_report(spark, sf_dir):
    """Recall never rises with the threshold, and all rates are shares."""
    result, out = stored_model(spark, sf_dir)
    report = tr.threshold_report(spark, f"{out}/model/latest", result["paths"]["eval_dataset"], scratch_path(spark, "report"))
    before = F.lag("recall", 1, 1.0).over(Window.orderBy("threshold"))  # one row per threshold
    shares = [F.col(c).between(0, 1) for c in ("precision", "recall", "f1")]
    return report.select(
        F.round("threshold", 2).alias("threshold"), (F.col("recall") <= before).alias("falls"), reduce(and_, shares).alias("in_range")
    )


@query(top_tokens_sql(4).replace("AS tokens FROM edits LEFT JOIN top", "AS explanations, true AS consistent FROM edits LEFT JOIN top"))
def score_edits(spark, sf_dir):
    """Explanations of every edit, and whether its verdict follows from its score and the stored threshold."""
    result, out = stored_model(spark, sf_dir)
    scored = sc.load_predictor(spark, f"{out}/model/latest").score(edits(spark, sf_dir))
    threshold = result["metadata"].first().threshold
    follows = F.col("verdict") == F.when(F.col("score") >= threshold, "VANDALISM").otherwise("LEGIT")
    return scored.select(*ID, F.array_join("explanations", " ").alias("explanations"), follows.alias("consistent"))


_HASH = f"round({s.hash_fraction(s.row_hash(ID))}, 9)"


@query(over_edits(f"""SELECT revid, source, {_HASH} AS score,
 CASE WHEN {_HASH} >= {SERVING_THRESHOLD} THEN 'VANDALISM' ELSE 'LEGIT' END AS verdict FROM edits"""))
def score_verdict(spark, sf_dir):
    score = F.round(hash_fraction(row_hash(ID)), 9)
    df = edits(spark, sf_dir).select(*ID, score.alias("score"))
    return df.withColumn("verdict", sc.verdict(F.col("score"), SERVING_THRESHOLD))
