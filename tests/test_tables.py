"""Filters, splits, rebalancing, metrics on small tables."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from editsieve.config import HarvestConfig
from editsieve.operators import balance as bal
from editsieve.operators import metrics as mt
from editsieve.operators import select as sel
from editsieve.operators import shards as sh
from editsieve.operators.enrich import enrich_features
from editsieve.schemas import FEATURE_COLUMNS, SHARD_COLUMNS

from .conftest import rows


def test_cursor_cases(spark):
    df = spark.createDataFrame(
        [("fr", "2024-01-01T00:00:00Z", 5), ("fr", "2024-01-02T00:00:00Z", 4), ("fr", "2024-01-02T00:00:00Z", 5),
         ("fr", "2024-01-02T00:00:00Z", 6), ("fr", "2024-01-03T00:00:00Z", 1), ("fr", "bad", 1), ("en", "2020-01-01", 1),
         (None, "2020-01-01", 2)],
        "lang string, timestamp string, revid long",
    ).withColumn("ts", F.to_timestamp(F.expr("try_to_timestamp(timestamp)")))
    state = spark.createDataFrame([("fr", "2024-01-02T00:00:00Z", 5)], "lang string, last_timestamp string, last_revid long")
    assert rows(sel.after_cursor(df, state), "lang", "timestamp", "revid") == sorted(
        [("fr", "2024-01-02T00:00:00Z", 6), ("fr", "2024-01-03T00:00:00Z", 1), ("fr", "bad", 1), ("en", "2020-01-01", 1),
         (None, "2020-01-01", 2)], key=repr)
    assert sel.after_cursor(df, None).count() == 8


def test_guard(spark):
    assert sel.guard_min_rows(spark.range(60), 50).count() == 60
    with pytest.raises(ValueError, match="too small"):
        sel.guard_min_rows(spark.range(10), 50)


def _split_input(spark, sizes, ts=True):
    data, i = [], 0
    for lang, n in sizes.items():
        for k in range(n):
            i += 1
            data.append((i, lang, k % 2, f"2024-01-{1 + k:02d}T00:00:00Z" if ts else "bad"))
    return spark.createDataFrame(data, "id int, lang string, label int, timestamp string")


@pytest.mark.parametrize("task_rows", [1, 1000])
def test_temporal_split_sizes(spark, task_rows):
    sizes = {"a": 1, "b": 2, "c": 5, "d": 10, None: 7}
    out = bal.temporal_split(_split_input(spark, sizes), ["id"], task_rows)
    train = {r.lang: r.n for r in out.where("split = 'train'").groupBy("lang").agg(F.count("*").alias("n")).collect()}
    assert train == {lang: max(int(n * 0.8), 1) for lang, n in sizes.items()}
    late = out.groupBy("lang", "split").agg(F.min("timestamp").alias("lo"), F.max("timestamp").alias("hi")).collect()
    edge = {(r.lang, r.split): r for r in late}
    assert edge["d", "train"].hi < edge["d", "holdout"].lo


def test_temporal_split_with_one_shared_time(spark):
    out = bal.temporal_split(_split_input(spark, {"a": 200}, ts=False), ["id"], task_rows=3)
    assert {r.split: r["count"] for r in out.groupBy("split").count().collect()} == {"train": 160, "holdout": 40}


def test_split_fallbacks(spark):
    singles = spark.createDataFrame(
        [(i, f"l{i}", i % 2, "2024-01-01T00:00:00Z") for i in range(10)], "id int, lang string, label int, timestamp string")
    train, hold = bal.train_holdout(singles, ["id"])
    assert (train.count(), hold.count()) == (10, 10)
    one_class_tail = spark.createDataFrame(
        [(i, "fr", int(i < 50), f"2024-01-{1 + i // 10:02d}T00:00:00Z") for i in range(100)], "id int, lang string, label int, timestamp string")
    train, hold = bal.train_holdout(one_class_tail, ["id"])
    assert {r.label: r["count"] for r in hold.groupBy("label").count().collect()} == {0: 10, 1: 10}
    assert train.count() == 80


@pytest.mark.parametrize("task_rows", [2, 1000])
def test_rebalance(spark, task_rows):
    data = [(i, "fr", int(i < 10)) for i in range(200)] + [(1000 + i, "en", 0) for i in range(150)]
    data += [(2000, None, 1)] + [(2001 + i, None, 0) for i in range(60)] + [(3000 + i, "de", 0) for i in range(30)]
    df = spark.createDataFrame(data, "id int, lang string, label int")
    out = bal.rebalance(df, ratio=2, id_columns=["id"], task_rows=task_rows)
    got = {(r.lang, r.label): r["count"] for r in out.groupBy("lang", "label").count().collect()}
    assert got == {("fr", 1): 10, ("fr", 0): 20, ("en", 0): 100, (None, 1): 1, (None, 0): 60, ("de", 0): 30}
    again = bal.rebalance(df.repartition(7), ratio=2, id_columns=["id"], task_rows=task_rows)
    assert rows(out) == rows(again)
    only = df.where("label = 0")
    assert bal.rebalance(only, 2, id_columns=["id"]).count() == only.count()


def test_drop_duplicates_keeps_priority_and_null_labels(spark):
    cols = "lang string, title string, user string, comment string, added_text string, removed_text string, label int, source string, source_rank int"
    base = ("fr", "t", "u", None, "a", "r")
    df = spark.createDataFrame([(*base, None, "late", 4), (*base, None, "early", 1), (*base, 1, "other", 0)], cols)
    assert rows(bal.drop_duplicates(df, ["source_rank"]), "label", "source") == [(1, "other"), (None, "early")]


def test_folds_are_disjoint_and_even(spark):
    df = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(101)], "id int, label int")
    out = bal.stratified_folds(df, 3, id_columns=["id"], task_rows=4)
    counts = {(r.label, r.fold): r["count"] for r in out.groupBy("label", "fold").count().collect()}
    assert counts == {(0, 1): 27, (0, 2): 27, (0, 3): 26, (1, 1): 7, (1, 2): 7, (1, 3): 7}


# --- metrics ---------------------------------------------------------------------------------

def _scored(spark, pairs):
    return spark.createDataFrame(pairs, "label int, score double")


def _auc(pairs):
    pos, neg = ([s for y, s in pairs if y == v] for v in (1, 0))
    if not pos or not neg:
        return 0.0
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def test_auc_against_all_pairs(spark):
    rnd = random.Random(11)
    pairs = [(rnd.randrange(2), round(rnd.random(), 1)) for _ in range(120)]
    assert mt.roc_auc(_scored(spark, pairs)).first().auc == pytest.approx(_auc(pairs))
    moved = [(y, 3 * s**3) for y, s in pairs]
    assert mt.roc_auc(_scored(spark, moved)).first().auc == pytest.approx(_auc(pairs))


@pytest.mark.parametrize("pairs,want", [([(1, 0.3), (1, 0.6)], 0.0), ([(0, 0.5), (1, 0.5)], 0.5), ([(0, 0.1), (1, 0.9)], 1.0)])
def test_auc_edges(spark, pairs, want):
    assert mt.roc_auc(_scored(spark, pairs)).first().auc == want


def test_confusion_counts_scores_at_the_threshold(spark):
    df = _scored(spark, [(1, 0.5), (0, 0.5), (1, 0.4), (0, 0.1)])
    assert tuple(mt.confusion(df, 0.5).first()) == (1, 1, 1, 1)
    assert {c: v for c, v in mt.full_metrics(df, 0.99).first().asDict().items() if c in ("precision", "recall", "f1")} == {
        "precision": 0.0, "recall": 0.0, "f1": 0.0}


def test_sweep_and_selection(spark):
    df = _scored(spark, [(1, 0.9), (1, 0.8), (0, 0.7), (1, 0.3), (0, 0.2)])
    report = mt.sweep(df)
    recall = [r.recall for r in report.orderBy("threshold").collect()]
    assert report.count() == 19 and recall == sorted(recall, reverse=True)
    assert mt.select_threshold(report, 0.9).first().threshold == 0.75
    assert mt.select_threshold(report, 1.1).first().threshold == 0.25
    assert [r.metric for r in mt.metrics_long(mt.full_metrics(df, 0.5)).collect()] == [
        "auc", "f1", "fn", "fp", "precision", "recall", "threshold", "tn", "tp"]


# --- features and shards -------------------------------------------------------------------------

def test_enrich_adds_every_feature_and_a_missing_user(spark):
    df = spark.createDataFrame([("t", None, "AAAAAA", "r")] * 2, "title string, comment string, added_text string, removed_text string")
    out = enrich_features(df).select(*FEATURE_COLUMNS).collect()
    assert all(r.burst_count == 2 and r.repeat_char_flag == 1 and r.upper_ratio == 1.0 for r in out)


def _changes(spark, data):
    return spark.createDataFrame(data, "lang string, type string, title string, user string, comment string, timestamp string, "
                                       "tags array<string>, revid long, old_revid long")


def test_shard_chain(spark):
    ts = "2024-01-{:02d}T00:00:00Z".format
    changes = _changes(spark, [
        ("fr", "edit", "A", "u", "Rv x", ts(5), [], 5, 4), ("fr", "edit", "A", "u", "Rv x", ts(5), ["again"], 5, 4),
        ("fr", "log", "B", "u", "Rv", ts(6), [], 6, 5), ("fr", "edit", "C", "u", "x", ts(4), [], 4, 3),
        ("fr", "edit", "D", "u", "www.x lol", ts(3), [], 3, 0), ("fr", "edit", "E", "u", "rvv", ts(1), [], 1, 1)])
    payloads = spark.createDataFrame([(4, 5, '<td class="diff-addedline">new</td>'), (3, 4, "<p>")],
                                     "old_revid long, revid long, compare_html string")
    state = spark.createDataFrame([("fr", ts(2), 0)], "lang string, last_timestamp string, last_revid long")
    cfg = HarvestConfig(easy_negative_rate=0.0)
    staged = sh.stage_shard(changes, payloads, None, state, cfg, "2024-02-01T00:00:00Z")
    out = sh.shard_rows(staged)
    assert out.columns == SHARD_COLUMNS
    assert rows(out, "title", "label", "added_text", "context_score", "sampling_bucket") == [
        ("A", 1, "new", 7, "positive"), ("D", 0, "", 5, "hard_negative")]
    counters = sh.run_counters(staged).first().asDict()
    assert counters == {"lang": "fr", "rows_written": 2, "diffs_done": 3, "changes_seen": 2, "dedup_dropped": 1,
                        "sampled_dropped": 1, "dedup_index_size": 2}
    index = out.select("lang", "dedup_key")
    assert sh.build_shard(changes, payloads, index, state, cfg).count() == 0
    reverts = sh.build_shard(changes, payloads, None, None, HarvestConfig(include_non_reverts=False))
    assert rows(reverts, "title") == [("A",), ("E",)]


def test_caps_count_before_filters_and_budget_keeps_rows(spark):
    changes = _changes(spark, [("fr", "edit", f"T{i}", "u", "Rv x" if i % 2 else "y", f"2024-01-01T00:{i:02d}:00Z", [], i, i - 1)
                               for i in range(1, 41)])
    payloads = spark.range(1, 41).select((F.col("id") - 1).alias("old_revid"), F.col("id").alias("revid"),
                                         F.lit('<td class="diff-addedline">z</td>').alias("compare_html"))
    out = sh.build_shard(changes, payloads, cfg=HarvestConfig(max_changes=10, max_diffs=4, auto_sampling=False))
    got = {r.revid: r.added_text for r in out.collect()}
    assert sorted(got) == list(range(31, 41)) and [r for r, t in got.items() if t == "z"] and sorted(
        r for r, t in got.items() if t == "z") == [37, 38, 39, 40]
    simple = sh.build_shard_simple(changes, payloads, cfg=HarvestConfig(max_changes=10, max_diffs=4))
    assert simple.where("added_text like '<td%'").count() == 4 and simple.count() == 10


def test_a_sampled_copy_does_not_take_the_key(spark):
    """Forty keys, each once plain and once tagged as reverted: all forty positives stay."""
    rows_in = []
    for i in range(1, 41):
        plain, tagged = (("fr", "edit", f"T{i}", f"u{i}", "x", "2024-01-05T00:00:00Z", tags, i, 0) for tags in ([], ["mw-reverted"]))
        rows_in += [plain, tagged]
    payloads = spark.createDataFrame([], "old_revid long, revid long, compare_html string")
    staged = sh.stage_shard(_changes(spark, rows_in), payloads, None, None, HarvestConfig(easy_negative_rate=0.0), "2024-02-01T00:00:00Z")
    out = sh.shard_rows(staged)
    assert out.where("sampling_bucket = 'positive'").count() == out.count() == 40
    c = sh.run_counters(staged).first()
    assert c.rows_written == 40 and c.dedup_dropped + c.sampled_dropped == 40 and c.sampled_dropped > 0 and c.dedup_dropped > 0


def test_html_is_not_shuffled(spark):
    from editsieve.operators.joins import attach_diffs
    from editsieve.operators.scale import settle

    changes = settle(_changes(spark, [("fr", "edit", "A", "u", "x", "2024-01-05T00:00:00Z", [], 5, 4)]), "changes")
    payloads = settle(spark.createDataFrame([(4, 5, "<p>"), (4, 5, "<b>")], "old_revid long, revid long, compare_html string"), "payloads")
    plan = attach_diffs(changes, payloads)._jdf.queryExecution().executedPlan().toString()
    above = [line for line in plan.splitlines() if "compare_html" in line and not any(x in line for x in ("Scan", "Project", "Filter", "ColumnarToRow"))]
    assert not above, above
