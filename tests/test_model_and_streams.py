"""Training, scoring and streaming end to end on small tables."""

from __future__ import annotations

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from editsieve.config import HarvestConfig, TrainConfig
from editsieve.operators.scale import scratch_path
from editsieve.plans import model as md
from editsieve.plans import scoring as sc
from editsieve.plans import training as tr
from editsieve.plans import vocabulary as vo
from editsieve.sources import sinks
from editsieve.streaming import harvest as hv

from .conftest import rows

CFG = TrainConfig(min_rows=50, max_iter=8, word_vocabulary=200, char_vocabulary=200)


def _samples(spark, n=150):
    rnd = random.Random(1)
    good, bad = ["river", "city", "born", "album"], ["lol", "idiot", "spam", "haha"]
    data = []
    for i in range(n):
        y = int(i % 3 == 0)
        words = " ".join(rnd.choice(bad if y else good) for _ in range(8))
        data.append((["fr", "en"][i % 2], f"Title {i}", f"u{i % 7}", "edit", f"{words} {i}", "", y, "s",
                     f"2024-01-{1 + i % 28:02d}T00:00:00Z"))
    return spark.createDataFrame(data, "lang string, title string, user string, comment string, added_text string, "
                                       "removed_text string, label int, source string, timestamp string")


@pytest.fixture(scope="module")
def trained(spark):
    out = scratch_path(spark, "toy")
    return out, tr.train_and_export(_samples(spark), out, CFG, version="v1")


def test_gram_statistics_count_documents_and_uses(spark):
    texts = ["le chat le chat", "un chat", "", "abc abcd"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    want_df, want_tf = Counter(), Counter()
    for t in texts:
        grams = []
        for w in t.split():
            p = f" {w} "
            grams += [p[i:i + n] for n in (3, 4, 5) for i in range(len(p) - n + 1)]
        want_tf.update(grams)
        want_df.update(set(grams))
    got = {r.gram: (r.df, r.tf) for r in vo.gram_stats(df, "char").collect()}
    assert got == {g: (want_df[g], want_tf[g]) for g in want_tf}
    word = {r.gram: (r.df, r.tf) for r in vo.gram_stats(df, "word").collect()}
    assert word["chat"] == (2, 3) and word["le chat"] == (1, 2) and word["chat le"] == (1, 1)
    split = vo.gram_stats(df, "word", {"1": F.col("text").startswith("le")}).where("gram = 'chat'").first()
    assert (split.df_1, split.tf_1) == (1, 2)
    idf = {r.gram: r.idf for r in vo.df_table(df, "word", 10).collect()}
    assert idf == {"chat": pytest.approx(math.log(5 / 3) + 1)}


def test_training_separates_a_toy_table(spark, trained):
    out, result = trained
    m = result["metrics"].first()
    assert m.auc == 1.0 and m.tp + m.tn + m.fp + m.fn == result["metadata"].first().holdout_rows
    meta = result["metadata"].first()
    assert meta.rows_total == meta.train_rows + meta.holdout_rows == 150 and meta.labels_positive == 50
    again = tr.evaluate_saved_model(spark, f"{out}/model/latest", result["paths"]["eval_dataset"]).first()
    assert again.threshold == m.threshold and again.auc == 1.0
    assert tr.threshold_report(spark, f"{out}/model/latest", result["paths"]["eval_dataset"]).count() == 19
    with pytest.raises(ValueError):
        tr.train_and_export(_samples(spark, 20), out, CFG)


def test_predictor(spark, trained):
    out, _ = trained
    edits = _samples(spark, 30).drop("label")
    predictor = sc.load_predictor(spark, f"{out}/model/latest")
    scored = predictor.score(edits).collect()
    assert predictor.enabled and predictor.version == "v1"
    assert all(0 <= r.score <= 1 and len(r.explanations) <= 4 for r in scored)
    assert all((r.verdict == "VANDALISM") == (r.score >= predictor.threshold) for r in scored)
    off = sc.load_predictor(spark, f"{out}/nothing")
    row = off.score(edits).first()
    assert not off.enabled and (row.score, row.verdict, row.explanations, row.model_version) == (0.0, "UNKNOWN", [], "unavailable")
    assert sc.Predictor(None, {"threshold": 0}).threshold == 0.65


def test_platt_targets(spark):
    df = spark.createDataFrame([(1, 2.0), (0, 1.0), (0, 0.5)], "label int, m double")
    got = md.platt_rows(df).groupBy("m").agg(F.sum("weight").alias("w"), F.sum(F.col("label") * F.col("weight")).alias("t"))
    assert {r.m: (r.w, pytest.approx(r.t)) for r in got.collect()} == {2.0: (1.0, 2 / 3), 1.0: (1.0, 1 / 4), 0.5: (1.0, 1 / 4)}


def _land(spark, path, ids):
    data = [("fr", "edit", f"T{i}", "u", "Rv x", f"2024-01-01T00:{i:02d}:00Z", [], i, i - 1) for i in ids]
    df = spark.createDataFrame(data, "lang string, type string, title string, user string, comment string, timestamp string, "
                                     "tags array<string>, revid long, old_revid long")
    df.coalesce(1).write.mode("append").json(path)


def test_harvest_resumes_and_never_stores_a_key_twice(spark, tmp_path):
    landing, out, chk = (str(tmp_path / n) for n in ("landing", "out", "chk"))
    payloads = spark.createDataFrame([(0, 1, '<td class="diff-addedline">z</td>')], "old_revid long, revid long, compare_html string")
    handle = hv.harvest_batch(spark, payloads, out, HarvestConfig(), "2024-02-01T00:00:00Z", use_cursor=False)

    def run():
        hv.run_batches(hv.read_change_stream(spark, landing, 1), handle, chk).awaitTermination()
        return rows(sinks.read_shard_table(spark, f"{out}/shards"), "revid")

    _land(spark, landing, [1, 2, 3])
    assert run() == [(1,), (2,), (3,)]
    assert run() == [(1,), (2,), (3,)]
    _land(spark, landing, [2, 3, 4])
    assert run() == [(1,), (2,), (3,), (4,)]
    # A replayed batch replaces its own output.
    handle(spark.read.json(landing).where("revid = 4").withColumn("tags", F.array().cast("array<string>")), 1)
    assert rows(sinks.read_shard_table(spark, f"{out}/shards"), "revid") == [(1,), (2,), (3,), (4,)]
    cursor = sinks.read_cursor_state(spark, f"{out}/state").first()
    assert (cursor.last_revid, cursor.rows_written, cursor.dedup_index_size) == (4, 1, 4)


def test_harvest_with_cursor_drops_late_events(spark, tmp_path):
    landing, out, chk = (str(tmp_path / n) for n in ("landing", "out", "chk"))
    payloads = spark.createDataFrame([], "old_revid long, revid long, compare_html string")
    handle = hv.harvest_batch(spark, payloads, out, HarvestConfig(), "2024-02-01T00:00:00Z")
    for ids in ([5, 6], [1, 7]):
        _land(spark, landing, ids)
        hv.run_batches(hv.read_change_stream(spark, landing), handle, chk).awaitTermination()
    assert rows(sinks.read_shard_table(spark, f"{out}/shards"), "revid") == [(5,), (6,), (7,)]


def test_registry_is_consistent():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries()) and len(e.queries()) > 85
