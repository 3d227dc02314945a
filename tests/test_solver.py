"""The fits of all folds over stored counts: the loss is as low as a plain solver's, with vocabularies, idf and class weights of each fold."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from editsieve.config import TrainConfig
from editsieve.plans import model as md
from editsieve.plans import solver
from editsieve.schemas import NUMERIC_FEATURES
from editsieve.workload import model_queries

CFG = TrainConfig(word_vocabulary=60, char_vocabulary=80)


def _table(spark):
    rnd = random.Random(4)
    good, bad = ["river", "city", "born", "naïve", "lol"], ["lol", "idiot", "spam", "haha", "city"]
    data = []
    for i in range(180):
        words = " ".join(rnd.choice(bad if i % 3 == 0 else good) for _ in range(rnd.choice([0, 1, 9]))) + f" {i % 5}"
        data.append((i, int(i % 3 == 0), 1 + i % 2, words if i % 11 else "", *(float(rnd.randint(0, 40)) for _ in NUMERIC_FEATURES)))
    return spark.createDataFrame(data, "id long, label int, fold int, text string, " + ", ".join(f"{c} double" for c in NUMERIC_FEATURES))


def _plain(x, y, steps=60):
    """Newton's method for the balanced loss with an L2 penalty on all weights but the intercept."""
    c = np.where(y > 0, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    x = np.c_[x, np.ones(len(x))]
    free = np.r_[np.ones(x.shape[1] - 1), 0.0]
    loss = lambda w: c @ (np.logaddexp(0, x @ w) - y * (x @ w)) + 0.5 * free @ (w * w)
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(x @ w)))
        step = np.linalg.solve((x.T * (c * p * (1 - p))) @ x + np.diag(free + 1e-12), x.T @ (c * (p - y)) + free * w)
        t = 1.0
        while loss(w - t * step) > loss(w) and t > 1e-9:
            t /= 2
        w = w - t * step
    return loss, loss(w)


def test_the_loss_is_that_of_a_plain_solver(spark):
    """With 10 steps, as before, it stays well above."""
    table = _table(spark).cache()
    stages = md.feature_stages(table, CFG)
    rows = stages.transform(md.gram_columns(table)).select("features", "label", "fold").collect()
    x, y = np.array([r.features.toArray() for r in rows]), np.array([r.label for r in rows])
    fold = np.array([r.fold for r in rows])
    wide = [md.GramTfidf(s.kind, s.grams, s.idfs * 3, ["a", "b", "c"]) for s in stages.stages[:-1]]
    models = md.logistic(md.stored_counts(table, wide), table, CFG, [None, 1, 2], ["", "", ""])
    short = md.logistic(md.stored_counts(table, wide[:]), table, TrainConfig(max_iter=10), [None, 1, 2], ["", "", ""])
    for k, (model, weak) in enumerate(zip(models, short)):
        mine = fold != k if k else fold > 0
        loss, best = _plain(x[mine], y[mine])
        w, few = (np.r_[m.coefficientMatrix.toArray()[0], m.interceptVector[0]] for m in (model, weak))
        assert best <= loss(w) <= best * (1 + 1e-4) and loss(few) > best * 1.002


def test_blocks_do_not_depend_on_their_size(spark, monkeypatch):
    table = _table(spark)
    stages = md.feature_stages(table, CFG).stages[:-1]
    fit = solver.Fit(0, 1, (1.0, 2.0))
    w = np.random.default_rng(1).normal(size=sum(len(s.grams) for s in stages) + len(NUMERIC_FEATURES) + 1)
    whole = solver.sums(md.stored_counts(table, stages), [(fit, w, True)])[0]
    rows = [r for r in PipelineModel([*stages, md.Assembler()]).transform(md.gram_columns(table)).collect() if r.fold != 1]
    x = np.array([np.r_[r.features.toArray(), 1.0] for r in rows])
    y = np.array([r.label for r in rows])
    c, p = 1.0 + y, 1 / (1 + np.exp(-(x @ w)))
    assert whole[0] == pytest.approx(c @ (np.logaddexp(0, x @ w) - y * (x @ w)))
    assert np.allclose(whole[1], (c * (p - y)) @ x, rtol=1e-9, atol=1e-7) and np.allclose(whole[2], (c * p * (1 - p)) @ x**2, atol=1e-7)
    monkeypatch.setattr(solver, "PARTS", 0)  # sums over the executors first
    again = solver.sums(md.stored_counts(table.repartition(7), stages), [(fit, w, True)])[0]
    assert again[0] == pytest.approx(whole[0]) and np.allclose(again[1], whole[1])


def test_one_class_alone_is_certain(spark):
    table = _table(spark).where("label = 1")
    bags = md.stored_counts(table, md.feature_stages(table, CFG).stages[:-1])
    [model] = md.logistic(bags, table, CFG, [None], [""])
    assert model.interceptVector[0] == np.inf and not model.coefficientMatrix.toArray().any()


def test_every_fold_is_calibrated_under_its_own_vocabulary(spark, monkeypatch):
    """Before, one fold was, under a vocabulary of all rows, and the steps were cut to 10."""
    assert model_queries.CFG.max_iter == TrainConfig().max_iter == 500
    table = _table(spark).withColumns({"revid": F.col("id"), "source": F.lit("s")})
    seen = table.withColumn("text", F.concat("text", F.when(F.col("id") < 3, " once").otherwise(""))).drop("fold")
    monkeypatch.setattr(model_queries, "_training_rows", lambda spark, sf_dir: seen)
    monkeypatch.setattr(model_queries, "CFG", CFG)
    rows = {r.revid: r for r in model_queries.calibrate_platt(spark, "none").collect()}
    assert len(rows) == 180 and len({round(r.mean_score, 9) for r in rows.values()}) > 20
    assert all(0 < r.score < 1 and 0 < r.mean_score < 1 for r in rows.values())
    # The margin orders the scores of a fold, and the labels' shares are met on the held-out rows: that is what calibration does.
    assert np.mean([r.score for r in rows.values()]) == pytest.approx(1 / 3, abs=0.02)


def test_steps_of_a_training_run_do_not_stay_on_disk(spark, tmp_path):
    """Before, five copies of the rows, the gram counts and the vectors of all folds stayed until the session's end."""
    import os

    from editsieve.operators.scale import shared_dir
    from editsieve.plans import training as tr
    from tests.test_model_and_streams import _samples

    here = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(here))
    tr.train_and_export(_samples(spark), str(tmp_path / "out"), TrainConfig(min_rows=50, max_iter=8, word_vocabulary=200, char_vocabulary=200), version="v1")
    left = {name.rsplit("-", 1)[0] for name in set(os.listdir(here)) - before}
    assert not left & {"unique", "balanced", "split", "folds", "word-grams", "char-grams", "bags", "vectors"}


def test_a_stored_model_scores_the_stored_set_as_training_did(spark, tmp_path):
    """Before, rows per user were counted again among the held-out rows, so a fully fitted model gave other metrics than those stored."""
    from editsieve.plans import training as tr
    from tests.test_model_and_streams import _samples

    out = str(tmp_path / "out")
    cfg = TrainConfig(min_rows=50, word_vocabulary=200, char_vocabulary=200)
    result = tr.train_and_export(_samples(spark), out, cfg, version="v1")
    held = spark.read.parquet(result["paths"]["eval_dataset"])
    model = md.CalibratedModel.load(spark, f"{out}/model/latest/model")
    key = lambda df: sorted((r.label, round(r.score, 12)) for r in df.select("label", "score").collect())
    assert held.agg(F.max("burst_count")).first()[0] > held.groupBy("user").count().agg(F.max("count")).first()[0]
    assert key(tr._score_eval(spark, f"{out}/model/latest", result["paths"]["eval_dataset"])[0]) == key(model.transform(held))
