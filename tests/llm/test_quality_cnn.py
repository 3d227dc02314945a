"""op13: gradients against finite differences, held-out accuracy, defined results."""

from __future__ import annotations

import random
import zlib

import numpy as np

from editsieve.llm import quality_cnn as q
from tests.llm.conftest import odd_rows


def loss(net, texts, y):
    p = np.array([q.probability(net, t) for t in texts])
    return float(-np.mean(y * np.log(p) + (1 - y) * np.log(1 - p)))


def test_gradient_matches_finite_differences():
    rng = np.random.default_rng(1)
    texts, y = ["abc | def | ghi", "plain words here and there", "x" * 5000 + " tail", ""], np.array([0.0, 1.0, 1.0, 0.0])
    net = q.Network(rng.normal(0, 0.3, (q.WIDTH, 257, q.FILTERS)), rng.normal(0, 0.1, q.FILTERS), rng.normal(0, 0.3, 2 * q.FILTERS), np.zeros(1))
    # the table row of the winning window's first byte: analytic gradient of one filter against finite differences
    before = loss(net, texts, y)
    b = q._bytes(texts[0])
    best, where, weights, top, feats = q._forward(net, b)
    j = int(np.argmax(best[0] > 0))
    t, byte = 0, int(b[where[0, j]])
    eps = 1e-5
    net.tables[0, byte, j] += eps
    up = loss(net, texts[:1], y[:1])
    net.tables[0, byte, j] -= 2 * eps
    down = loss(net, texts[:1], y[:1])
    net.tables[0, byte, j] += eps
    numeric = (up - down) / (2 * eps)
    z = float(feats @ net.out + net.out_bias[0])
    d = 1 / (1 + np.exp(-z)) - y[0]
    analytic = d * (net.out[j] + weights[0] * net.out[q.FILTERS + j])
    assert abs(numeric - analytic) < 1e-4 * max(1, abs(analytic))
    assert before > 0


def noisy(rng):
    words = ["the", "river", "house", "garden", "quiet", "morning", "light", "people", "walked", "slowly", "along", "road"]
    if rng.random() < 0.5:
        return " | ".join(rng.choice(words)[: rng.randint(2, 5)] + rng.choice(["th", "ng", "er"]) for _ in range(rng.randint(5, 60))), 0
    return " ".join(rng.choice(words) for _ in range(rng.randint(5, 60))) + ".", 1


def test_held_out_accuracy_and_contract(spark, table):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(400):
        text, y = noisy(rng)
        rows.append((i, text))
        labels.append((i, y, 0))
    docs = table(rows + odd_rows())
    lab = spark.createDataFrame(labels + [(5, 1, 0), (5, 0, 0), (7, None, 0)], "doc_id long, quality int, toxic int")
    got = q.quality_scores(spark, docs, lab).collect()
    assert len(got) == len(rows) + len(odd_rows())
    truth = dict((i, y) for i, y, _ in labels)
    held = [r for r in got if r.held_out and r.doc_id in truth and r.doc_id < 400]
    assert all(r.held_out == ((zlib.crc32(str(r.doc_id).encode()) % 4 == 2) if r.doc_id is not None else True) for r in got)
    assert len(held) > 60
    right = sum((r.predicted == 1) == (truth[r.doc_id] == 1) for r in held)
    assert right / len(held) >= 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    fives = {r.score for r in got if r.doc_id == 5}
    assert len(fives) == 3  # four rows of id 5: two share a text, two others differ


def test_without_two_classes_and_empty(spark, table):
    docs = table([(1, "some text"), (2, None), (3, "")])
    one = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert {r.score for r in q.quality_scores(spark, docs, one).collect()} == {1.0}
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in q.quality_scores(spark, docs, none).collect()} == {0.5}
    assert q.quality_scores(spark, table([]), one).count() == 0


def test_scorer_equals_plain_forward():
    rng = np.random.default_rng(4)
    net = q.Network(rng.normal(0, 0.2, (q.WIDTH, 257, q.FILTERS)), rng.normal(0, 0.1, q.FILTERS), rng.normal(0, 0.2, 2 * q.FILTERS), np.ones(1))
    fast = q.Scorer(net)
    for text in ["", None, "ab", "é中文 | <b>", "long text " * 3000]:
        assert abs(fast(text) - q.probability(net, text)) < 1e-6
