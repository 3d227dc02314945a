"""Quality classifier: a byte-level convolutional network in numpy.

A text is read as UTF-8 bytes. ``FILTERS`` learned filters of ``WIDTH`` bytes slide over it; each filter is a table of
``WIDTH x 257`` weights (256 byte values and a pad value), so its response at a position is a gather and add of ``WIDTH``
table rows (the same as a convolution over one-hot bytes). The text is cut into chunks of ``CHUNK`` windows that overlap by
``WIDTH - 1`` bytes, so together they hold every window of the whole text. Each chunk is max-pooled per filter (after a ReLU);
the chunk maxima are combined over the document as their maximum and as their byte-weighted mean, and one logistic unit
turns both into the probability of label 1.

Training uses the labelled rows whose ``crc32(doc_id as text) mod FOLDS`` is not ``HELD_OUT``: at most ``TRAIN_ROWS`` of them
(by a hash of the id, among the first ``CANDIDATES`` usable labelled ids), of at most ``TRAIN_BYTES`` bytes each (a longer
labelled text is no training example). That bounded
sample is fitted on the driver by Adam with back-propagation through the max-pools (gradients reach the table rows at the
winning positions only). Scoring is a ``mapInPandas`` over every whole text; the weights (``WIDTH * 257 * FILTERS`` numbers) go to
the tasks. Labels, language, source and id are never inputs of a score.

Defined results: a null text is empty; a text shorter than ``WIDTH`` bytes (also an empty one) is padded to one window, so it
gets a score too; equal texts get equal scores; null ids are held out and never learnt from; an id with both labels, or a
null label, is no training example; without labels of both classes the network is not trained and every score is the share
of label 1 among the usable labels (0.5 without any); an empty table gives no row. Only ``doc_id`` and ``text`` of the
documents and ``doc_id``, ``quality`` of the labels are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.7
WIDTH = 5
FILTERS = 32
CHUNK = 2048
PAD = 256
TRAIN_ROWS = 4000
TRAIN_BYTES = 20_000
# Labelled ids looked up in the documents to fill the sample (some texts may be too long).
CANDIDATES = 2 * TRAIN_ROWS
EPOCHS = 12
BATCH = 32
RATE = 0.01
SEED = 13

SCORED = "doc_id long, held_out boolean, score double, predicted int"


def held_out(doc_id: Column) -> Column:
    return doc_id.isNull() | (F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT)


@dataclass
class Network:
    tables: np.ndarray  # (WIDTH, 257, FILTERS)
    bias: np.ndarray  # (FILTERS,)
    out: np.ndarray  # (2 * FILTERS,): weights of the max and of the mean of chunk maxima
    out_bias: np.ndarray  # (1,)

    def params(self) -> list[np.ndarray]:
        return [self.tables, self.bias, self.out, self.out_bias]


def _bytes(text: str | None) -> np.ndarray:
    b = np.frombuffer((text or "").encode("utf-8"), dtype=np.uint8).astype(np.int64)
    if len(b) < WIDTH:
        b = np.concatenate([b, np.full(WIDTH - len(b), PAD, dtype=np.int64)])
    return b


def _forward(net: Network, b: np.ndarray):
    """Chunk maxima (C, F), their window positions (C, F), chunk weights (C,) and the pooled features (2F,)."""
    n = len(b) - WIDTH + 1
    resp = np.broadcast_to(net.bias, (n, FILTERS)).copy()
    for t in range(WIDTH):
        resp += net.tables[t][b[t : t + n]]
    np.maximum(resp, 0.0, out=resp)
    chunks = -(-n // CHUNK)
    padded = np.full((chunks * CHUNK, FILTERS), -1.0)
    padded[:n] = resp
    blocks = padded.reshape(chunks, CHUNK, FILTERS)
    pos = blocks.argmax(axis=1)
    best = np.take_along_axis(blocks, pos[:, None, :], axis=1)[:, 0, :]
    sizes = np.minimum(CHUNK, n - np.arange(chunks) * CHUNK).astype(np.float64)
    weights = sizes / n
    top = best.argmax(axis=0)
    feats = np.concatenate([best.max(axis=0), weights @ best])
    return best, pos + (np.arange(chunks) * CHUNK)[:, None], weights, top, feats


def probability(net: Network, text: str | None) -> float:
    z = float(_forward(net, _bytes(text))[4] @ net.out + net.out_bias[0])
    return float(1.0 / (1.0 + np.exp(-z)))


class Scorer:
    """Inference only: single precision, chunk maxima by ``reduceat`` without a padded copy."""

    def __init__(self, net: Network):
        self.tables = net.tables.astype(np.float32)
        self.bias = net.bias.astype(np.float32)
        self.out = net.out.astype(np.float64)
        self.out_bias = float(net.out_bias[0])

    def __call__(self, text: str | None) -> float:
        b = _bytes(text)
        n = len(b) - WIDTH + 1
        resp = self.tables[0][b[:n]]
        resp += self.bias
        for t in range(1, WIDTH):
            resp += self.tables[t][b[t : t + n]]
        np.maximum(resp, 0.0, out=resp)
        starts = np.arange(0, n, CHUNK)
        best = np.maximum.reduceat(resp, starts, axis=0).astype(np.float64)
        weights = np.minimum(CHUNK, n - starts) / n
        z = float(np.concatenate([best.max(axis=0), weights @ best]) @ self.out + self.out_bias)
        return float(1.0 / (1.0 + np.exp(-z)))


def fit(texts: list[str], labels: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> Network:
    """Adam on the log loss over the sample, back-propagated through both poolings."""
    rng = np.random.default_rng(seed)
    net = Network(rng.normal(0, 0.1, (WIDTH, PAD + 1, FILTERS)), np.zeros(FILTERS), rng.normal(0, 0.1, 2 * FILTERS), np.zeros(1))
    data = [_bytes(t) for t in texts]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in net.params()]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(data))
        for start in range(0, len(order), BATCH):
            grads = [np.zeros_like(p) for p in net.params()]
            batch = order[start : start + BATCH]
            for i in batch:
                b = data[i]
                best, where, weights, top, feats = _forward(net, b)
                z = float(feats @ net.out + net.out_bias[0])
                d = (1.0 / (1.0 + np.exp(-z)) - labels[i]) / len(batch)
                grads[2] += d * feats
                grads[3][0] += d
                # each chunk maximum gets the mean's weight; the chunk holding the document maximum also the max weight
                g = d * weights[:, None] * net.out[FILTERS:][None, :]
                g[top, np.arange(FILTERS)] += d * net.out[:FILTERS]
                g = np.where(best > 0, g, 0.0)
                grads[1] += g.sum(axis=0)
                cols = np.broadcast_to(np.arange(FILTERS), where.shape)
                for t in range(WIDTH):
                    np.add.at(grads[0][t], (b[where + t], cols), g)
            step += 1
            for p, gr, (m, v) in zip(net.params(), grads, moments):
                m *= 0.9
                m += 0.1 * gr
                v *= 0.999
                v += 0.001 * gr * gr
                p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def training_sample(docs: DataFrame, labels: DataFrame) -> tuple[list[str], np.ndarray]:
    """The bounded sample of labelled, not held-out whole texts.

    The ids are chosen from ``labels`` alone (the first ``CANDIDATES`` usable ids by hash), and only that bounded id list
    meets the documents, as a broadcast: no text is shuffled. Of those, texts over ``TRAIN_BYTES`` are no example, and the
    first ``TRAIN_ROWS`` by the same hash order are the sample.
    """
    spark = docs.sparkSession
    one = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.min("quality").alias("lo"), F.max("quality").alias("hi"), F.count("quality").alias("n"), F.count(F.lit(1)).alias("all"))
    usable = one.where((F.col("lo") == F.col("hi")) & (F.col("n") == F.col("all")) & ~held_out(F.col("doc_id")))
    order = [F.xxhash64(F.col("doc_id").cast("long")), F.col("doc_id").cast("long")]
    chosen = usable.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lo").alias("y")).orderBy(*order).limit(CANDIDATES).collect()
    if not chosen:
        return [], np.array([])
    ids = F.broadcast(spark.createDataFrame(chosen, "doc_id long, y int"))  # at most CANDIDATES rows
    rows = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
        .join(ids, "doc_id")
        .where(F.octet_length("text") <= TRAIN_BYTES)
        .orderBy(*order)
        .limit(TRAIN_ROWS)
        .collect()
    )
    return [r.text for r in rows], np.array([float(r.y) for r in rows])


class _Constant:
    def __init__(self, p: float):
        self.p = p


def _scorer(net: Network | _Constant):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        score = None if isinstance(net, _Constant) else Scorer(net)
        for pdf in batches:
            if score is None:
                scores = np.full(len(pdf), net.p)
            else:
                scores = np.array([score(t) for t in pdf["text"]], dtype=np.float64)
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "score": scores})

    return run


def train(docs: DataFrame, labels: DataFrame) -> Network | _Constant:
    texts, y = training_sample(docs, labels)
    if len(y) == 0:
        return _Constant(0.5)
    if y.min() == y.max():
        return _Constant(float(y[0]))
    return fit(texts, y)


def quality_scores(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every document (contract of ``op13``)."""
    net = train(docs, labels)
    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(_scorer(net), "doc_id long, score double")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
