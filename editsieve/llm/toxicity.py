"""Toxicity by compression distance.

Two zstandard dictionaries are trained on bounded samples of labelled text: an ordinary one from the word beginnings that most
ordinary documents share, and a toxic one, which has in addition those that set toxic documents apart. A text is cut in windows of
words, and each window is compressed with both. A window that gets shorter with the toxic dictionary holds what only
toxic text has; ordinary text gains nothing, since both dictionaries know it. Window gains are compared with a threshold, and a
small logistic model, fitted on labelled documents that were not used for the dictionaries, turns them into a probability.

The sample is at most ``SAMPLE`` documents per class, by hash of the id, of at most ``SAMPLE_CHARS`` characters each (a longer
labelled document is no training example). Scoring takes every whole text.

Defined results: null, empty and blank texts have no gain and get the score of no evidence; without labels of both classes all
scores are 0; equal rows get equal scores; null ids count as held out, so they are never learnt from; an empty table
gives no row; ``reject_toxic`` returns the input columns as they are.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FOLDS = 5
SAMPLE = {1: 1600, 0: 3200}
SAMPLE_CHARS = 20_000
WINDOW = 12
ORDINARY_BYTES, TOXIC_BYTES = 40_000, 1024
# Word beginnings in bytes, with the blank before; a whole word ends with a blank.
SHORTEST, LONGEST = 5, 14
# A telling beginning occurs in at least this share of the toxic sample, and so many times more often than in ordinary text.
TELLING_SHARE, TELLING_RATIO = 0.02, 8
# Bytes a window must gain to count.
GAIN = 2


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


@dataclass(frozen=True)
class ToxicModel:
    ordinary: bytes
    toxic: bytes
    mean: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]  # the last one is the intercept


class GainMeter:
    """Window gains of texts under one pair of dictionaries."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        import zstandard as zstd

        # The fast strategy with a target length leaves literals as they are, so lengths differ by matches alone.
        params = zstd.ZstdCompressionParameters(
            compression_level=1, strategy=zstd.STRATEGY_FAST, target_length=1, min_match=5, window_log=17, hash_log=16,
            format=zstd.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_checksum=0, write_dict_id=0,
        )

        def packer(content: bytes):
            table = zstd.ZstdCompressionDict(content, dict_type=zstd.DICT_TYPE_RAWCONTENT)
            table.precompute_compress(compression_params=params)
            return zstd.ZstdCompressor(dict_data=table, compression_params=params).compress

        # What stands last in a dictionary is nearest, so the toxic part comes after the ordinary one.
        self.plain, self.marked = packer(ordinary), packer(ordinary + toxic)

    def gains(self, text: bytes) -> np.ndarray:
        words = text.lower().split()
        windows = (b" " + b" ".join(words[i : i + WINDOW]) + b" " for i in range(0, len(words), WINDOW))
        return np.array([len(self.plain(w)) - len(self.marked(w)) for w in windows], dtype=np.float64)

    def features(self, text: bytes) -> tuple[float, ...]:
        g = self.gains(text)
        if not len(g):
            return (0.0, 0.0, 0.0, 0.0)
        hits = g >= GAIN
        return (float(g.clip(-GAIN, 4 * GAIN).mean()), float(g.max()), float(hits.mean()), math.log1p(hits.sum()))


def beginnings(texts: Iterable[bytes]) -> Counter:
    """In how many texts each word beginning occurs."""
    found: Counter = Counter()
    for text in texts:
        seen = set()
        for w in set(text.lower().split()):
            word = b" " + w[: LONGEST + 1] + b" "
            seen.update(word[:n] for n in range(SHORTEST, min(len(word), LONGEST) + 1))
        found.update(seen)
    return found


def without_copies(texts: list[bytes], words: int = 5, most: float = 0.2) -> list[bytes]:
    """Sampled texts without those that share many shingles with earlier ones: copies would make anything look telling."""
    seen: set[int] = set()
    kept = []
    for text in texts:
        w = text.lower().split()
        own = {hash(tuple(w[i : i + words])) for i in range(max(1, len(w) - words + 1))}
        if len(own & seen) <= most * len(own):
            kept.append(text)
        seen |= own
    return kept


def train_dictionaries(toxic: list[bytes], ordinary: list[bytes]) -> tuple[bytes, bytes]:
    """Contents of the ordinary and of the toxic dictionary, best segments last."""
    t, o = beginnings(toxic), beginnings(ordinary)
    common, size = [], 0
    for s, n in sorted(o.items(), key=lambda x: (-x[1], x[0])):
        if n < 2 or size + len(s) > ORDINARY_BYTES:
            break
        common.append(s)
        size += len(s)
    least = max(3, TELLING_SHARE * len(toxic))
    rated = {}
    for s, n in t.items():
        ratio = ((n + 0.5) / (len(toxic) + 1)) / ((o.get(s, 0) + 0.5) / (len(ordinary) + 1))
        if n >= least and ratio > TELLING_RATIO:
            rated[s] = n * math.log(ratio)
    telling: list[bytes] = []
    size = 0
    for s in sorted(rated, key=lambda s: (-rated[s], s)):
        if any(a.startswith(s) or s.startswith(a) for a in telling):
            continue
        # The longest continuation that is hardly rarer makes the longer match.
        longer = [x for x in rated if x.startswith(s) and t[x] >= 0.9 * t[s]]
        s = max(longer, key=lambda x: (len(x), x))
        if size + len(s) > TOXIC_BYTES:
            break
        telling.append(s)
        size += len(s)
    return b"".join(reversed(common)) or b"  ", b"".join(reversed(telling)) or b"  "


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30) -> np.ndarray:
    """Newton steps on standardised columns; the last weight is the intercept."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    penalty = np.diag([ridge] * (x.shape[1] - 1) + [1e-6])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + penalty
        step = np.linalg.solve(hessian, x.T @ (p - y) + penalty @ w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame) -> ToxicModel | None:
    """Learn from the labelled rows outside the held-out fold; None without both classes."""
    known = labels.select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("toxic")).where("toxic IN (0, 1)")
    known = known.where(~held_out(F.col("id"))).withColumn("h", F.xxhash64("id"))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).where(F.length("text") <= SAMPLE_CHARS)
    sample: dict[int, list[bytes]] = {}
    for c, most in SAMPLE.items():
        # Ids are drawn from the labels alone: at most ``most`` of them go to the texts, which stay where they are.
        drawn = F.broadcast(known.where(F.col("toxic") == c).select("id", "h").distinct().orderBy("h", "id").limit(most))
        rows = texts.join(drawn, F.col("doc_id") == F.col("id")).select("h", "text").orderBy("h", "text").limit(most)
        sample[c] = [r.text.encode() for r in rows.collect()]
    if not sample[0] or not sample[1]:
        return None
    # Even places make the dictionaries, odd ones the calibration.
    sample = {c: without_copies(texts) for c, texts in sample.items()}
    ordinary, toxic = train_dictionaries(sample[1][::2], sample[0][::2])
    meter = GainMeter(ordinary, toxic)
    rest = [(t, c) for c in (0, 1) for t in sample[c][1::2] or sample[c]]
    x = np.array([meter.features(t) for t, _ in rest])
    y = np.array([c for _, c in rest], dtype=np.float64)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    w = fit_logistic((x - mean) / scale, y)
    # The sample holds the classes in a ratio of its own: put the true one back.
    total = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    w[-1] += math.log((total[1] / total[0]) / (y.sum() / (len(y) - y.sum())))
    return ToxicModel(ordinary, toxic, tuple(mean), tuple(scale), tuple(w))


def score_column(docs: DataFrame, model: ToxicModel | None, carried: list[str]) -> DataFrame:
    """(*carried, score); texts come from ``text``."""
    kinds = T.StructType([*docs.select(*carried).schema.fields, T.StructField("score", T.DoubleType())])
    source = docs.select(*carried, F.coalesce("text", F.lit("")).cast("binary").alias("bytes"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        if model is not None:
            meter = GainMeter(model.ordinary, model.toxic)
            mean, scale, w = np.array(model.mean), np.array(model.scale), np.array(model.weights)
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            if model is not None and batch.num_rows:
                x = np.array([meter.features(v.as_py()) for v in batch.column("bytes")])
                z = ((x - mean) / scale) @ w[:-1] + w[-1]
                scores = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in carried), pa.array(scores)], names=[*carried, "score"])

    return source.mapInArrow(run, kinds)


def toxicity(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    scored = score_column(rows, fit(docs, labels), ["doc_id", "held_out"])
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def reject_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without those scored toxic."""
    quoted = (F.col("`" + c.replace("`", "``") + "`") for c in docs.columns)
    rows = docs.select(F.struct(*quoted).alias("row"), "text")
    return score_column(rows, fit(docs, labels), ["row"]).where("score < 0.5").select("row.*")
