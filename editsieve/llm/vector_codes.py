"""Vector code compression by per-dimension value dictionaries.

Every component ``x`` of a kept vector becomes the integer ``floor(256 * x)``; a vector of ``D`` components is cut into
``PARTS`` equal consecutive parts of ``D / PARTS``. Each part position has a codebook of at most ``ENTRIES`` entries, started
from that part of the kept vectors with the smallest ids. ``ROUNDS`` rounds assign every part to its nearest entry and move
each entry to the componentwise ``floor(sum / count)`` of its parts (an unused entry stays); then the parts are assigned again.

Assignment is the dealt method: within one Arrow batch, each dimension's distinct integers are tabulated once against all
entries of their part (squared differences), so the distance of a part to every entry is a gather of those table rows by the
value codes, added over the part's dimensions. Ties go to the lower entry index.

Spark does the work: every round is one scan of ``embeddings`` in Arrow batches (``mapInPandas``), whose tasks emit partial
sums per (part, entry, position), at most ``PARTS * ENTRIES * D / PARTS`` rows per batch, which a ``groupBy`` adds up. Only the
codebooks (``ENTRIES * D`` integers, a parameter bound) pass the driver. The per-label error sum is a grouped aggregate,
written and joined back, so a label with a third of all rows never meets in one task.

Defined results: vectors that are null, hold a null or a non-finite component, or whose length is not the length ``D`` of the
smallest kept id (or not a multiple of ``PARTS``) are dropped; null ids sort last when the first entries are taken, and ties
between equal ids by the vector; repeated rows are coded alike and each counts in the sums; with fewer than ``ENTRIES`` kept
vectors the codebooks have that many entries; an empty table (or one with nothing kept) gives no row. Null labels form one group.
Only ``vec_id``, ``embedding`` and ``label`` are read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editsieve.llm.common import settle
from editsieve.operators.scale import null_safe_join

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256

ASSIGNED = "vec_id long, label int, code string, error long"
PARTIAL = "part int, entry int, pos int, total long, n long"


def integer_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, label, v): kept rows with their components as ``floor(256 * x)``."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    kept = embeddings.where(F.col("embedding").isNotNull() & finite)
    return kept.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("int").alias("label"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("long")).alias("v"),
    )


def first_codebooks(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> np.ndarray | None:
    """Codebooks (parts, entries, width) from the kept vectors of the smallest ids; None if nothing is kept."""
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), F.col("v")).limit(entries).select("v").collect()
    if not first:
        return None
    dim = len(first[0][0])
    rows = np.array([r[0] for r in first], dtype=np.int64)
    return rows.reshape(len(rows), parts, dim // parts).transpose(1, 0, 2).copy()


def part_distances(x: np.ndarray, books: np.ndarray) -> np.ndarray:
    """(n, parts, entries) squared distances by value dictionaries: one table per dimension, gathered by value codes."""
    n, parts, width = x.shape
    out = np.zeros((n, parts, books.shape[1]), dtype=np.int64)
    for p in range(parts):
        for j in range(width):
            values, codes = np.unique(x[:, p, j], return_inverse=True)
            table = (values[:, None] - books[p, :, j][None, :]) ** 2
            out[:, p, :] += table[codes]
    return out


def _batches(books: np.ndarray, dim: int) -> Iterator[tuple[pd.DataFrame, np.ndarray, np.ndarray]]:
    parts, _, width = books.shape

    def frames(batches: Iterator[pd.DataFrame]):
        for pdf in batches:
            ok = pdf["v"].map(len).to_numpy() == dim
            pdf = pdf[ok]
            if pdf.empty:
                continue
            x = np.stack(pdf["v"].to_numpy()).astype(np.int64).reshape(len(pdf), parts, width)
            dist = part_distances(x, books)
            yield pdf, x, dist

    return frames


def _sums(books: np.ndarray, dim: int):
    frames = _batches(books, dim)
    parts, entries, width = books.shape

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, x, dist in frames(batches):
            nearest = dist.argmin(axis=2)
            for p in range(parts):
                count = np.bincount(nearest[:, p], minlength=entries)
                used = np.nonzero(count)[0]
                totals = np.zeros((entries, width), dtype=np.int64)
                np.add.at(totals, nearest[:, p], x[:, p, :])
                yield pd.DataFrame({
                    "part": np.full(len(used) * width, p, dtype=np.int32),
                    "entry": np.repeat(used, width).astype(np.int32),
                    "pos": np.tile(np.arange(width, dtype=np.int32), len(used)),
                    "total": totals[used].reshape(-1),
                    "n": np.repeat(count[used], width).astype(np.int64),
                })

    return run


def _assign(books: np.ndarray, dim: int):
    frames = _batches(books, dim)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf, _, dist in frames(batches):
            nearest = dist.argmin(axis=2)
            error = np.take_along_axis(dist, nearest[:, :, None], axis=2)[:, :, 0].sum(axis=1)
            codes = ["".join(f"{c:02x}" for c in row) for row in nearest.tolist()]
            yield pd.DataFrame({"vec_id": pdf["vec_id"].to_numpy(), "label": pdf["label"].to_numpy(), "code": codes, "error": error})

    return run


def of_common_length(vectors: DataFrame, parts: int = PARTS) -> DataFrame:
    """Vectors of the length of the smallest kept id, if that length is a positive multiple of ``parts``; else none."""
    head = vectors.orderBy(F.col("vec_id").asc_nulls_last(), F.col("v")).select(F.size("v")).limit(1).collect()
    dim = head[0][0] if head else 0
    if dim <= 0 or dim % parts:
        return vectors.where(F.lit(False))
    return vectors.where(F.size("v") == dim)


def train_codebooks(vectors: DataFrame, rounds: int = ROUNDS, parts: int = PARTS, entries: int = ENTRIES) -> np.ndarray | None:
    """Codebooks after ``rounds`` rounds of assignment and update; each round is one distributed pass.

    ``vectors`` are of one length (``of_common_length``).
    """
    books = first_codebooks(vectors, parts, entries)
    if books is None:
        return None
    dim = books.shape[0] * books.shape[2]
    for _ in range(rounds):
        partial = vectors.select("vec_id", "label", "v").mapInPandas(_sums(books, dim), PARTIAL)
        moved = partial.groupBy("part", "entry", "pos").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect()
        books = books.copy()
        for r in moved:  # at most parts * entries * width rows
            books[r["part"], r["entry"], r["pos"]] = r["total"] // r["n"]
    return books


def codebook_digest(books: np.ndarray) -> str:
    """SHA-256 of all entries' components by part, entry and position, ``,``-joined in decimal."""
    return hashlib.sha256(",".join(str(int(v)) for v in books.reshape(-1)).encode()).hexdigest()


def compress_vectors(spark: SparkSession, embeddings: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 for every kept vector (contract of ``op11``)."""
    vectors = of_common_length(integer_vectors(embeddings))
    books = train_codebooks(vectors)
    if books is None:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    dim = books.shape[0] * books.shape[2]
    coded = settle(vectors.mapInPandas(_assign(books, dim), ASSIGNED), "vector-codes")
    per_label = settle(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "vector-label-error")
    out = null_safe_join(coded, per_label, ["label"], "left")
    return out.select("vec_id", "code", "error", "label_error", F.lit(codebook_digest(books)).alias("codebooks_sha256"))
