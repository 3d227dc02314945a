"""Best-fit packing with certified bin counts.

Documents become token ids plus an end id. Only those longer than a sequence are cut, in pieces of
full length with the remainder first. The pieces are dealt to partitions of bounded size; each packs
its pieces by best-fit decreasing and proves, with dual feasible functions, how few sequences any packing
of its pieces needs. A partition that meets its bound is done. Those with a gap release the pieces of
their unfilled sequences; these are dealt anew among the partitions with gaps and packed again, and a round
counts only if it saves sequences.

Defined results: null and empty texts are one piece with just the end id; equal rows are packed each; an
empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editsieve.llm.bpe import PieceEncoder, tokenizer_path
from editsieve.llm.common import id_text, settle

CAPACITY = 2048
END_ID = 0
# Pieces packed together by one task.
PIECES_PER_PARTITION = 50_000
ROUNDS = 3
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = PIECE + ", part long, bin long, fill long, offset long, bound long, bins long"


def cut_points(n: int, capacity: int) -> list[int]:
    """Starts of the pieces of ``n`` tokens: a remainder first, then full pieces."""
    first = n % capacity or min(n, capacity)
    return [0, *range(first, n, capacity)]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        enc = PieceEncoder.of(tokenizer)
        for batch in batches:
            out = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), enc.stream(batch.column("text"))):
                ids += end
                starts = cut_points(len(ids) // 4, capacity)
                for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids) // 4])):
                    out.append((doc_id, k, a, b - a, zlib.crc32(ids[4 * a : 4 * b])))
            cols = list(zip(*out)) if out else [[]] * 5
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, types)], names=["doc_id", "piece", "start", "length", "ids_crc32"]
            )

    return id_text(docs).mapInArrow(run, PIECE)


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Fewest bins any packing can need, by two families of dual feasible functions.

    A dual feasible function maps sizes to weights such that no set of pieces that fits a bin weighs
    over 1, so the total weight bounds the number of bins from below. First family (one per
    threshold): pieces above ``capacity - t`` weigh 1, those below ``t`` nothing, others their share. Second family
    (one per k): the share is rounded down to k-ths of ``(k + 1) * size / capacity``, and kept where that
    is a whole number.
    """
    if not len(lengths):
        return 0
    sizes, n = np.unique(np.asarray(lengths, dtype=np.int64), return_counts=True)
    best = ceil(int((sizes * n).sum()) / capacity)
    for t in np.unique(np.minimum(sizes, capacity - sizes)):
        if 0 < t <= capacity // 2:
            big = int(n[sizes > capacity - t].sum())
            mid = (sizes >= t) & (sizes <= capacity - t)
            best = max(best, big + ceil(int((sizes[mid] * n[mid]).sum()) / capacity))
    for k in range(1, 33):
        whole = (sizes * (k + 1)) % capacity == 0
        # Weights times k * capacity, so that the sum stays exact.
        weight = np.where(whole, sizes * k, ((sizes * (k + 1)) // capacity) * capacity)
        best = max(best, ceil(int((weight * n).sum()) / (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Bin and offset of each piece, and the fill of each bin.

    The room left in open bins is a bit set: shifting it and taking the lowest bit finds the
    tightest bin that still fits in one step.
    """
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64)
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    fill: list[int] = []
    mask = 0
    for i in order.tolist():
        size = int(lengths[i])
        fits = mask >> size
        if fits:
            left = size + (fits & -fits).bit_length() - 1
            b = room[left].pop()
            if not room[left]:
                mask ^= 1 << left
        else:
            left, b = capacity, len(fill)
            fill.append(0)
        bins[i], offsets[i] = b, fill[b]
        fill[b] += size
        rest = left - size
        if rest:
            room[rest].append(b)
            mask |= 1 << rest
    return bins, offsets, fill


def pack_parts(dealt: DataFrame, capacity: int) -> DataFrame:
    """Pack each ``part`` on its own; adds bin, fill, offset and the part's bound and bin count."""

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        # A fixed order, so that a repeated task places every piece where it was.
        part = part.sort_values(["length", "doc_id", "piece", "start", "ids_crc32"], ascending=False, kind="stable")
        lengths = part["length"].to_numpy()
        bins, offsets, fill = best_fit_decreasing(lengths, capacity)
        return part.assign(
            bin=bins, fill=np.asarray(fill, dtype=np.int64)[bins], offset=offsets,
            bound=lower_bound(lengths, capacity), bins=len(fill),
        )

    return dealt.groupBy("part").applyInPandas(pack, PLACED)


def _deal(rows: DataFrame, n: int, per_part: int, first_part: int, seed: int) -> DataFrame:
    """Parts of about ``per_part`` rows. Row numbers of a written table spread equal rows as well."""
    parts = max(1, ceil(n / per_part))
    at = F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.lit(seed)), F.lit(parts))
    return rows.select("doc_id", "piece", "start", "length", "ids_crc32", (at + F.lit(first_part)).alias("part"))


def _bins(placed: DataFrame) -> int:
    return placed.agg(F.coalesce(F.sum((F.col("offset") == 0).cast("long")), F.lit(0))).first()[0]


def pack(items: DataFrame, capacity: int = CAPACITY, per_part: int = PIECES_PER_PARTITION, rounds: int = ROUNDS) -> DataFrame:
    """Place all ``items``: adds part, bin, fill, offset, bound and bins (of the part that placed it)."""
    items = settle(items, "pieces")
    n = items.count()
    done: list[DataFrame] = []
    current = settle(pack_parts(_deal(items, n, per_part, 0, 0), capacity), "packed")
    first_part = max(1, ceil(n / per_part))
    for r in range(1, rounds + 1):
        loose = (F.col("bins") > F.col("bound")) & (F.col("fill") < capacity)
        released = settle(current.where(loose), "released")
        n = released.count()
        if not n:
            break
        again = settle(pack_parts(_deal(released, n, per_part, first_part, r), capacity), "repacked")
        first_part += max(1, ceil(n / per_part))
        if _bins(again) >= _bins(released):
            break
        done.append(current.where(~loose))
        current = again
    for kept in done:
        current = current.unionByName(kept)
    return current


def packed_documents(spark: SparkSession, docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents with the sequence each lies in and its place there."""
    placed = pack(pieces(docs, tokenizer or tokenizer_path("byte_bpe_50k.json"), capacity), capacity)
    sequence = F.shiftleft(F.col("part"), 32) + F.col("bin")
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", sequence.alias("sequence_id"), "offset")
