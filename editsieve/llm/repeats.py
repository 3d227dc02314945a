"""Repeated byte strings across documents, by common-prefix interval trees over sparse suffix arrays.

A byte goes if it lies in a string of ``window`` bytes that also starts anywhere else. Sorting every suffix of
the corpus is out of reach, and not needed:

1. Anchors. Every window has one anchor, the leftmost smallest hash of its ``core``-byte strings. Equal windows have
   equal anchors at equal places, so only positions that are anchors need to be compared: about one in 150.
2. Anchors whose core occurs once are done. Of the others the context is looked at: the bytes around the
   anchor that any of its windows can reach. Occurrences with equal contexts are decided by counting digests,
   without moving text, however many they are.
3. One occurrence of each distinct context, in groups with several, goes to an enhanced suffix array: the suffixes
   that start at the anchors are sorted, and a scan with a stack over their common prefixes visits the prefix
   intervals from deep to shallow. Each interval holds all occurrences of a string that cannot be extended to the right. Where
   its parts meet, the left contexts are compared in sorted order: how far they agree is how far
   the repeat extends to the left, and where they differ (left diversity) it is maximal.
   Groups beyond ``crowded`` contexts are split in blocks, and each pair of blocks is scanned by itself.
4. The spans of a document are merged and cut out.

``remove_passages`` also cuts what repeats for ``PASSAGE`` words, however few bytes they have: the same search runs over the words, each as a
hash of ``WORD_BYTES`` bytes, so a window is a number of words.

Defined results: null is empty; texts shorter than the window lose nothing; equal rows are copies of each other and
lose the same; a removed run may cut a character in two: the digest rows take the remaining bytes as they are, and
``remove_repeats`` drops bytes that are no longer UTF-8; an empty table gives no row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from editsieve.llm.common import settle, shuffle_width

WINDOW, CORE = 400, 100
# Words of the shortest passage of over 50 words, of its cores, and the bytes that stand for a word.
PASSAGE, PASSAGE_CORE, WORD_BYTES = 51, 13, 4
# Contexts of one anchor from which its group is split, and the size of the blocks.
CROWDED, BLOCK = 8192, 4096
# Bytes hashed at a time, so that memory does not depend on the length of a text.
SEGMENT = 1 << 18
# Contexts resolved together in a task.
TOGETHER = 4096

ANCHOR = "k1 long, k2 long, pos int, right int, g long, ctx long"
SPAN = "k1 long, k2 long, lo int, hi int"
SPANS = "array<struct<lo:int,hi:int>>"


# --- anchors ---------------------------------------------------------------------------------------

class AnchorFinder:
    """Positions and core hashes of the anchors of a text."""

    def __init__(self, window: int = WINDOW, core: int = CORE):
        self.window, self.core, self.width = window, core, window - core + 1
        rng = np.random.default_rng(20240229)
        self.letters = rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        base = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
        self.power = self._powers(base)
        self.back = self._powers(pow(base, -1, 1 << 64))

    def _powers(self, base: int) -> np.ndarray:
        factors = np.full(SEGMENT + self.window + 2, base, dtype=np.uint64)
        factors[0] = 1
        return np.cumprod(factors, dtype=np.uint64)

    def _core_hashes(self, data: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(self.letters[data] * self.power[: len(data)], out=sums[1:])
        h = (sums[self.core :] - sums[: -self.core]) * self.back[: len(data) - self.core + 1]
        # The low bits of such sums are weak: mix.
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
        return h

    def _segment(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h, w = self._core_hashes(data), self.width
        bits = np.uint64((1 << 20) - 1)
        # Position in the low bits: the smallest value is the leftmost smallest hash.
        v = (h & ~bits) | np.arange(len(h), dtype=np.uint64)
        blocks = -(-len(v) // w)
        grid = np.full(blocks * w, np.iinfo(np.uint64).max, dtype=np.uint64)
        grid[: len(v)] = v
        grid = grid.reshape(blocks, w)
        ahead = np.minimum.accumulate(grid, axis=1).ravel()
        behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        n = len(v) - w + 1
        low = np.minimum(behind[:n], ahead[w - 1 : w - 1 + n])
        # Minima of consecutive windows come in runs.
        change = np.concatenate(([True], low[1:] != low[:-1]))
        at = np.unique((low[change] & bits).astype(np.int64))
        return at, h[at]

    def find(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        if len(text) < self.window:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
        data = np.frombuffer(text, dtype=np.uint8)
        found = []
        for s in range(0, len(data) - self.window + 1, SEGMENT):
            at, h = self._segment(data[s : s + SEGMENT + self.window - 1])
            found.append((at + s, h))
        if len(found) == 1:
            return found[0]
        at, first = np.unique(np.concatenate([a for a, _ in found]), return_index=True)
        return at, np.concatenate([h for _, h in found])[first]


_FINDERS: dict[tuple[int, int], AnchorFinder] = {}


def _finder(window: int, core: int) -> AnchorFinder:
    if (window, core) not in _FINDERS:
        _FINDERS[window, core] = AnchorFinder(window, core)
    return _FINDERS[window, core]


def _keyed(docs: DataFrame, *more: Column) -> DataFrame:
    """Two 64-bit keys tell rows apart by id and text; the text as UTF-8 bytes."""
    body = F.coalesce("text", F.lit(""))
    return docs.select(
        F.xxhash64(body, "doc_id").alias("k1"), F.xxhash64(F.lit(1), "doc_id", body).alias("k2"),
        body.cast("binary").alias("bytes"), *more,
    )


def word_bytes(text: bytes) -> bytes:
    """The text with each word as a hash of ``WORD_BYTES`` bytes and nothing between."""
    import xxhash

    return b"".join(map(xxhash.xxh32_digest, text.split()))


def _keyed_words(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            stream = pa.array([word_bytes(t.as_py()) for t in batch.column("bytes")], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("k1"), batch.column("k2"), stream], names=["k1", "k2", "bytes"])

    return _keyed(docs).mapInArrow(run, "k1 long, k2 long, bytes binary")


def anchors(docs: DataFrame, window: int = WINDOW, core: int = CORE, words: bool = False) -> DataFrame:
    """(k1, k2, pos, right, g, ctx): the anchors, the hash of the core and the digest of the context.

    ``words``: of the ``word_bytes``, made in the same worker, as a second one per task would have its own memory.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        finder, reach = _finder(window, core), window - core
        for batch in batches:
            k1, k2 = batch.column("k1").to_numpy(), batch.column("k2").to_numpy()
            rows, ats, rights, gs, ctx = [], [], [], [], []
            for i, value in enumerate(batch.column("bytes")):
                text = word_bytes(value.as_py()) if words else value.as_py()
                at, g = finder.find(text)
                if not len(at):
                    continue
                rows.append(np.full(len(at), i))
                ats.append(at)
                rights.append(np.minimum(len(text) - at, window))
                gs.append(g.view(np.int64))
                for p in at.tolist():
                    left = p if p < reach else reach
                    ctx.append(hashlib.blake2b(text[p - left : p + window], digest_size=8, salt=left.to_bytes(2)).digest())
            if not rows:
                continue
            row = np.concatenate(rows)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(k1[row]), pa.array(k2[row]), pa.array(np.concatenate(ats).astype(np.int32)),
                    pa.array(np.concatenate(rights).astype(np.int32)), pa.array(np.concatenate(gs)),
                    pa.array(np.frombuffer(b"".join(ctx), dtype=np.int64)),
                ],
                names=["k1", "k2", "pos", "right", "g", "ctx"],
            )

    return _keyed(docs).select("k1", "k2", "bytes").mapInArrow(run, ANCHOR)


# --- interval tree --------------------------------------------------------------------------------

def _common(rows: np.ndarray, lengths: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of padded byte rows a[i] and b[i]."""
    out = np.empty(len(a), dtype=np.int64)
    for s in range(0, len(a), 8192):
        x, y = a[s : s + 8192], b[s : s + 8192]
        differ = rows[x] != rows[y]
        first = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
        out[s : s + 8192] = np.minimum(first, np.minimum(lengths[x], lengths[y]))
    return out


def _padded(parts: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(p.ljust(width, b"\0") for p in parts), dtype=np.uint8).reshape(len(parts), width)


def prefix_intervals(common: list[int], least: int) -> Iterator[tuple[int, list[list[int]]]]:
    """(depth, parts) of each common-prefix interval of at least ``least`` bytes, deep ones first.

    ``common[i]`` is the common prefix of suffixes i and i + 1 in sorted order, -1 between groups. ``parts`` are the
    suffixes (numbers in sorted order) of the intervals just below, so their union is all occurrences.
    """
    stack: list[tuple[int, list[list[int]]]] = []
    for i in range(len(common) + 1):
        low = common[i] if i < len(common) else -1
        node = [i]
        while stack and stack[-1][0] > low:
            depth, parts = stack.pop()
            parts.append(node)
            yield depth, parts
            node = [x for p in parts for x in p]
        if low >= least:
            if stack and stack[-1][0] == low:
                stack[-1][1].append(node)
            else:
                stack.append((low, [node]))


def context_spans(
    group: list[int], left: list[bytes], right: list[bytes], window: int = WINDOW, core: int = CORE
) -> tuple[np.ndarray, np.ndarray]:
    """How far repeats of at least ``window`` bytes reach to the left and right of each anchor; 0, 0: none.

    Contexts with the same ``group`` have their anchors on equal cores. Within a group they are distinct.
    """
    n, reach = len(group), window - core
    far_left, far_right = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    if n < 2:
        return far_left, far_right
    back = [x[::-1] for x in left]
    by_right = sorted(range(n), key=lambda i: (group[i], right[i]))
    by_left = sorted(range(n), key=lambda i: (group[i], back[i]))
    rank = np.empty(n, dtype=np.int64)
    rank[by_left] = np.arange(n)
    right_len, back_len = np.array([len(x) for x in right]), np.array([len(x) for x in back])
    order, groups = np.array(by_right), np.array(group)
    common = _common(_padded(right, window), right_len, order[:-1], order[1:])
    common[groups[order[:-1]] != groups[order[1:]]] = -1
    ranks = rank[order].tolist()
    pair_a, pair_b, pair_depth = [], [], []
    for depth, parts in prefix_intervals(common.tolist(), core):
        # Occurrences in the order of their left contexts: where neighbours come from different parts they meet here
        # for the first time, and no other pair from different parts agrees further to the left.
        line = sorted((ranks[x], k) for k, part in enumerate(parts) for x in part)
        for (r, k), (s, m) in zip(line, line[1:]):
            if k != m:
                pair_a.append(r)
                pair_b.append(s)
                pair_depth.append(depth)
    if not pair_a:
        return far_left, far_right
    left_order = np.array(by_left)
    a, b, depth = left_order[pair_a], left_order[pair_b], np.array(pair_depth)
    agree = _common(_padded(back, reach), back_len, a, b)
    long = agree + depth >= window
    for side in (a[long], b[long]):
        np.maximum.at(far_left, side, agree[long])
        np.maximum.at(far_right, side, depth[long])
    return far_left, far_right


def resolve(contexts: DataFrame, window: int = WINDOW, core: int = CORE) -> DataFrame:
    """Spans of the distinct contexts (g, unit, k1, k2, pos, left, right), group by group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        held: list[tuple] = []

        def flush(rows: list[tuple]) -> Iterable[pa.RecordBatch]:
            names: dict[tuple, int] = {}
            group = [names.setdefault(r[:2], len(names)) for r in rows]
            far_left, far_right = context_spans(group, [r[5] for r in rows], [r[6] for r in rows], window, core)
            hit = np.nonzero(far_right)[0]
            pos = np.array([rows[i][4] for i in hit], dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([rows[i][2] for i in hit], pa.int64()), pa.array([rows[i][3] for i in hit], pa.int64()),
                    pa.array((pos - far_left[hit]).astype(np.int32)), pa.array((pos + far_right[hit]).astype(np.int32)),
                ],
                names=["k1", "k2", "lo", "hi"],
            )

        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(at, TOGETHER)
                held.extend(zip(*(c.to_pylist() for c in part.columns)))
                if len(held) >= TOGETHER:
                    cut = len(held)
                    while cut and held[cut - 1][:2] == held[-1][:2]:
                        cut -= 1
                    if cut:
                        yield from flush(held[:cut])
                        held = held[cut:]
        if held:
            yield from flush(held)

    width = shuffle_width(contexts.sparkSession)
    ordered = contexts.select("g", "unit", "k1", "k2", "pos", "left", "right")
    return ordered.repartition(width, "g", "unit").sortWithinPartitions("g", "unit").mapInArrow(run, SPAN)


# --- the whole --------------------------------------------------------------------------------------

def repeat_spans(docs: DataFrame, window: int = WINDOW, core: int = CORE, crowded: int = CROWDED, block: int = BLOCK) -> DataFrame:
    """(k1, k2, spans): the repeated byte ranges of each document that has some, not yet merged."""
    return _spans(docs, window, core, crowded, block)


def word_spans(docs: DataFrame, words: int = PASSAGE, core: int = PASSAGE_CORE, crowded: int = CROWDED, block: int = BLOCK) -> DataFrame:
    """(k1, k2, word_spans): the same in bytes of ``word_bytes``, for repeats of ``words`` words."""
    return _spans(docs, words * WORD_BYTES, core * WORD_BYTES, crowded, block, True).withColumnRenamed("spans", "word_spans")


def _spans(docs: DataFrame, window: int, core: int, crowded: int, block: int, words: bool = False) -> DataFrame:
    reach = window - core
    found = settle(anchors(docs, window, core, words), "anchors")
    often = found.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.min("ctx").alias("a"), F.max("ctx").alias("b")).where("n > 1")
    lo = F.greatest(F.col("pos") - F.lit(reach), F.lit(0))
    # Written first: then the join has an exchange of its own on both sides, and a core that fills a large
    # share of all anchors is split by the planner.
    often = settle(often.select("g", (F.col("a") != F.col("b")).alias("mixed")), "often")
    shared = found.join(often, "g")
    shared = settle(shared.withColumn("lo", lo).withColumn("hi", F.col("pos") + F.col("right")), "shared-anchors")
    whole = F.col("hi") - F.col("lo") >= window
    plain = shared.where(~F.col("mixed") & whole).select("k1", "k2", "lo", "hi")
    mixed = shared.where("mixed")
    one = F.min(F.struct("k1", "k2", "pos", "lo", "hi")).alias("o")
    contexts = settle(mixed.groupBy("g", "ctx").agg(F.count(F.lit(1)).alias("n"), one).select("g", "ctx", "n", "o.*"), "contexts")
    copied = contexts.where("n > 1").select("g", "ctx")
    counted = mixed.where(whole).join(copied, ["g", "ctx"], "left_semi").select("k1", "k2", "lo", "hi")
    sizes = contexts.groupBy("g").agg(F.count(F.lit(1)).alias("size"))
    blocks = F.when(F.col("size") > crowded, F.ceil(F.col("size") / block)).otherwise(1).cast("int")
    wanted = contexts.join(sizes, "g").select("g", "k1", "k2", "pos", "lo", "hi", blocks.alias("blocks"))
    # Per document, so that a text is looked up once.
    per_doc = wanted.groupBy("k1", "k2").agg(F.collect_list(F.struct("g", "pos", "lo", "hi", "blocks")).alias("at"))
    around = F.transform(
        "at",
        lambda a: F.struct(
            a["g"].alias("g"), a["pos"].alias("pos"), a["blocks"].alias("blocks"),
            F.substring(F.col("bytes"), a["lo"] + 1, a["pos"] - a["lo"]).alias("left"),
            F.substring(F.col("bytes"), a["pos"] + 1, a["hi"] - a["pos"]).alias("right"),
        ),
    )
    texts = (_keyed_words(docs) if words else _keyed(docs)).join(per_doc.hint("shuffle_hash"), ["k1", "k2"]).select("k1", "k2", around.alias("around"))
    cut = texts.select("k1", "k2", F.explode("around").alias("c")).select("k1", "k2", "c.*")
    own = F.pmod(F.xxhash64("k1", "k2", "pos"), F.col("blocks")).cast("int")
    partner = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.least(o, F.col("own")).cast("long") * F.lit(1 << 32) + F.greatest(o, F.col("own")))
    units = cut.withColumn("own", own).withColumn("unit", F.explode(partner))
    sorted_out = resolve(units, window, core)
    spans = plain.unionByName(counted).unionByName(sorted_out)
    return spans.groupBy("k1", "k2").agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))


def merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Maximal runs of overlapping or touching ranges."""
    out: list[list[int]] = []
    for lo, hi in sorted((s["lo"], s["hi"]) for s in spans or ()):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(a, b) for a, b in out]


def kept_bytes(text: bytes, runs: list[tuple[int, int]]) -> bytes:
    ends = [0, *(b for _, b in runs)]
    return b"".join(text[a:b] for a, b in zip(ends, [*(a for a, _ in runs), len(text)]))


def repeat_report(spark: SparkSession, docs: DataFrame, window: int = WINDOW, core: int = CORE, texts: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document; ``texts`` adds what remains as ``text``.

    The digest is that of the remaining bytes as they are; ``text`` drops those that are no longer UTF-8, as ``remove_repeats`` does.
    """
    spans = settle(repeat_spans(docs, window, core), "spans")
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["text"] if texts else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, value, own in zip(batch.column("doc_id").to_pylist(), batch.column("bytes"), batch.column("spans")):
                text, runs = value.as_py(), merged(own.as_py())
                kept = kept_bytes(text, runs)
                digest = hashlib.sha256(kept).hexdigest()
                row = (doc_id, len(text), sum(b - a for a, b in runs), len(runs), digest)
                out.append((*row, kept.decode("utf-8", "ignore")) if texts else row)
            if out:
                types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())[: len(names)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), types)], names=names,
                )

    joined = _keyed(docs, F.col("doc_id")).join(spans.hint("shuffle_hash"), ["k1", "k2"], "left")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", text string" if texts else "")
    return joined.select("doc_id", "bytes", "spans").mapInArrow(run, schema)


def passages(text: bytes, spans: list[dict] | None, words: int = PASSAGE) -> list[dict]:
    """Byte ranges of the whole words in spans of ``word_bytes``; those of fewer than ``words`` words are no passage."""
    whole = [(-(-s["lo"] // WORD_BYTES), s["hi"] // WORD_BYTES) for s in spans or ()]
    whole = [(a, b) for a, b in whole if b - a >= words]
    if not whole:
        return []
    tokens = text.split()
    ends, at = [], 0
    for token in tokens:
        at = text.index(token, at) + len(token)
        ends.append(at)
    return [{"lo": ends[a] - len(tokens[a]), "hi": ends[b - 1]} for a, b in whole]


def remove_repeats(docs: DataFrame, window: int = WINDOW, core: int = CORE) -> DataFrame:
    """``docs`` with the repeated bytes cut out of ``text`` (and ``n_chars`` set anew, where there is one)."""
    return _without(docs, settle(repeat_spans(docs, window, core).withColumn("word_spans", F.lit(None).cast(SPANS)), "spans"), PASSAGE)


def remove_passages(docs: DataFrame, words: int = PASSAGE, core: int = PASSAGE_CORE) -> DataFrame:
    """``docs`` without what ``remove_repeats`` cuts and without repeats of ``words`` words, of however many bytes."""
    of_bytes, of_words = settle(repeat_spans(docs), "spans"), settle(word_spans(docs, words, core), "word-spans")
    return _without(docs, settle(of_bytes.join(of_words, ["k1", "k2"], "full"), "all-spans"), words)


def _without(docs: DataFrame, spans: DataFrame, words: int) -> DataFrame:
    """``docs`` without the (k1, k2, spans, word_spans) in ``text``."""

    def cut_out(text: bytes, own: list[dict] | None, own_words: list[dict] | None) -> str:
        runs = merged([*(own or ()), *passages(text, own_words, words)])
        return kept_bytes(text, runs).decode("utf-8", "ignore") if runs else text.decode("utf-8")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            columns = (batch.column(c) for c in ("bytes", "spans", "word_spans"))
            texts = [cut_out(*(v.as_py() for v in values)) for values in zip(*columns)]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), batch.column("row")], names=["text", "row"])

    others = [c for c in docs.columns if c != "text"]
    row = F.struct(*(F.col("`" + c.replace("`", "``") + "`") for c in others)).alias("row")
    joined = _keyed(docs, row).join(spans.hint("shuffle_hash"), ["k1", "k2"], "left").select("bytes", "spans", "word_spans", "row")
    out = T.StructType([T.StructField("text", T.StringType()), T.StructField("row", joined.schema["row"].dataType)])
    cut = joined.mapInArrow(run, out)
    new_length = F.length("text").cast(docs.schema["n_chars"].dataType) if "n_chars" in others else None
    fresh = {"text": F.col("text"), "n_chars": new_length}
    return cut.select(*(fresh[c].alias(c) if fresh.get(c) is not None else F.col("row.`" + c.replace("`", "``") + "`") for c in docs.columns))
