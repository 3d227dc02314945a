"""SimHash near-duplicates by multi-index hashing.

A fingerprint is cut into segments. If two fingerprints differ in at most ``radius`` bits, then in at
least one segment they differ in no more than that segment's share (the shares plus one add up to
more than the radius). So each fingerprint enumerates, per segment, the values within that small
Hamming ball, fetches the fingerprints stored under them, and the join condition compares the full distance.

Only distinct fingerprints take part; copies hang on theirs. A segment value under which very many
distinct fingerprints lie (a family of near copies) would make the square of them in candidates.
Such buckets are split in blocks, and each pair of blocks gives just the links of a spanning forest, found by a
search that never compares what it has reached. No link between components is lost by that.

Crowded values come first: what they connect is one component, and the search under all other values gives only links
between different components. So a family that fills some values and lies scattered around them gives no square either.

Choose ``segments`` such that a segment has about log2(distinct fingerprints) bits: 3 up to some hundred
million, 2 beyond. The result does not depend on it.

``keep_one`` drops copies and near copies by this search. For near copies take ``NEAR``: shingles of two words, of which an edited word spoils fewer,
and a radius of 7 bits in four segments, each searched in a ball of one bit. Few shingles leave many bits at zero, and that alone would
make fingerprints near, so texts of fewer than ``short`` words are near only if their words are the same.

``keep_one_similar`` drops near copies by the Jaccard similarity of their word shingles. At a similarity of 0.8 about one bit in seven differs, out of
reach of small Hamming balls, so it takes 512 bits instead and many overlapping bands of them (``band_plan``). A pair that
shares a band value is a candidate, and counts if the texts, taken from the table, have the similarity.
Under a value with more than ``FAMILY`` texts all are first held against the least of them; then those that are outside the
largest component there are held against all. Nothing is lost by that: the others are linked already.

Defined results: null, empty and blank texts have fingerprint zero; null ids are kept but are never a
component's id unless it has no other; equal rows are returned each; an empty table gives no row.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from editsieve.llm.common import id_text, settle
from editsieve.llm.components import components

WORDS, RADIUS, SEGMENTS, SEED = 4, 4, 3, 42
# Near copies: words of a shingle, radius, segments, and the words from which a text has a fingerprint of its shingles.
NEAR = {"words": 2, "radius": 7, "segments": 4, "short": 16}
# Distinct fingerprints under one segment value from which it is split.
CROWDED = 256
BLOCK = 4096
# Near copies: shingles of so many words, Jaccard similarity, and the share of pairs of just that similarity that may be missed.
SIMILAR_WORDS, SIMILAR, MISSED = 5, 0.8, 0.01
# 64-bit words of the wide fingerprint; the first one is the check of a candidate, the others give the bands.
WIDE = 8
# Bits of the first word in which candidates may differ: over three standard deviations above what the similarity gives.
CHECK_BITS = 20
# Texts under one band value from which not all pairs are candidates.
FAMILY = 32


def shingle_digests(text: bytes, words: int) -> np.ndarray:
    """Hashes of the word shingles of a UTF-8 text, as bytes one after the other."""
    import xxhash

    tokens = text.lower().split()  # on bytes: A-Z and ASCII white space only
    if not tokens:
        return np.empty(0, dtype=np.uint8)
    line = b" ".join(tokens)
    size = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
    ends = np.cumsum(size + 1) - 1
    n = max(1, len(tokens) - words + 1)
    first, last = (ends - size)[:n].tolist(), ends[-n:].tolist()
    digest = xxhash.xxh64_digest
    return np.frombuffer(b"".join([digest(line[a:b], SEED) for a, b in zip(first, last)]), dtype=np.uint8)


def fingerprint(text: bytes, words: int = WORDS, short: int = 0) -> int:
    """64-bit SimHash of the word shingles of a UTF-8 text, as a signed integer; below ``short`` words the hash of them all."""
    hashes = shingle_digests(text, words)
    n = len(hashes) // 8
    if not n:
        return 0
    if n + words - 1 < short:
        return int(shingle_digests(text, short).view(">i8")[0])
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 1 << 16):
        part = hashes[8 * at : 8 * (at + (1 << 16))].reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n).view(">i8")[0])


def fingerprints(docs: DataFrame, words: int = WORDS, keys: tuple[str, ...] = (), short: int = 0) -> DataFrame:
    """(doc_id, fp, *keys); ``keys`` are long columns of ``docs`` carried along."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_py(), words, short) for t in batch.column("bytes")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(fps, pa.int64()), *(batch.column(k) for k in keys)],
                names=["doc_id", "fp", *keys],
            )

    source = docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("bytes"), *keys)
    return source.mapInArrow(run, ", ".join(["doc_id long", "fp long", *(f"{k} long" for k in keys)]))


def segment_plan(radius: int, segments: int) -> list[tuple[int, int, int]]:
    """(shift, width, share of the radius) of each segment."""
    edges = [round(64 * i / segments) for i in range(segments + 1)]
    spare = max(0, radius + 1 - segments)
    shares = [spare // segments + (i < spare % segments) for i in range(segments)]
    return [(a, b - a, s) for a, b, s in zip(edges, edges[1:], shares)]


def ball(width: int, share: int) -> list[int]:
    """All values of ``width`` bits with at most ``share`` ones: what to flip to walk the ball."""
    return [sum(1 << b for b in bits) for k in range(share + 1) for bits in combinations(range(width), k)]


def _forest(radius: int):
    def links(block: pd.DataFrame) -> pd.DataFrame:
        left = np.sort(block["fp"].unique()).astype(np.int64).view(np.uint64)
        a, b = [], []
        while len(left):
            frontier, left = [left[0]], left[1:]
            while frontier and len(left):
                x = frontier.pop()
                near = np.bitwise_count(left ^ x) <= radius
                if near.any():
                    found = left[near]
                    frontier.extend(found)
                    a.extend([x] * len(found))
                    b.extend(found)
                    left = left[~near]
        both = np.array([a, b], dtype=np.uint64).view(np.int64)
        return pd.DataFrame({"a": both[0], "b": both[1]})

    return links


def near_links(fps: DataFrame, radius: int = RADIUS, segments: int = SEGMENTS, crowded: int = CROWDED, block: int = BLOCK) -> DataFrame:
    """Links (a, b) of distinct fingerprints ``fp`` within ``radius`` bits, enough to connect all that are linked.

    Every pair is emitted, except under crowded segment values, where a spanning forest is, and of what these forests connect already.
    """
    plan = segment_plan(radius, segments)

    def around(i: int, masks: list[int]) -> Column:
        shift, width, _ = plan[i]
        own = F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << width) - 1))
        flips = F.array(*(F.lit(m).cast("long") for m in masks))
        return F.transform(flips, lambda m: F.struct(F.lit(i).alias("seg"), own.bitwiseXOR(m).alias("value")))

    def values(reach: bool) -> Column:
        return F.concat(*(around(i, ball(width, share) if reach else [0]) for i, (_, width, share) in enumerate(plan)))

    def table(rows: DataFrame, reach: bool, name: str) -> DataFrame:
        more = [c for c in rows.columns if c != "fp"]
        at = rows.select("fp", *more, F.explode(values(reach)).alias("at"))
        return at.select("at.seg", "at.value", F.col("fp").alias(name), *(F.col(c).alias(f"{c}_{name}") for c in more))

    held = table(fps, False, "b")
    full = settle(held.groupBy("seg", "value").count().where(F.col("count") > crowded).select("seg", "value"), "crowded")
    # Crowded values: all that lie there or reach it, in blocks; each pair of blocks is one small group.
    inside = settle(table(fps, True, "a").join(full, ["seg", "value"], "left_semi"), "crowded-members")
    blocks = inside.groupBy("seg", "value").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("a"), F.col("blocks")).cast("int")
    others = F.transform(
        F.sequence(F.lit(0), F.greatest(F.col("blocks") - 1, F.lit(0))),
        lambda o: F.struct(F.least(o, F.col("own")).alias("i"), F.greatest(o, F.col("own")).alias("j")),
    )
    units = (
        inside.join(blocks, ["seg", "value"]).withColumn("own", own)
        .select("seg", "value", F.col("a").alias("fp"), F.explode(others).alias("u"))
        .select("seg", "value", "fp", "u.i", "u.j")
    )
    dense = settle(units.groupBy("seg", "value", "i", "j").applyInPandas(_forest(radius), "a long, b long"), "forests")
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
    if not dense.isEmpty():
        roots = settle(components(dense).withColumnRenamed("node", "fp"), "crowded-roots")
        fps = settle(fps.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "crowded-placed")
        apart = apart & (F.col("root_a") != F.col("root_b"))
    calm = table(fps, False, "b").join(full, ["seg", "value"], "left_anti")
    p, t = table(fps, True, "a").alias("p"), calm.alias("t")
    same = (F.col("p.seg") == F.col("t.seg")) & (F.col("p.value") == F.col("t.value"))
    sparse = p.join(t, same & (F.col("p.a") < F.col("t.b")) & apart).select("a", "b")
    return sparse.union(dense)


def linked(rows: DataFrame, radius: int = RADIUS, segments: int = SEGMENTS) -> DataFrame:
    """Adds ``root`` to (doc_id, fp, ...): one value per component."""
    fps = settle(rows.select("fp").distinct(), "fingerprints")
    roots = settle(components(near_links(fps, radius, segments)), "roots")
    return rows.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def simhash_components(spark: SparkSession, docs: DataFrame, words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint, component_id (smallest id reachable) of every document."""
    rows = settle(fingerprints(docs, words), "fingerprint-rows")
    own = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    placed = settle(linked(own, radius), "placed")
    named = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = settle(placed.join(named, "root").select("fp", "component_id"), "components")
    return rows.join(by_fp, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _with_keys(docs: DataFrame) -> DataFrame:
    """Text and all columns (``row``) with two 64-bit keys of id and text."""
    held = docs.select("doc_id", "text", F.struct(*(docs[c] for c in docs.columns)).alias("row"))
    body = F.coalesce("text", F.lit(""))
    return held.withColumn("k1", F.xxhash64(body, "doc_id")).withColumn("k2", F.xxhash64(F.lit(1), "doc_id", body))


def _one_of_each(keyed: DataFrame, placed: DataFrame) -> DataFrame:
    """The row of the smallest (id, content) of each ``root``, once."""
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k1", "k2"))
    winners = placed.groupBy("root").agg(best.alias("w")).select("w.k1", "w.k2")
    once = Window.partitionBy("k1", "k2").orderBy("k1")
    kept = keyed.select("k1", "k2", "row").join(settle(winners, "winners").distinct(), ["k1", "k2"])
    return kept.withColumn("n", F.row_number().over(once)).where("n = 1").select("row.*")


def keep_one(docs: DataFrame, words: int = WORDS, radius: int = RADIUS, segments: int = SEGMENTS, short: int = 0) -> DataFrame:
    """``docs`` without near-duplicates: the smallest (id, content) of each component stays, once.

    All columns of the input come back as they were.
    """
    keyed = _with_keys(docs)
    rows = settle(fingerprints(keyed, words, ("k1", "k2"), short), "fingerprint-rows")
    return _one_of_each(keyed, linked(rows, radius, segments))


# --- near copies by similarity ------------------------------------------------------------------

def band_plan(n_texts: int, least: float = SIMILAR, missed: float = MISSED) -> np.ndarray:
    """Bits of each band, one row per band.

    A band has about log2(texts) bits, so unrelated texts seldom meet; there are as many bands as a pair of just the similarity
    needs to share one.
    """
    width = min(32, max(16, math.ceil(math.log2(n_texts + 1))))
    differ = math.acos(2 * least / (1 + least)) / math.pi
    count = math.ceil(math.log(missed) / math.log1p(-((1 - differ) ** width)))
    rng = np.random.default_rng(20240229)
    return np.stack([64 + rng.choice(64 * (WIDE - 1), width, replace=False) for _ in range(count)])


def wide_bits(digests: np.ndarray) -> np.ndarray:
    """Bits of the wide fingerprint, from the hashes of the shingles."""
    h = digests.view("<u8")
    odd = np.random.default_rng(7).integers(1, 1 << 63, WIDE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    ones = np.zeros(64 * WIDE, dtype=np.int64)
    for at in range(0, len(h), 255):  # so that sums fit in a byte
        x = h[at : at + 255, None] * odd
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(29)
        ones += np.add.reduce(np.unpackbits(x.view(np.uint8), axis=1), axis=0, dtype=np.uint8)
    return 2 * ones > len(h)


def jaccard(a: bytes, b: bytes, words: int = SIMILAR_WORDS) -> float:
    x, y = (np.unique(shingle_digests(t, words).view("<u8")) for t in (a, b))
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / (len(x) + len(y) - both) if len(x) + len(y) else 1.0


def banded(docs: DataFrame, words: int, plan: np.ndarray) -> DataFrame:
    """(doc_id, k1, k2, node, fp, bands): ``node`` is the same for texts with the same words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        import xxhash

        places = np.int64(1) << np.arange(plan.shape[1], dtype=np.int64)
        numbers = np.arange(len(plan), dtype=np.int64) << np.int64(32)
        for batch in batches:
            nodes, fps, bands = [], [], []
            for value in batch.column("bytes"):
                text = value.as_py()
                bits = wide_bits(shingle_digests(text, words))
                nodes.append(xxhash.xxh64_intdigest(b" ".join(text.lower().split())))
                fps.append(np.packbits(bits[:64]).view("<i8")[0])
                bands.append((bits[plan] * places).sum(axis=1) + numbers)
            out = {
                "node": pa.array(np.array(nodes, dtype=np.uint64).view(np.int64)), "fp": pa.array(fps, pa.int64()),
                "bands": pa.array(bands, pa.list_(pa.int64())),
            }
            own = ("doc_id", "k1", "k2")
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in own), *out.values()], names=[*own, *out])

    source = docs.select("doc_id", "k1", "k2", F.coalesce("text", F.lit("")).cast("binary").alias("bytes"))
    return source.mapInArrow(run, "doc_id long, k1 long, k2 long, node long, fp long, bands array<long>")


def similar_links(pairs: DataFrame, rows: DataFrame, keyed: DataFrame, words: int, least: float) -> DataFrame:
    """The pairs (a, b) of nodes whose texts have the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            near = [jaccard(x.as_py(), y.as_py(), words) >= least for x, y in zip(batch.column("x"), batch.column("y"))]
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    one = rows.groupBy("node").agg(F.min(F.struct("k1", "k2")).alias("o"))
    wanted = settle(one.join(nodes, "node", "left_semi").select("node", "o.*"), "candidate-nodes")
    body = F.coalesce("text", F.lit("")).cast("binary")
    found = keyed.select("k1", "k2", body.alias("bytes")).join(wanted, ["k1", "k2"])
    texts = settle(found.dropDuplicates(["node"]).select("node", "bytes"), "candidate-texts")
    first = pairs.join(texts.select(F.col("node").alias("a"), F.col("bytes").alias("x")), "a")
    both = first.join(texts.select(F.col("node").alias("b"), F.col("bytes").alias("y")), "b")
    return settle(both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long"), "similar")


def similar_roots(keyed: DataFrame, words: int = SIMILAR_WORDS, least: float = SIMILAR, family: int = FAMILY) -> DataFrame:
    """(doc_id, k1, k2, root): one root per group of near copies."""
    rows = settle(banded(keyed, words, band_plan(keyed.count(), least)), "banded")
    nodes = rows.groupBy("node").agg(F.first("fp").alias("fp"), F.first("bands").alias("bands"))
    members = settle(nodes.select("node", "fp", F.explode("bands").alias("band")), "bands")
    held = F.struct("node", "fp")
    sizes = settle(members.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.min(held).alias("first")).where("n > 1"), "band-sizes")
    close = F.bit_count(F.col("fp").bitwiseXOR(F.col("other_fp"))) <= CHECK_BITS

    def pairs(left: DataFrame, right: DataFrame, *more) -> DataFrame:
        other = right.select("band", F.col("node").alias("other"), F.col("fp").alias("other_fp"), *(F.col(c).alias(f"other_{c}") for c in right.columns if c == "root"))
        met = left.join(other, "band").where(close)
        for m in more:
            met = met.where(m)
        return settle(met.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct(), "candidates")

    few = settle(members.join(sizes.where(F.col("n") <= family).select("band"), "band", "left_semi"), "few")
    many = settle(members.join(sizes.where(F.col("n") > family).select("band"), "band", "left_semi"), "many")
    leaders = sizes.where(F.col("n") > family).select("band", "first.node", "first.fp")
    candidates = pairs(few, few, F.col("node") < F.col("other")).union(pairs(many, leaders, F.col("node") != F.col("other"))).distinct()
    links = similar_links(settle(candidates, "pairs"), rows, keyed, words, least)
    roots = settle(components(links), "roots")
    if not many.isEmpty():
        placed = settle(many.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "placed")
        shares = placed.groupBy("band", "root").count()
        largest = settle(shares.groupBy("band").agg(F.max(F.struct("count", "root")).alias("m")).select("band", F.col("m.root").alias("top")), "largest")
        outside = settle(placed.join(largest, "band").where("root <> top").drop("top"), "outside")
        more = pairs(outside, placed.join(outside.select("band").distinct(), "band", "left_semi"), F.col("root") != F.col("other_root"))
        links = links.union(similar_links(more, rows, keyed, words, least))
        roots = settle(components(links), "roots")
    return rows.select("doc_id", "k1", "k2", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def keep_one_similar(docs: DataFrame, words: int = SIMILAR_WORDS, least: float = SIMILAR, family: int = FAMILY) -> DataFrame:
    """``docs`` with one document of each group of near copies: linked are texts with a Jaccard similarity of ``least`` or more."""
    keyed = _with_keys(docs)
    return _one_of_each(keyed, similar_roots(keyed, words, least, family))
