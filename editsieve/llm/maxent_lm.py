"""Language-model scores from a hashed maximum-entropy model.

The probability of a token is that of its class in its context times that of the token in its class. Classes follow from
the word alone (its ending, or the word if it is short). The class factor is a log-linear model: features of the context (previous word, skip to the
one before, the pair of both, the last three classes) are hashed to rows of a weight table of fixed size, and the rows that fire are
summed into a softmax over the classes. The factor of the token in its class is log-linear in its context as well: the bits of the
token's hash lead down a binary tree (``WordTree``), each turn has its share of the training counts as bias and one weight for each of
previous word, word before that, and the pair of both, hashed together with the place in the tree. Depth and weight table grow with the number of
distinct tokens, until a leaf holds about ``LEAF`` of them. Within a leaf a token has the add-one estimate of its training count, with
a place for unknown tokens, so probabilities sum to one.

Training covers all training documents. One pass counts tokens and feature-class pairs, which start the weights. Then
each document takes part in one of ``ROUNDS`` gradient rounds for both factors: tasks compute observed minus expected counts in sparse
numpy batches, tables are added up by row block over the executors, and the driver updates weights of fixed size.

Counts of the ``HEAD`` most frequent tokens (a fixed bound) go to the tasks; all others are looked up by a join of (row, token) pairs with
the table of counts. Tokens are told apart by 60 bits of their XXH64.

Defined results: null, empty and blank texts consist of the end token; null ids are training rows; equal rows get equal
scores; without training rows the counts are 0 and each token has 1 / (V + 1); an empty table gives no row;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from editsieve.llm.common import settle, shuffle_width

FOLDS, FOLD = 7, 2
CLASSES = 16
SHORT = 3  # bytes of a word that is its own class key
TEMPLATES, ROWS_EACH = 4, 4096
ROWS = TEMPLATES * ROWS_EACH
BLOCKS = 64
ROUNDS, RATE, SMOOTH = 2, 0.3, 5.0
HEAD = 1 << 18
REMEMBERED = 400_000
# The tree of the tokens of a class: words in a leaf, most levels, contexts, step, damping and most of a step, bits of its weight table.
LEAF, DEEPEST, CONTEXTS = 2, 14, 3
TREE_RATE, TREE_SMOOTH, TREE_STEP = 0.5, 4.0, 2.0
TREE_BITS = 16, 19
# Tokens whose softmax is computed at once.
SLICE = 1 << 15
START = np.uint64(0x5BD1E995)
END = b"\n"  # no word holds it
LN10 = float(np.log(10.0))


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == FOLD


def token_key(word: bytes) -> int:
    """60 bits of hash over 4 bits of class."""
    import xxhash

    h = xxhash.xxh64_intdigest
    if word == END:
        group = 0
    elif len(word) <= SHORT:
        group = 1 + h(word, 7) % 5
    else:
        group = 6 + h(word[-2:], 7) % (CLASSES - 6)
    return (h(word) & ~0xF) | group


class Tokens:
    """Keys of the words of texts; a bounded table of words stays in the worker."""

    def __init__(self):
        self.place: dict[bytes, int] = {}
        self.keys = np.empty(1 << 16, dtype=np.uint64)

    def of(self, words: list[bytes]) -> np.ndarray:
        new = set(words).difference(self.place)
        if len(self.place) + len(new) > REMEMBERED:
            self.place.clear()
            new = set(words)
        n = len(self.place)
        while n + len(new) > len(self.keys):
            self.keys = np.concatenate([self.keys, np.empty_like(self.keys)])
        if new:
            self.keys[n : n + len(new)] = np.array([token_key(w) for w in new], dtype=np.uint64)
            self.place.update(zip(new, range(n, n + len(new))))
        return self.keys[np.fromiter(map(self.place.__getitem__, words), dtype=np.int64, count=len(words))]


_TOKENS = Tokens()


def token_batches(texts: pa.Array, size: int = 1 << 17) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(keys, starts of the documents in them) for groups of whole documents, in order."""
    keys, starts, held, n = [], [], [], 0

    def close() -> tuple[np.ndarray, np.ndarray]:
        return (np.concatenate(keys) if keys else np.empty(0, dtype=np.uint64)), np.array(starts, dtype=np.int64)

    for value in texts:
        words = value.as_py().lower().split()  # on bytes: A-Z and ASCII white space only
        words.append(END)
        starts.append(n)
        n += len(words)
        held.extend(words)
        if len(held) >= size:
            keys.append(_TOKENS.of(held))
            held = []
            yield close()
            keys, starts, n = [], [], 0
    if held:
        keys.append(_TOKENS.of(held))
    if starts:
        yield close()


def before(keys: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """The keys one, two and three tokens back, ``START`` beyond the first token of a document."""
    back = []
    for k in (1, 2, 3):
        prev = np.empty_like(keys)
        prev[:k] = START
        prev[k:] = keys[:-k] if len(keys) > k else keys[:0]
        for j in range(k):
            at = starts + j
            prev[at[at < len(prev)]] = START
        # A start too close after another one is a start itself, so nothing of a document is overwritten wrongly.
        back.append(prev)
    return back


def context_rows(keys: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(templates x tokens) rows of the weight table that fire, and the class of each token."""
    cls = (keys & np.uint64(15)).astype(np.int64)
    back = before(keys, starts)
    w1, w2, _ = back
    c = [b & np.uint64(15) for b in back]
    odd = np.uint64(0x9E3779B97F4A7C15)
    shift = np.uint64(64 - 12)
    mixes = (
        w1 * odd, (w2 ^ np.uint64(0xA5A5A5A5)) * odd, (w1 * odd + (w2 >> np.uint64(7))) * odd,
        ((c[0] << np.uint64(8)) | (c[1] << np.uint64(4)) | c[2]) << shift,
    )
    rows = np.stack([(m >> shift).astype(np.int64) + i * ROWS_EACH for i, m in enumerate(mixes)])
    return rows, cls


class ClassModel:
    """Softmax over the classes: bias plus the weight rows that fire."""

    def __init__(self, bias: np.ndarray, table: np.ndarray):
        self.bias, self.table = bias.astype(np.float32), table.astype(np.float32)

    @classmethod
    def from_counts(cls, counts: np.ndarray) -> ClassModel:
        """Start: damped log odds of each class given each feature."""
        totals = counts[:ROWS_EACH].sum(axis=0) + 1.0
        prior = totals / totals.sum()
        given = (counts + 20.0 * prior) / (counts.sum(axis=1, keepdims=True) + 20.0)
        return cls(np.log(prior), 0.5 * np.log(given / prior))

    def probabilities(self, rows: np.ndarray) -> np.ndarray:
        z = self.bias + self.table[rows[0]]
        for r in rows[1:]:
            z += self.table[r]
        z -= z.max(axis=1, keepdims=True)
        np.exp(z, out=z)
        z /= z.sum(axis=1, keepdims=True)
        return z

    def log10(self, rows: np.ndarray, cls: np.ndarray) -> np.ndarray:
        out = np.empty(len(cls))
        for s in range(0, len(cls), SLICE):
            p = self.probabilities(rows[:, s : s + SLICE])
            out[s : s + SLICE] = np.log10(np.maximum(p[np.arange(len(p)), cls[s : s + SLICE]], 1e-30))
        return out

    def stepped(self, observed: np.ndarray, expected: np.ndarray) -> ClassModel:
        """One gradient step, scaled per weight by how much was expected there."""
        slope = (observed - expected) / (expected + SMOOTH)
        gap = observed[:ROWS_EACH].sum(axis=0) - expected[:ROWS_EACH].sum(axis=0)
        bias = self.bias + RATE * np.clip(gap / (expected[:ROWS_EACH].sum(axis=0) + SMOOTH), -1, 1)
        return ClassModel(bias, self.table + RATE * np.clip(slope, -1, 1))


def tree_depth(distinct: int) -> int:
    return min(max(int(np.ceil(np.log2(max(distinct, 1) / (CLASSES * LEAF)))), 0), DEEPEST)


class WordTree:
    """Probability of a token within its class, given the tokens before it.

    The bits of a key above its class lead from the root of the class to a leaf. The log odds of a turn are a bias, the odds of
    the training counts on either side, and one hashed weight per context and place. ``leaf_sizes``: uses and distinct tokens of each
    leaf, ``n`` and ``v``, by ``leaf``.
    """

    def __init__(self, depth: int, leaf_n: np.ndarray, leaf_v: np.ndarray, bits: int, table: np.ndarray | None = None):
        self.depth, self.bits, self.leaf_n, self.leaf_v = depth, bits, leaf_n, leaf_v
        self.table = np.zeros(1 << bits, dtype=np.float32) if table is None else table.astype(np.float32)
        mass = (leaf_n + leaf_v + 1.0).reshape(CLASSES, -1)
        self.norm = np.log10(mass.ravel())
        self.bias = np.zeros((CLASSES, 1 << depth), dtype=np.float32)
        for level in range(depth - 1, -1, -1):  # leaves are numbered by their bits, the first turn lowest
            low, high = mass[:, : 1 << level], mass[:, 1 << level :]
            self.bias[:, 1 << level : 2 << level] = np.log(high / low)
            mass = low + high
        self.bias = self.bias.ravel()

    @classmethod
    def of(cls, counts: DataFrame) -> WordTree:
        """An untrained tree of the distinct tokens (key, n). One row per leaf comes to the driver: at most 16 * 2^``DEEPEST``."""
        distinct = counts.count()
        depth = tree_depth(distinct)
        n, v = np.zeros(CLASSES << depth), np.zeros(CLASSES << depth)
        group, rest = F.col("key").bitwiseAND(F.lit(15).cast("long")), F.shiftright("key", 4).bitwiseAND(F.lit((1 << depth) - 1).cast("long"))
        leaf = (F.shiftleft(group, depth) + rest).alias("leaf")
        for r in counts.groupBy(leaf).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect():
            n[r.leaf], v[r.leaf] = r.n, r.v
        return cls(depth, n, v, min(max(int(distinct).bit_length(), TREE_BITS[0]), TREE_BITS[1]))

    def leaf(self, keys: np.ndarray) -> np.ndarray:
        mask = np.uint64((1 << self.depth) - 1)
        return (((keys & np.uint64(15)) << np.uint64(self.depth)) | (keys >> np.uint64(4)) & mask).astype(np.int64)

    def turns(self, keys: np.ndarray, back: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per level and token: (log odds of a set bit, whether it is set), and per context, level and token the weight that fires."""
        odd, shift = np.uint64(0x9E3779B97F4A7C15), np.uint64(64 - self.bits)
        w1, w2 = back[0] * odd, back[1] * np.uint64(0xC2B2AE3D27D4EB4F)
        contexts = (w1, w2, (w1 ^ (w2 >> np.uint64(9))) * odd)
        path, group = keys >> np.uint64(4), (keys & np.uint64(15)) << np.uint64(self.depth)
        odds = np.empty((self.depth, len(keys)), dtype=np.float32)
        bits = np.empty((self.depth, len(keys)), dtype=bool)
        fired = np.empty((CONTEXTS, self.depth, len(keys)), dtype=np.int64)
        for level in range(self.depth):
            node = group | np.uint64(1 << level) | path & np.uint64((1 << level) - 1)
            place = node * np.uint64(0xD6E8FEB86659FD93)
            z = self.bias[node.astype(np.int64)]
            for at, context in zip(fired, contexts):
                at[level] = ((context ^ place) * odd) >> shift
                z = z + self.table[at[level]]
            odds[level], bits[level] = z, (path >> np.uint64(level)) & np.uint64(1)
        return odds, bits, fired

    def log10(self, keys: np.ndarray, back: list[np.ndarray]) -> np.ndarray:
        """Log probability of the leaf in the class, less the log of the leaf's places."""
        out = -self.norm[self.leaf(keys)]
        for s in range(0, len(keys), SLICE):
            part = slice(s, s + SLICE)
            odds, bits, _ = self.turns(keys[part], [b[part] for b in back])
            out[part] -= np.logaddexp(0, np.where(bits, -odds, odds)).sum(axis=0, dtype=np.float64) / LN10
        return out

    def slopes(self, keys: np.ndarray, back: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Observed minus expected set bits, and the variance of these, per weight."""
        slope, bend = np.zeros(1 << self.bits), np.zeros(1 << self.bits)
        for s in range(0, len(keys), SLICE):
            part = slice(s, s + SLICE)
            odds, bits, fired = self.turns(keys[part], [b[part] for b in back])
            p = 0.5 + 0.5 * np.tanh(0.5 * odds)
            gap, spread = (bits - p).ravel(), (p * (1 - p)).ravel()
            slope += np.bincount(fired.ravel(), np.tile(gap, CONTEXTS), 1 << self.bits)
            bend += np.bincount(fired.ravel(), np.tile(spread, CONTEXTS), 1 << self.bits)
        return slope, bend

    def stepped(self, slope: np.ndarray, bend: np.ndarray) -> WordTree:
        step = TREE_RATE * np.clip(slope / (bend + TREE_SMOOTH), -TREE_STEP, TREE_STEP)
        return WordTree(self.depth, self.leaf_n, self.leaf_v, self.bits, self.table + step)


def observed_counts(rows: np.ndarray, cls: np.ndarray) -> np.ndarray:
    total = np.zeros(ROWS * CLASSES, dtype=np.int64)
    for r in rows:
        total += np.bincount(r * CLASSES + cls, minlength=ROWS * CLASSES)
    return total.reshape(ROWS, CLASSES)


def expected_counts(rows: np.ndarray, p: np.ndarray) -> np.ndarray:
    total = np.zeros((ROWS, CLASSES))
    for r in rows:
        short = r.astype(np.uint16)
        order = np.argsort(short, kind="stable")
        line = short[order]
        first = np.concatenate(([0], np.nonzero(line[1:] != line[:-1])[0] + 1))
        total[line[first]] += np.add.reduceat(p[order], first, axis=0)
    return total


def _blocks(*tables: np.ndarray) -> list[bytes]:
    """The tables cut in ``BLOCKS`` row blocks, side by side."""
    cut = [np.split(t.astype("<f8"), BLOCKS) for t in tables]
    return [b"".join(c[i].tobytes() for c in cut) for i in range(BLOCKS)]


def _added(parts: DataFrame, shapes: list[tuple[int, ...]]) -> list[np.ndarray]:
    """Sum of the tables that tasks have emitted as (block, data). Memory does not depend on the number of tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, data in zip(batch.column("block").to_pylist(), batch.column("data")):
                part = np.frombuffer(data.as_py(), dtype="<f8")
                sums[block] = sums[block] + part if block in sums else part
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int64()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], names=["block", "data"]
        )

    width = min(BLOCKS, shuffle_width(parts.sparkSession))
    summed = parts.repartition(width, "block").mapInArrow(run, "block long, data binary").collect()
    out = [np.zeros(shape) for shape in shapes]
    sizes = [t.size // BLOCKS for t in out]
    for r in summed:
        for table, part in zip(out, np.split(np.frombuffer(r.data, dtype="<f8"), np.cumsum(sizes)[:-1])):
            step = len(table) // BLOCKS
            table[r.block * step : (r.block + 1) * step] = part.reshape(step, *table.shape[1:])
    return out


def _source(docs: DataFrame) -> DataFrame:
    body = F.coalesce("text", F.lit("")).cast("binary")
    part = F.pmod(F.xxhash64("doc_id", body), F.lit(ROUNDS)).cast("int")
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), part.alias("part"), body.alias("bytes"))


def corpus_counts(docs: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """(key, n) of all training tokens, and the feature-class counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        pairs = np.zeros((ROWS, CLASSES), dtype=np.int64)
        for batch in batches:
            held = []
            for keys, starts in token_batches(batch.column("bytes")):
                rows, cls = context_rows(keys, starts)
                pairs += observed_counts(rows, cls)
                held.append(keys)
            if held:
                keys, n = np.unique(np.concatenate(held), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64)), pa.nulls(len(n), pa.binary())], names=["key", "n", "data"]
                )
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(BLOCKS), pa.int64()), pa.nulls(BLOCKS, pa.int64()), pa.array(_blocks(pairs), pa.binary())], names=["key", "n", "data"]
        )

    train = _source(docs).where(~F.col("held_out")).select("bytes")
    parts = settle(train.mapInArrow(run, "key long, n long, data binary"), "lm-parts")
    counts = settle(parts.where(F.col("data").isNull()).groupBy("key").agg(F.sum("n").alias("n")), "lm-counts")
    blocks = parts.where(F.col("data").isNotNull()).select(F.col("key").alias("block"), "data")
    return counts, _added(blocks, [(ROWS, CLASSES)])[0]


def train(docs: DataFrame, start: ClassModel, tree: WordTree) -> tuple[ClassModel, WordTree]:
    spark, model = docs.sparkSession, start
    for r in range(ROUNDS):
        current = spark.sparkContext.broadcast((model, tree))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
            m, t = current.value
            observed, expected = np.zeros((ROWS, CLASSES), dtype=np.int64), np.zeros((ROWS, CLASSES))
            slope, bend = np.zeros(1 << t.bits), np.zeros(1 << t.bits)
            for batch in batches:
                for keys, starts in token_batches(batch.column("bytes")):
                    rows, cls = context_rows(keys, starts)
                    observed += observed_counts(rows, cls)
                    for s in range(0, len(cls), SLICE):
                        part = rows[:, s : s + SLICE]
                        expected += expected_counts(part, m.probabilities(part))
                    for total, found in zip((slope, bend), t.slopes(keys, before(keys, starts))):
                        total += found
            data = _blocks(observed, expected, slope, bend)
            yield pa.RecordBatch.from_arrays([pa.array(range(BLOCKS), pa.int64()), pa.array(data, pa.binary())], names=["block", "data"])

        rows = _source(docs).where(~F.col("held_out") & (F.col("part") == r)).select("bytes")
        shapes = [(ROWS, CLASSES)] * 2 + [(1 << tree.bits,)] * 2
        observed, expected, slope, bend = _added(rows.mapInArrow(run, "block long, data binary"), shapes)
        model, tree = model.stepped(observed, expected), tree.stepped(slope, bend)
    return model, tree


def language_model_scores(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document."""
    counts, pairs = corpus_counts(docs)
    model, tree = train(docs, ClassModel.from_counts(pairs), WordTree.of(counts))
    total, distinct = int(tree.leaf_n.sum()), int(tree.leaf_v.sum())
    head = counts.orderBy(F.desc("n"), "key").limit(HEAD).toPandas().sort_values("key")
    shared = spark.sparkContext.broadcast((model, tree, head["key"].to_numpy(), head["n"].to_numpy()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        m, t, head_keys, head_n = shared.value
        head_log = np.log10(head_n + 1.0)
        for batch in batches:
            columns: list[list] = [[] for _ in range(6)]
            for keys, starts in token_batches(batch.column("bytes")):
                rows, cls = context_rows(keys, starts)
                log_class = m.log10(rows, cls) + t.log10(keys, before(keys, starts))
                signed = keys.view(np.int64)
                at = np.minimum(np.searchsorted(head_keys, signed), max(0, len(head_keys) - 1))
                known = head_keys[at] == signed if len(head_keys) else np.zeros(len(signed), dtype=bool)
                log_count = np.where(known, head_log[at], 0.0) if len(head_keys) else np.zeros(len(signed))
                columns[0].append(np.diff(np.append(starts, len(keys))))
                columns[1].append(np.add.reduceat(known.astype(np.int64), starts))
                columns[2].append(np.add.reduceat(log_count, starts))
                columns[3].append(np.add.reduceat(log_class, starts))
                ends = np.append(starts[1:], len(keys))
                for a, b in zip(starts.tolist(), ends.tolist()):
                    rare, n = np.unique(signed[a:b][~known[a:b]], return_counts=True)
                    columns[4].append(rare)
                    columns[5].append(n)
            if not batch.num_rows:
                continue
            flat = [np.concatenate(c) for c in columns[:4]]
            offsets = pa.array(np.concatenate(([0], np.cumsum([len(x) for x in columns[4]]))).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(c).astype(np.int64))) for c in columns[4:]]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), *(pa.array(f) for f in flat), *lists],
                names=["doc_id", "held_out", "n_tokens", "n_head", "log_head", "log_class", "rare", "times"],
            )

    schema = (
        "doc_id long, held_out boolean, n_tokens long, n_head long, log_head double, log_class double, "
        "rare array<long>, times array<long>"
    )
    scored = _source(docs).select("doc_id", "held_out", "bytes").mapInArrow(run, schema)
    scored = settle(scored.withColumn("row", F.monotonically_increasing_id()), "lm-scored")
    pairs_of = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("p")).select(
        "row", F.col("p.rare").alias("key"), F.col("p.times").alias("times")
    )
    # Unknown tokens add log10(1) = 0, so an inner join does.
    looked = pairs_of.join(counts, "key").groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("log_rare"), F.sum("times").alias("n_rare")
    )
    whole = scored.drop("rare", "times").join(looked, "row", "left")
    log_counts = F.col("log_head") + F.coalesce("log_rare", F.lit(0.0))
    norm = float(np.log10(total + distinct + 1.0))
    return whole.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_head") + F.coalesce("n_rare", F.lit(0))).alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"), (log_counts - F.col("n_tokens") * F.lit(norm)).alias("base_score"),
        (log_counts + F.col("log_class")).alias("score"),
    )
