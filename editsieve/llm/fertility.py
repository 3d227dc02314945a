"""Quality rules from tokeniser fertility.

A public vocabulary was learnt on natural text. How well it fits a document tells how natural the document is:
characters per token (fertility), the share of tokens that are single fallback bytes, and the entropy of the tokens.
Each language (or script, or any other column) has its own bands: median and spread are taken over all its documents, and
what lies far outside is rejected. Plain counting rules come first.

Words are encoded one by one, each with the mark of a preceding blank, and the pieces of words that a worker has met are
remembered in a bounded table.

Defined results: null, empty and blank texts have no words, so they fail the base rules; a null language is a group of its own;
measures of texts without words are null and count in no band; equal rows give equal rows; an empty table
gives no row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editsieve.llm.bpe import tokenizer_path
from editsieve.llm.common import settle

MIN_WORDS = 50
MAX_REPEAT_SHARE = 0.5
SYMBOLS = "#*$%&|<>"
# Width of a band in robust standard deviations, and the least half-width of each measure.
BAND = 8.0
LEAST = {"chars_per_token": 0.6, "fallback_share": 0.02, "token_entropy": 1.5}
MEASURES = tuple(LEAST)
REMEMBERED = 250_000
# Words looked up together.
TOGETHER = 200_000

COUNTS = (
    "doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_tokens long, n_fallback long, token_entropy double"
)


class WordPieces:
    """Ids of single words; ``bytes`` of little-endian 32-bit ids per word."""

    _made: dict[str, WordPieces] = {}

    @classmethod
    def of(cls, path: str) -> WordPieces:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.fallback = np.array([self.model.is_byte(i) for i in range(self.model.get_piece_size())])
        self.known: dict[bytes, bytes] = {}

    def ids(self, words: list[bytes]) -> list[bytes]:
        new = set(words).difference(self.known)
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = set(words)
        if new:
            order = list(new)
            found = self.model.encode([w.decode("utf-8") for w in order], num_threads=1)
            self.known.update(zip(order, (np.array(f, dtype="<u4").tobytes() for f in found)))
        return list(map(self.known.__getitem__, words))


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three words that the text has at least twice; the first one included."""
    n = len(words) - 2
    if n < 2:
        return 0
    names: dict[bytes, int] = {}
    at = np.array([names.setdefault(w, len(names)) for w in words], dtype=np.int64)
    # Number pairs first, so that no text is long enough to overflow.
    _, pair = np.unique(at[:-1] * len(names) + at[1:], return_inverse=True)
    _, window, times = np.unique(pair[:-1] * np.int64(len(names)) + at[2:], return_inverse=True, return_counts=True)
    many = times[window] > 1
    covered = np.zeros(len(words), dtype=bool)
    for k in range(3):
        covered[k : k + n] |= many
    return int(covered.sum())


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    seen: set[bytes] = set()
    again = 0
    for line in text.split(b"\n"):
        if line in seen:
            again += 1
        elif line.strip(b" \t\n\v\f\r"):
            seen.add(line)
    return again


def entropy(ids: np.ndarray) -> float:
    """Bits per token."""
    share = np.unique(ids, return_counts=True)[1] / len(ids)
    return float(-(share * np.log2(share)).sum()) + 0.0


def measure(docs: DataFrame, model: str) -> DataFrame:
    drop = bytes(c for c in range(256) if c not in SYMBOLS.encode())
    tails = bytes(range(0x80, 0xC0))  # all bytes of a character but the first

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        pieces = WordPieces.of(model)
        for batch in batches:
            out = []
            for doc_id, lang, value in zip(batch.column("doc_id").to_pylist(), batch.column("lang").to_pylist(), batch.column("bytes")):
                text = value.as_py()
                words = text.split()  # on bytes: ASCII white space only
                n_tokens = n_fallback = 0
                bits = None
                if words:
                    parts = [pieces.ids(words[s : s + TOGETHER]) for s in range(0, len(words), TOGETHER)]
                    ids = np.frombuffer(b"".join(b"".join(p) for p in parts), dtype="<u4")
                    n_tokens, n_fallback = len(ids), int(pieces.fallback[ids].sum())
                    bits = entropy(ids) if n_tokens else 0.0
                out.append((
                    doc_id, lang, len(words), len(b"".join(words).translate(None, tails)), len(text.translate(None, drop)),
                    repeated_lines(text), repeated_words(words), n_tokens, n_fallback, bits,
                ))
            if out:
                types = (pa.int64(), pa.string(), *[pa.int64()] * 7, pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    names = [c.split()[0] for c in COUNTS.split(", ")]
    source = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.coalesce("text", F.lit("")).cast("binary").alias("bytes"))
    return source.mapInArrow(run, COUNTS)


def bands(measured: DataFrame, width: float = BAND) -> DataFrame:
    """(lang, low_<m>, high_<m>): median and median deviation over all documents that pass the base rules."""
    fit = measured.where(~F.col("base_failed"))
    middle = settle(fit.groupBy("lang").agg(*(F.percentile_approx(m, 0.5, 10_000).alias(f"mid_{m}") for m in MEASURES)), "medians")
    away = fit.join(middle.withColumnRenamed("lang", "l"), F.col("lang").eqNullSafe(F.col("l")), "left")
    spread = away.groupBy("lang").agg(
        *(F.first(f"mid_{m}").alias(f"mid_{m}") for m in MEASURES),
        *(F.percentile_approx(F.abs(F.col(m) - F.col(f"mid_{m}")), 0.5, 10_000).alias(f"mad_{m}") for m in MEASURES),
    )
    cols = [F.col("lang")]
    for m in MEASURES:
        half = F.greatest(F.col(f"mad_{m}") * 1.4826 * width, F.lit(LEAST[m]))
        cols += [(F.col(f"mid_{m}") - half).alias(f"low_{m}"), (F.col(f"mid_{m}") + half).alias(f"high_{m}")]
    return settle(spread.select(*cols), "bands")


def quality_rules(spark: SparkSession, docs: DataFrame, model: str | None = None, width: float = BAND) -> DataFrame:
    """Counts, measures and verdict of every document."""
    measured = measure(docs, model or tokenizer_path("piece_bpe_32k.model"))
    some = F.col("n_tokens") > 0
    measured = settle(
        measured.withColumn("chars_per_token", F.when(some, F.col("word_chars") / F.col("n_tokens")))
        .withColumn("fallback_share", F.when(some, F.col("n_fallback") / F.col("n_tokens")))
        .withColumn(
            "base_failed",
            (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * int(100 * MAX_REPEAT_SHARE)),
        ),
        "measured",
    )
    limits = bands(measured, width).withColumnRenamed("lang", "l")
    inside = F.lit(True)
    for m in MEASURES:
        inside &= F.coalesce(F.col(m).between(F.col(f"low_{m}"), F.col(f"high_{m}")), F.lit(True))
    joined = measured.join(limits, F.col("lang").eqNullSafe(F.col("l")), "left")
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & inside).alias("kept"), "n_tokens", *MEASURES,
    )
