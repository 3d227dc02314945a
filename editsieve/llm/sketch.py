"""Threshold-scaled sketches of documents, in DataFrame functions only.

A sketch keeps the hash of every word shingle that falls below a fixed fraction of the hash range.
Its size follows the document, so the overlap of a short and a very long text can be estimated as well as
that of equals, and the sketch of a union is the union of sketches. So that no text with words has an empty
sketch, the smallest hash is always kept; it is also the smallest of a union.

Defined results: texts without words (null, empty, blank) have the empty fingerprint ``''``, which is like another
empty one (1.0) and unlike any other (0.0); fewer words than a shingle make one shingle; the order of documents is
ascending id, null first, then a hash of the text; equal rows follow one another; one single document is its own
next; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from editsieve.llm.common import bucket_bounds, bucket_of, id_text, settle

WORDS, SCALE = 5, 8
ROWS_PER_BUCKET = 2048


def word_hashes(text: Column) -> Column:
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def shingle_hashes(hashes: Column, words: int = WORDS) -> Column:
    """Hash of each run of ``words`` words, from an array of word hashes."""
    n = F.size(hashes)
    runs = F.transform(
        F.sequence(F.lit(0), n - F.lit(words)), lambda i: F.xxhash64(*(F.get(hashes, i + F.lit(k)) for k in range(words)))
    )
    return F.when(n == 0, F.array().cast("array<bigint>")).when(n < words, F.array(F.xxhash64(hashes))).otherwise(runs)


def scaled(hashes: Column, scale: int = SCALE) -> Column:
    """Distinct hashes among the lowest ``1 / scale`` of the range, and the smallest one."""
    limit = -(1 << 63) + (1 << 64) // scale
    low = F.filter(hashes, lambda h: h < F.lit(limit))
    kept = F.when(F.size(low) > 0, low).when(F.size(hashes) > 0, F.array(F.array_min(hashes))).otherwise(low)
    return F.array_sort(F.array_distinct(kept))


def with_sketch(df: DataFrame, text: str, out: str, words: int = WORDS, scale: int = SCALE) -> DataFrame:
    """Adds ``out``. Each step is a column of its own, so that nothing is computed twice."""
    steps = df.withColumn("__words", word_hashes(F.col(text)))
    steps = steps.withColumn("__runs", shingle_hashes(F.col("__words"), words)).drop("__words")
    return steps.withColumn(out, scaled(F.col("__runs"), scale)).drop("__runs")


def sketch_text(sketch: Column) -> Column:
    return F.concat_ws("", F.transform(sketch, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))))


def similarity(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of the shingle sets."""
    shared = F.size(F.array_intersect(a, b))
    total = F.size(a) + F.size(b) - shared
    return F.when(total == 0, F.lit(1.0)).otherwise(shared / total)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` has too; for documents of any two sizes."""
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def merged(a: Column, b: Column) -> Column:
    """Sketch of the union."""
    return F.array_sort(F.array_union(a, b))


def with_next(rows: DataFrame, carried: list[str], rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Adds ``next_<c>`` for each carried column: its value in the next row by (doc_id, tie), the first after the last.

    Rows are cut into ranges of ids; each range is one window. The first row of each range is also
    handed, as a guest, to the range before it. There is one such row per range, and rows are shuffled once.
    """
    bounds = bucket_bounds(rows, "doc_id", rows_per_bucket)
    placed = rows.withColumn("bucket", bucket_of(F.col("doc_id"), bounds))
    order = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "tie")
    heads = placed.select("bucket", "doc_id", "tie").groupBy("bucket").agg(F.min(order).alias("h"))
    by_bucket = Window.orderBy("bucket")  # one row per range
    first = F.max("bucket").over(by_bucket.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    heads = settle(
        heads.select("bucket", "h.doc_id", "h.tie", F.coalesce(F.lag("bucket").over(by_bucket), first).alias("host")), "heads"
    )
    own = rows.select(*(F.col(c).alias(f"g_{c}") for c in rows.columns))
    same = heads["doc_id"].eqNullSafe(own["g_doc_id"]) & (heads["tie"] == own["g_tie"])
    guests = own.join(heads, same).groupBy("host").agg(*(F.first(f"g_{c}").alias(c) for c in rows.columns))
    guests = guests.select(*rows.columns, F.col("host").alias("bucket"), F.lit(True).alias("guest"))
    both = placed.withColumn("guest", F.lit(False)).unionByName(guests)
    line = Window.partitionBy("bucket").orderBy("guest", F.asc_nulls_first("doc_id"), "tie")
    for c in carried:
        both = both.withColumn(f"next_{c}", F.lead(c).over(line))
    return both.where(~F.col("guest")).drop("bucket", "guest")


def edited_pairs(spark: SparkSession, docs: DataFrame, words: int = WORDS, scale: int = SCALE) -> DataFrame:
    """Fingerprints of each document and of its edited text, and how like they are."""
    rows = id_text(docs).withColumn("tie", F.xxhash64("text"))
    rows = with_next(with_sketch(rows, "text", "sketch", words, scale), ["text", "sketch"])
    n = F.length("text")
    cut = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - cut), F.substring("next_text", F.lit(1), cut))
    rows = rows.select(
        "doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "sketch",
        similarity(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )
    return with_sketch(rows, "edited", "edited_sketch", words, scale).select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), sketch_text(F.col("sketch")).alias("fingerprint"),
        sketch_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        similarity(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"), "near_next",
    )
