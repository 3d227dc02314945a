"""Key index of dedup keys with pruning: buckets by key prefix, one Bloom filter per file.

Layout under ``path``::

    keys/bucket=<b>/run=<r>/part-*.parquet      (lang, dedup_key, kh) of the keys run r added, sorted by kh
    filters/bucket=<b>/run=<r>/part-*.parquet   (word, bits): the Bloom filter of that file as 64-bit words
    sizes/run=<r>/part-*.parquet                (lang, added): keys added per language

``kh`` is a 64-bit hash of the key and ``b`` its top ``bits`` bits, so a batch reads only the buckets its keys fall into
(a partition filter on ``keys``). Within those, a file is read only if its Bloom filter may hold one of the batch's keys:
the filter words of the hit buckets are joined with the probe positions of the asked keys, and only files where all
``HASHES`` positions of some key are set are read. Key equality is decided on ``(lang, dedup_key)`` themselves, null-safe;
the hash only routes. The index never holds a key twice: a run adds only the keys no earlier run holds, so the sizes table
gives index sizes per language without counting the index.

A run writes under its own ``run=`` folders with dynamic partition overwrite, so a replayed run replaces what it wrote; lookups
take only runs before the asking one. The lists that pass the driver are bounded: hit buckets (at most ``2 ** bits``) and
candidate files (at most one per bucket and run).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.scale import null_safe_join, settle

KEY = ["lang", "dedup_key"]
BUCKET_BITS = 8
HASHES = 7
BITS_PER_KEY = 10
# Distinct keys of one batch that go to every task as a broadcast; beyond it both sides shuffle by kh.
BROADCAST_KEYS = 2_000_000

KEYS = T.StructType([
    T.StructField("lang", T.StringType()), T.StructField("dedup_key", T.StringType()), T.StructField("kh", T.LongType()),
    T.StructField("bucket", T.IntegerType()), T.StructField("run", T.StringType()),
])
FILTERS = T.StructType([
    T.StructField("word", T.LongType()), T.StructField("bits", T.LongType()), T.StructField("m", T.LongType()),
    T.StructField("bucket", T.IntegerType()), T.StructField("run", T.StringType()),
])
SIZES = T.StructType([T.StructField("lang", T.StringType()), T.StructField("added", T.LongType()), T.StructField("run", T.StringType())])


def key_hash(lang: Column, key: Column) -> Column:
    """64-bit hash of the key; a null language hashes apart from every string."""
    return F.xxhash64(F.coalesce(lang, F.lit("\u0000null")), lang.isNull(), F.coalesce(key, F.lit("")), key.isNull())


def bucket_of(kh: Column, bits: int) -> Column:
    return F.shiftrightunsigned(kh, 64 - bits).cast("int")


def probes(kh: Column, m: Column) -> Column:
    """The ``HASHES`` bit positions of a key in a filter of ``m`` bits (double hashing)."""
    low = F.lit(0x7FFFFFFF).cast("long")
    first = kh.bitwiseAND(low)
    step = F.xxhash64(kh).bitwiseAND(low).bitwiseOR(F.lit(1).cast("long"))  # 31 bits each: no overflow
    return F.transform(F.sequence(F.lit(0), F.lit(HASHES - 1)), lambda i: F.pmod(first + i.cast("long") * step, m))


class KeyIndex:
    def __init__(self, spark: SparkSession, path: str, bits: int = BUCKET_BITS):
        self.spark, self.path, self.bits = spark, path.rstrip("/"), bits

    # --- reading -----------------------------------------------------------------------

    def _read(self, name: str, schema: T.StructType) -> DataFrame:
        from .readers import or_empty

        return or_empty(self.spark, lambda: self.spark.read.schema(schema).parquet(f"{self.path}/{name}"), schema)

    def keyed(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``kh`` and ``bucket``."""
        kh = key_hash(F.col("lang"), F.col("dedup_key"))
        return rows.withColumn("kh", kh).withColumn("bucket", bucket_of(F.col("kh"), self.bits))

    def _asked(self, asked: DataFrame) -> DataFrame:
        return settle(self.keyed(asked.select(*KEY)).distinct(), "asked-keys")

    def candidates(self, asked: DataFrame, before: str | None = None) -> DataFrame:
        """(lang, dedup_key) of runs before ``before`` (all, if None) in the files that may hold one of ``asked``'s keys."""
        return self._candidates(self._asked(asked), before).select(*KEY)

    def _candidates(self, keys: DataFrame, before: str | None) -> DataFrame:
        hit = [r[0] for r in keys.select("bucket").distinct().collect()]  # at most 2 ** bits values
        empty = self.spark.createDataFrame([], "lang string, dedup_key string, kh long")
        if not hit:
            return empty
        filters = self._read("filters", FILTERS).where(F.col("bucket").isin(hit))
        if before is not None:
            filters = filters.where(F.col("run") < before)
        files = filters.select("bucket", "run", "m").distinct()
        probe = keys.join(files, "bucket").select("bucket", "run", "kh", F.explode(probes(F.col("kh"), F.col("m"))).alias("pos"))
        probe = probe.select("bucket", "run", "kh", F.floor(F.col("pos") / 64).alias("word"), F.pmod("pos", F.lit(64)).alias("bit"))
        hits = probe.join(filters.select("bucket", "run", "word", "bits"), ["bucket", "run", "word"])
        set_bit = F.expr("(shiftright(bits, CAST(bit AS INT)) & 1L) = 1L")
        maybe = hits.where(set_bit).groupBy("bucket", "run", "kh").count().where(F.col("count") == HASHES)
        wanted = [(r.bucket, r.run) for r in maybe.select("bucket", "run").distinct().collect()]  # one per file at most
        if not wanted:
            return empty
        chosen = F.lit(False)
        for bucket in sorted({b for b, _ in wanted}):
            chosen = chosen | ((F.col("bucket") == bucket) & F.col("run").isin(sorted(r for b, r in wanted if b == bucket)))
        return self._read("keys", KEYS).where(chosen).select("lang", "dedup_key", "kh")

    def known(self, asked: DataFrame, before: str | None = None) -> DataFrame:
        """Distinct keys of ``asked`` that the index holds (runs before ``before``).

        The read index rows meet the asked keys in a broadcast join (no exchange of index rows) while the distinct asked keys
        are at most ``BROADCAST_KEYS``; beyond that both sides shuffle by their hash.
        """
        keys = self._asked(asked)
        found = self._candidates(keys, before)
        small = keys.select(*KEY, "kh")
        if keys.count() <= BROADCAST_KEYS:
            small = F.broadcast(small)
        on = (found["kh"] == small["kh"]) & found["lang"].eqNullSafe(small["lang"]) & found["dedup_key"].eqNullSafe(small["dedup_key"])
        return found.join(small, on, "left_semi").select(*KEY)

    def sizes(self, before: str | None = None) -> DataFrame:
        """(lang, size): keys per language in runs before ``before``, from the per-run counts."""
        sizes = self._read("sizes", SIZES)
        if before is not None:
            sizes = sizes.where(F.col("run") < before)
        return sizes.groupBy("lang").agg(F.sum("added").alias("size"))

    # --- writing -----------------------------------------------------------------------

    def add(self, rows: DataFrame, run: str) -> DataFrame:
        """Add the keys of ``rows`` that runs before ``run`` do not hold; returns them."""
        keys = self._asked(rows)
        old = self.known(keys, before=run).withColumn("__old", F.lit(True))
        new = settle(null_safe_join(keys, old, KEY, "left").where(F.col("__old").isNull()).drop("__old"), "new-keys")
        self._write(new, run)
        return new.select(*KEY)

    def add_new(self, rows: DataFrame, run: str) -> None:
        """Add the keys of ``rows``, which the caller knows no earlier run holds (as after ``known``)."""
        self._write(self._asked(rows), run)

    def _write(self, new: DataFrame, run: str) -> None:
        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        rows = new.withColumn("run", F.lit(run)).repartition(parts, "bucket").sortWithinPartitions("bucket", "kh")
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("bucket", "run").parquet(f"{self.path}/keys")
        per_file = new.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
        m = F.greatest(F.lit(64), F.pow(F.lit(2), F.ceil(F.log2(F.col("n") * BITS_PER_KEY))).cast("long"))
        sized = new.join(per_file.select("bucket", m.alias("m")), "bucket")
        pos = sized.select("bucket", "m", F.explode(probes(F.col("kh"), F.col("m"))).alias("pos"))
        words = pos.groupBy("bucket", "m", F.floor(F.col("pos") / 64).alias("word")).agg(
            F.bit_or(F.expr("shiftleft(1L, CAST(pmod(pos, 64) AS INT))")).alias("bits"))
        words = words.withColumn("run", F.lit(run)).repartition(parts, "bucket")
        words.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "run").parquet(f"{self.path}/filters")
        added = new.groupBy("lang").agg(F.count(F.lit(1)).alias("added"))
        added.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/sizes/run={run}")
