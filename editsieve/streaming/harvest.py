"""Change events as a stream: every micro-batch goes through the batch operators.

``foreachBatch`` writes under the batch's id, so a replayed batch replaces its own output. What
earlier batches have stored is found in a key index (``sources.key_index``) that a run extends by the keys it wrote, so
a batch reads only the index buckets and files its own keys may be in.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..config import HarvestConfig
from ..functions.text import parse_ts
from ..operators import select as sel
from ..operators import shards as sh
from ..operators.joins import KEY
from ..operators.scale import first_per_key, null_safe_join, settle
from ..schemas import CHANGE
from ..sources import sinks
from ..sources.key_index import KeyIndex


def run_name(batch_id: int) -> str:
    return f"{batch_id:012d}"


def read_change_stream(spark: SparkSession, landing: str, max_files: int | None = None) -> DataFrame:
    """Landed change events, oldest file first."""
    reader = spark.readStream.schema(CHANGE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(landing)


def run_batches(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Process everything that has landed, then stop; any scheduler can start it again."""
    return (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def pending_payloads(
    spark: SparkSession, path: str, run: str, payloads: DataFrame, wait_runs: int, mode: str = "collapsed",
) -> Callable[[DataFrame], DataFrame]:
    """``ready`` step of ``stage_shard`` for payloads that land after their change.

    A candidate that wants a diff whose payload is not there yet waits: it is written to the snapshot ``path/run=<run>``
    instead of going on. The next run reads the newest snapshot before it, joins those rows with the payloads it sees
    (``attach_diffs``), and lets the found ones go on with their text; the others wait again. After ``wait_runs`` runs a
    row goes on with empty text, as a failed diff does. A replayed run rebuilds its snapshot from the one before, so it
    gives the same rows; dedup comes after this step, so no row is stored twice. ``wait_runs = 0`` never waits.
    """

    def ready(cands: DataFrame) -> DataFrame:
        if wait_runs <= 0:
            return cands
        from ..operators.joins import attach_diffs
        from ..sources.readers import or_empty

        fresh = cands.withColumn("attempts", F.lit(0))
        schema = T.StructType([*fresh.schema.fields, T.StructField("run", T.StringType())])
        snapshots = or_empty(spark, lambda: spark.read.schema(schema).parquet(path), schema)
        last = snapshots.where(F.col("run") < run).select(F.max("run")).first()[0]  # one value
        if last is None:
            rows = fresh
        else:
            waiting = settle(snapshots.where(F.col("run") == last).drop("run", "has_diff"), "waiting")
            retried = attach_diffs(waiting, payloads, mode, "left", F.lit(True), "has_diff")
            rows = fresh.unionByName(retried.withColumn("attempts", F.col("attempts") + 1).select(*fresh.columns))
        rows = settle(rows, "ready")
        waits = F.col("in_budget") & ~F.col("has_diff") & (F.col("attempts") < wait_runs)
        rows.where(waits).write.mode("overwrite").parquet(f"{path}/run={run}")
        return rows.where(~waits).drop("attempts")

    return ready


def harvest_batch(
    spark: SparkSession, payloads: DataFrame | Callable[[], DataFrame], out: str, cfg: HarvestConfig, run_ts: str,
    use_cursor: bool = True, wait_runs: int = 0,
) -> Callable[[DataFrame, int], None]:
    """Handler that builds, stores and accounts for one micro-batch.

    ``payloads`` is a table, or a function that reads the payloads landed so far (called once per batch); with
    ``wait_runs`` > 0 a change whose payload has not landed waits up to that many runs for it (``pending_payloads``).
    """
    shards, state, counters = f"{out}/shards", f"{out}/state", f"{out}/counters"
    keys = KeyIndex(spark, f"{out}/index")

    def handle(batch: DataFrame, batch_id: int) -> None:
        run = run_name(batch_id)
        cursor = sinks.read_cursor_state(spark, state, before=run) if use_cursor else None
        landed = payloads() if callable(payloads) else payloads
        ready = pending_payloads(spark, f"{out}/pending", run, landed, wait_runs)
        index = lambda asked: keys.candidates(asked, before=run)
        staged = sh.stage_shard(batch, landed, index, cursor, cfg, run_ts, ready)
        rows = sh.shard_rows(staged)
        sinks.write_shards(rows, shards, run)
        keys.add_new(rows, run)  # one row per key, none known before
        counts = sh.run_counters(staged, sizes=keys.sizes(before=run))
        counts.write.mode("overwrite").parquet(f"{counters}/run={run}")
        full = null_safe_join(sh.newest_cursor(rows), counts, ["lang"], "inner")
        sinks.append_cursor_state(full.withColumn("updated_at", F.lit(run_ts)), state, run)

    return handle


def dedup_batch(spark: SparkSession, out: str, order: str = "timestamp") -> Callable[[DataFrame, int], None]:
    """Handler that stores the rows whose (lang, dedup_key) no earlier batch has stored.

    Earlier keys are looked up in a key index under ``out/_index`` (hidden from readers of ``out``), which reads only
    the buckets and files the batch's keys may be in, so the cost of a batch does not grow with the batches before it.
    """
    keys = KeyIndex(spark, f"{out}/_index")

    def handle(batch: DataFrame, batch_id: int) -> None:
        run = run_name(batch_id)
        first = settle(first_per_key(batch, KEY, [F.col(order)]), "first")
        known = keys.known(first, before=run).withColumn("__known", F.lit(True))
        fresh = settle(null_safe_join(first, known, KEY, "left").where(F.col("__known").isNull()).drop("__known"), "fresh")
        fresh.write.mode("overwrite").parquet(f"{out}/run={run}")
        keys.add_new(fresh, run)

    return handle


def late_drop_batch(out: str, state: DataFrame) -> Callable[[DataFrame, int], None]:
    """Handler that drops events at or before the cursor the run started with."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        timed = batch.withColumn("ts", parse_ts(F.col("timestamp")))
        sel.after_cursor(timed, state).drop("ts").write.mode("overwrite").parquet(f"{out}/run={run_name(batch_id)}")

    return handle


def dedup_within_watermark(stream: DataFrame, ts: str, delay: str) -> DataFrame:
    """Bounded-state alternative: duplicates are recognised within ``delay`` of event time only."""
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp"))
    return timed.withWatermark(ts, delay).dropDuplicatesWithinWatermark(KEY)
