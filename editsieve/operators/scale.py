"""Building blocks that keep big and skewed inputs spread over the cluster.

* ``settle``        write an intermediate table to the shared folder and read it back; ``release`` deletes it
* ``first_per_key`` keep one row per key with a map-side combine
* ``attach_count``  give each row the size of its group without sending a group to one task
* ``rank_cuts`` / ``mark_first``  exact "first n of each group" without sorting a group in one task
* ``running_totals``  exact prefix sums without a single-task window

No operator here hints a broadcast of data of unknown size. Small results are settled
first, so the planner sees their true size on disk: below
``spark.sql.autoBroadcastJoinThreshold`` it broadcasts, above it shuffles.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Rows one task may sort when the last undecided part of a group is ranked.
TASK_ROWS = 1_000_000
# Rows of one key from which it counts as hot: what one task may get of a key in a join.
HOT_ROWS = 5_000_000


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables: the session's checkpoint folder."""
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if base:
        return base.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="editsieve-"))
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once and continue from the written table.

    Cuts the lineage, survives lost executors, keeps column pruning, and gives the
    planner a true size for what follows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.settled_at = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete tables of ``settle`` that nothing will read again, so that a long job does not keep all its steps on disk.

    Spark deletes the shuffle files of a finished query once the driver's collector has found its plan unused; it is asked to look.
    """
    for df in tables:
        path = getattr(df, "settled_at", None)
        if path:
            sc = df.sparkSession.sparkContext
            at = sc._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)
            sc._jvm.java.lang.System.gc()


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join in which a null key matches a null key."""
    renamed = right
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"__r_{k}")
    on = F.lit(True)
    for k in keys:
        on = on & left[k].eqNullSafe(renamed[f"__r_{k}"])
    return left.join(renamed, on, how).drop(*(f"__r_{k}" for k in keys))


# --- one row per key -----------------------------------------------------------------

def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], **extra: Column) -> DataFrame:
    """Row of each key with the smallest ``order`` (all ascending; null first).

    ``extra`` are further aggregates over the rows of the key, added as columns.

    ``min`` over a struct combines on the map side, so a key with billions of copies
    sends one row per map task. The 64-bit hash in front only speeds up the sort;
    equality is decided by the key columns themselves.
    """
    rest = [c for c in df.columns if c not in keys]
    ranked = [o.alias(f"o{i}") for i, o in enumerate(order)]
    if rest:
        ranked.append(F.struct(*rest).alias("row"))
    aggs = [F.min(F.struct(*ranked)).alias("__best"), *(a.alias(n) for n, a in extra.items())]
    grouped = df.groupBy(F.xxhash64(*keys).alias("__h"), *keys).agg(*aggs)
    return grouped.select(*keys, *(["__best.row.*"] if rest else []), *extra).select(*df.columns, *extra)


# --- size of each row's group ----------------------------------------------------------

def attach_count(df: DataFrame, key: Column, out: str, *, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add the number of rows that share ``key`` (null is a group of its own).

    Counts are combined on the map side. Keys with more than ``hot_rows`` rows are a small written table; their rows take
    the count from it where they are and never meet in one task. All other rows join the table of counts.
    """
    keyed = df.withColumn("__k", key)
    counts = settle(keyed.groupBy("__k").agg(F.count(F.lit(1)).alias("__n")), "counts")
    hot = settle(counts.where(F.col("__n") > hot_rows), "hot-counts")
    if hot.isEmpty():
        return _take_count(null_safe_join(keyed, counts, ["__k"], "left"), out)
    looked = null_safe_join(keyed, hot.withColumnRenamed("__n", "__hot"), ["__k"], "left")
    there = looked.where(F.col("__hot").isNotNull()).withColumnRenamed("__hot", "__n")
    rest = null_safe_join(looked.where(F.col("__hot").isNull()).drop("__hot"), counts, ["__k"], "left")
    return _take_count(there.unionByName(rest), out)


def _take_count(joined: DataFrame, out: str) -> DataFrame:
    return joined.withColumn(out, F.col("__n")).drop("__k", "__n")


# --- first n rows of each group -----------------------------------------------------------

def rank_cuts(
    rows: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    levels: Sequence[Column],
    quota: Column,
    quota_inputs: DataFrame | None = None,
    task_rows: int | None = None,
) -> DataFrame:
    """Order value of the last row that fits each group's quota.

    ``order`` (ascending, unique within a group) ranks the rows. ``levels`` are coarser
    and coarser-to-finer expressions that never decrease along ``order``; counting
    rows per level value narrows the search to the one value the cut falls into, so only
    that remainder is ever sorted by one task. ``quota`` is computed from ``total`` (rows
    in the group) and the columns of ``quota_inputs`` (one row per group).

    Result: one row per group with ``total``, ``quota`` and ``cut`` (null: nothing to cut).
    """
    limit = TASK_ROWS if task_rows is None else task_rows
    group = list(group)
    names = [f"__l{i}" for i in range(len(levels))]
    keys = settle(
        rows.select(
            *group,
            F.struct(*(o.alias(f"o{i}") for i, o in enumerate(order))).alias("__key"),
            *(l.alias(n) for l, n in zip(levels, names)),
        ),
        "keys",
    )
    totals = keys.groupBy(*group).agg(F.count(F.lit(1)).alias("total"))
    if quota_inputs is not None:
        totals = null_safe_join(totals, quota_inputs, group, "left")
    quotas = settle(totals.select(*group, "total", quota.cast("bigint").alias("quota")), "quotas")
    pending = quotas.where((F.col("quota") > 0) & (F.col("quota") < F.col("total"))).select(
        *group, F.col("quota").alias("__left"), F.col("total").alias("__width")
    )
    path: list[str] = []
    for name in names:
        widest = pending.agg(F.max("__width")).first()[0]
        if widest is None or widest <= limit:
            break
        scope = null_safe_join(keys, pending.drop("__width"), group + path, "inner")
        hist = scope.groupBy(*group, *path, name, "__left").agg(F.count(F.lit(1)).alias("__width"))
        so_far = Window.partitionBy(*group).orderBy(name).rowsBetween(Window.unboundedPreceding, 0)
        upto = hist.withColumn("__upto", F.sum("__width").over(so_far))
        before = F.col("__upto") - F.col("__width")
        path = path + [name]
        pending = settle(
            upto.where((before < F.col("__left")) & (F.col("__upto") >= F.col("__left"))).select(
                *group, *path, (F.col("__left") - before).alias("__left"), "__width"
            ),
            "cut",
        )
    scope = null_safe_join(keys, pending.drop("__width"), group + path, "inner")
    nth = (
        scope.withColumn("__rn", F.row_number().over(Window.partitionBy(*group).orderBy("__key")))
        .where(F.col("__rn") == F.col("__left"))
        .select(*group, F.col("__key").alias("cut"))
    )
    return settle(null_safe_join(quotas, nth, group, "left"), "cuts")


def mark_first(df: DataFrame, cuts: DataFrame, group: Sequence[str], order: Sequence[Column], out: str) -> DataFrame:
    """Add boolean ``out``: the row is within its group's quota. A map-side lookup, no sort."""
    key = F.struct(*(o.alias(f"o{i}") for i, o in enumerate(order)))
    keyed = df.withColumn("__key", key)
    joined = null_safe_join(keyed, cuts.select(*group, "total", "quota", "cut"), group, "left")
    inside = (F.col("quota") >= F.col("total")) | ((F.col("quota") > 0) & (F.col("__key") <= F.col("cut")))
    return joined.withColumn(out, F.coalesce(inside, F.lit(False))).drop("__key", "total", "quota", "cut")


def keep_first(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    levels: Sequence[Column],
    quota: Column,
    quota_inputs: DataFrame | None = None,
    task_rows: int | None = None,
) -> DataFrame:
    cuts = rank_cuts(df, group, order, levels, quota, quota_inputs, task_rows)
    return mark_first(df, cuts, group, order, "__in").where("__in").drop("__in")


def newest_global(df: DataFrame, key: str, n: int) -> DataFrame:
    """``n`` rows with the largest unique integer ``key``.

    The floor that leaves ``n`` rows is found from the top bits down: each pass counts rows per value of the next 16
    bits within the band found so far, so no pass has more than 65 536 groups. The floor is a scalar in a
    plain filter, which reaches the scan.
    """
    floor_value, need, scope = None, n, df
    for shift in (48, 32, 16, 0):
        band = F.shiftright(F.col(key).cast("bigint"), shift)
        hist = scope.groupBy(band.alias("__b")).agg(F.count(F.lit(1)).alias("__n"))
        newer = Window.orderBy(F.desc("__b")).rowsBetween(Window.unboundedPreceding, 0)  # at most 65 536 rows
        reached = hist.withColumn("__upto", F.sum("__n").over(newer)).where(F.col("__upto") >= need)
        found = reached.orderBy(F.desc("__b")).first()
        if found is None:
            return df.orderBy(F.desc(key)).limit(n)
        need -= found["__upto"] - found["__n"]
        floor_value = found["__b"] << shift
        scope = scope.where(band == found["__b"])
    return df.where(F.col(key) >= floor_value).orderBy(F.desc(key)).limit(n)


def largest(df: DataFrame, key: str, n: int, tie: str) -> DataFrame:
    """``n`` rows with the largest positive integer ``key``; ``tie`` (ascending, unique) settles ties.

    As above with bands on a log scale, since counts are far from uniform.
    """
    band = F.floor(F.log2(F.col(key)) * 64).cast("bigint")
    hist = df.groupBy(band.alias("__b")).agg(F.count(F.lit(1)).alias("__n"))
    higher = Window.orderBy(F.desc("__b")).rowsBetween(Window.unboundedPreceding, 0)
    reached = hist.withColumn("__above", F.sum("__n").over(higher) - F.col("__n")).where(F.col("__above") < n)
    floor_value = reached.agg(F.min("__b")).scalar()
    return df.where(band >= floor_value).orderBy(F.desc(key), F.asc(tie)).limit(n)


# --- prefix sums ------------------------------------------------------------------------------

def running_totals(df: DataFrame, order: str, sums: dict[str, str]) -> DataFrame:
    """Add, for each ``{column: name}``, the sum of ``column`` over rows with smaller ``order``.

    Rows are range-partitioned by ``order`` (unique values), summed per range, and each
    range starts from the total of the ranges below it. The table of range totals has one
    row per partition.
    """
    ranged = settle(df.repartitionByRange(order).withColumn("__part", F.spark_partition_id()), "ranges")
    per_part = ranged.groupBy("__part").agg(*(F.sum(c).alias(f"__t_{c}") for c in sums))
    below = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    base = settle(
        per_part.select(
            "__part", *(F.coalesce(F.sum(f"__t_{c}").over(below), F.lit(0)).alias(f"__base_{c}") for c in sums)
        ),
        "range-totals",
    )
    inside = Window.partitionBy("__part").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    out = ranged.join(base, "__part")
    for c, name in sums.items():
        out = out.withColumn(name, F.col(f"__base_{c}") + F.coalesce(F.sum(c).over(inside), F.lit(0)))
    return out.drop("__part", *(f"__base_{c}" for c in sums))


def checked(df: DataFrame, predicate: Callable[[int], bool], message: Callable[[int], str]) -> DataFrame:
    """Return ``df`` when its row count passes, raise otherwise."""
    n = df.count()
    if not predicate(n):
        raise ValueError(message(n))
    return df
