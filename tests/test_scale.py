"""Skew-safe building blocks against brute force, with their limits forced low."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from editsieve.operators import scale as sc

from .conftest import rows


@pytest.fixture(scope="module")
def data(spark):
    """Group ``a`` holds half of all rows and one value of ``t`` holds a third of them."""
    rnd = random.Random(7)
    out = []
    for i in range(600):
        g = "a" if i % 2 else rnd.choice(["b", "c", None])
        t = 50 if rnd.random() < 0.33 else rnd.randrange(100)
        out.append((i, g, t, rnd.choice(["x", "y", ""])))
    return out


def _frame(spark, data):
    return spark.createDataFrame(data, "id int, g string, t int, u string").repartition(4)


@pytest.mark.parametrize("task_rows", [1, 10_000])
@pytest.mark.parametrize("n", [0, 37, 10_000])
def test_keep_first_matches_sorting(spark, data, task_rows, n):
    order = [F.col("t"), F.col("id")]
    levels = [F.floor(F.col("t") / 10), F.col("t"), F.floor(F.col("id") / 16)]
    got = sc.keep_first(_frame(spark, data), ["g"], order, levels, F.lit(n), task_rows=task_rows)
    groups = defaultdict(list)
    for i, g, t, _ in data:
        groups[g].append((t, i))
    want = sorted(((i,) for g in groups for _, i in sorted(groups[g])[:n]), key=repr)
    assert rows(got, "id") == want


def test_keep_first_with_a_quota_per_group(spark, data):
    caps = spark.createDataFrame([("a", 5), ("b", 0), (None, 7)], "g string, cap int")
    got = sc.keep_first(
        _frame(spark, data), ["g"], [F.col("id")], [F.floor(F.col("id") / 8)], F.coalesce("cap", F.lit(2)), caps, task_rows=3
    )
    assert {r.g: r["count"] for r in got.groupBy("g").count().collect()} == {"a": 5, None: 7, "c": 2}


@pytest.mark.parametrize("hot_rows", [1_000_000, 30, 1])
def test_attach_count(spark, data, hot_rows):
    got = sc.attach_count(_frame(spark, data), F.col("g"), "n", hot_rows=hot_rows)
    want = Counter(g for _, g, _, _ in data)
    assert got.count() == len(data)
    assert all(r.n == want[r.g] for r in got.collect())


def test_first_per_key_keeps_one_row_and_counts_copies(spark, data):
    got = sc.first_per_key(_frame(spark, data), ["g", "t"], [-F.col("id")], copies=F.count(F.lit(1)))
    best, n = {}, Counter()
    for i, g, t, u in data:
        n[g, t] += 1
        if (g, t) not in best or i > best[g, t][0]:
            best[g, t] = (i, u)
    assert rows(got, "g", "t", "id", "u", "copies") == sorted(((g, t, *best[g, t], n[g, t]) for g, t in best), key=repr)


def test_first_per_key_combines_before_the_shuffle(spark, data):
    plan = sc.first_per_key(_frame(spark, data), ["g"], [F.col("id")])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan


def test_running_totals(spark):
    values = random.Random(3).sample(range(1000), 200)
    df = spark.createDataFrame([(v, v % 7) for v in values], "s int, x int").repartition(5)
    got = {r.s: r.below for r in sc.running_totals(df, "s", {"x": "below"}).collect()}
    assert got == {v: sum(w % 7 for w in values if w < v) for v in values}


@pytest.mark.parametrize("n", [1, 10, 500])
def test_newest_global_and_largest(spark, n):
    ids = random.Random(5).sample(range(10_000), 300)
    for spread in (1, 1 << 40, -(1 << 45)):
        far = spark.createDataFrame([(i * spread,) for i in ids], "id long")
        assert rows(sc.newest_global(far, "id", n)) == sorted(((i,) for i in sorted(i * spread for i in ids)[-n:]), key=repr)
    df = spark.createDataFrame([(i, f"k{i}") for i in ids], "id long, k string")
    assert rows(sc.newest_global(df, "id", n), "id") == sorted(((i,) for i in sorted(ids)[-n:]), key=repr)
    tied = spark.createDataFrame([(1 + i % 20, f"k{i:05d}") for i in ids], "c long, k string")
    want = sorted(((1 + i % 20, f"k{i:05d}") for i in ids), key=lambda r: (-r[0], r[1]))[:n]
    assert rows(sc.largest(tied, "c", n, "k")) == sorted(want, key=repr)


def test_settle_uses_the_checkpoint_folder_and_gives_a_true_size(spark):
    df = sc.settle(spark.range(1000), "x")
    assert all(f.replace("file://", "").startswith(sc.shared_dir(spark).replace("file:", "")) for f in df.inputFiles())
    assert df.count() == 1000
