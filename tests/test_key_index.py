"""Key index: results equal a plain set, lookups prune buckets and files, reads stay flat over runs."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from editsieve.sources.key_index import KeyIndex

SCHEMA = "lang string, dedup_key string, other long"


def batch(spark, keys):
    return spark.createDataFrame([(lang, key, 1) for lang, key in keys], SCHEMA)


def test_known_and_add_equal_a_plain_set(spark, tmp_path):
    index = KeyIndex(spark, str(tmp_path / "ix"), bits=4)
    rng = random.Random(1)
    seen: set = set()
    for run in range(4):
        keys = [(rng.choice(["en", "de", None, ""]), rng.choice([f"k{rng.randint(0, 300)}", None, ""])) for _ in range(120)]
        keys += keys[:10]  # repeated rows
        df = batch(spark, keys)
        name = f"{run:04d}"
        got = {tuple(r) for r in index.known(df, before=name).collect()}
        assert got == {k for k in keys if k in seen}
        added = {tuple(r) for r in index.add(df, name).collect()}
        assert added == set(keys) - seen
        seen |= set(keys)
        # a replayed run replaces its own files and finds what earlier runs hold, not itself
        assert {tuple(r) for r in index.add(df, name).collect()} == added
    sizes = {r.lang: r.size for r in index.sizes().collect()}
    want: dict = {}
    for lang, _ in seen:
        want[lang] = want.get(lang, 0) + 1
    assert sizes == want


def test_lookup_prunes_buckets_and_files_and_shuffles_no_index_row(spark, tmp_path, capsys):
    index = KeyIndex(spark, str(tmp_path / "ix"), bits=6)
    index.add(batch(spark, [("en", f"key{i}") for i in range(5000)]), "0001")
    asked = batch(spark, [("en", "key7"), ("en", "new")])
    capsys.readouterr()
    index.known(asked).explain("formatted")
    plan = capsys.readouterr().out
    nodes = plan.split("\n\n")
    scan = [n for n in nodes if "Scan parquet" in n and "/ix/keys" in n]
    assert len(scan) == 1 and "PartitionFilters: [" in scan[0] and "bucket#" in scan[0].split("PartitionFilters")[1]
    assert "Exchange" not in plan.split("BroadcastExchange")[0].replace("BroadcastExchange", "")
    assert "BroadcastHashJoin" in plan and "ShuffleExchange" not in plan and "Exchange hashpartitioning" not in plan
    assert {tuple(r) for r in index.known(asked).collect()} == {("en", "key7")}


def test_reads_stay_flat_over_ten_runs(spark, tmp_path):
    index = KeyIndex(spark, str(tmp_path / "ix"), bits=6)
    read = []
    for run in range(10):
        keys = [("en", f"r{run}-{i}") for i in range(400)] + [("en", "r0-1")]  # one old key per batch
        df = batch(spark, keys)
        name = f"{run:04d}"
        found = index.candidates(df, before=name)
        read.append(found.count())
        known = {tuple(r) for r in index.known(df, before=name).collect()}
        assert known == ({("en", "r0-1")} if run else set())
        index.add(df, name)
    # the index grows by 400 keys a run; rows read per lookup do not grow with it
    assert max(read[5:]) <= 3 * max(read[1:5]) and read[-1] < 400 * 9 / 4
