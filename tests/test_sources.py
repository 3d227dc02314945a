"""Files in, files out."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from editsieve import config
from editsieve.schemas import SAMPLE_COLUMNS
from editsieve.sources import readers as rd
from editsieve.sources import sinks

from .conftest import rows

RUN = "2024-05-01T00:00:00Z"


def test_corpus_file(spark, tmp_path):
    lines = [
        json.dumps({"lang": "en", "title": "T", "reverter": "R", "timestamp": "2024-01-01T00:00:00"}), "", "   ", "not json",
        "[1,2]", "5", "null", json.dumps({"title": 7, "comment": 0, "added_text": False, "removed_text": True}),
        json.dumps({"lang": None, "title": "L", "comment": "0"}), '"{}"',
    ]
    (tmp_path / "c.jsonl").write_text("\n".join(lines))
    out = rd.parse_corpus(rd.read_lines(spark, str(tmp_path / "c.jsonl")), RUN)
    assert out.columns == SAMPLE_COLUMNS
    assert rows(out, "lang", "title", "user", "comment", "added_text", "removed_text", "label", "timestamp") == sorted([
        ("en", "T", "R", "", "", "", 1, "2024-01-01T00:00:00Z"), ("fr", "7", "", "", "", "True", 1, RUN),
        ("", "L", "", "0", "", "", 1, RUN)], key=repr)
    assert rd.parse_corpus(rd.read_lines(spark, str(tmp_path / "none.jsonl")), RUN).count() == 0


def test_json_map_file(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"1": {"title": "T", "creator": "C"}, "2": 5, "3": {}, "4": "{}", "5": [1]}, indent=2))
    out = rd.parse_bot_db(rd.read_documents(spark, str(tmp_path / "a.json")), "en", RUN)
    assert rows(out, "lang", "title", "user", "source") == [("en", "", "", "bot_revert"), ("en", "T", "C", "bot_revert")]
    (tmp_path / "b.json").write_text("[1]")
    assert rd.parse_bot_db(rd.read_documents(spark, str(tmp_path / "b.json")), "en", RUN).count() == 0


def test_change_events(spark, tmp_path):
    data = [(i, "2024-01-01T00:00:00", None if i % 2 else "en", "t", "c", "REVERTED" if i == 9 else None, 1.23456, None, "p", None, 3)
            for i in range(10)]
    df = spark.createDataFrame(data, "id long, ts_utc string, lang string, title string, creator string, action string, score double, "
                                     "reason string, matched_patterns string, added_len int, removed_len int")
    df.write.parquet(str(tmp_path / "e"))
    out = rd.parse_change_events(rd.read_change_events(spark, str(tmp_path / "e")), RUN, limit=2)
    assert rows(out, "lang", "label", "added_text", "removed_text") == [
        ("en", 0, "len_added=0 score=1.235 patterns=p", "len_removed=3"), ("fr", 1, "len_added=0 score=1.235 patterns=p", "len_removed=3")]
    assert rd.parse_change_events(rd.read_change_events(spark, str(tmp_path / "no")), RUN).count() == 0


def test_shard_files_of_any_shape(spark, tmp_path):
    path = str(tmp_path / "s")
    spark.createDataFrame([("fr", "A", None, None)], "lang string, title string, source string, label long").write.parquet(path)
    spark.createDataFrame([("B", 1, "src", 3)], "title string, label int, source string, extra int").write.mode("append").parquet(path)
    (tmp_path / "s" / "broken.parquet").write_bytes(b"nothing")
    (tmp_path / "s" / "note.txt").write_text("x")
    out = rd.parse_shards(rd.read_shards(spark, path), RUN)
    got = rows(out.withColumn("source", F.regexp_replace("source", "part-.*", "*")), "lang", "title", "label", "source")
    assert got == [("fr", "A", 0, "shard:*"), ("fr", "B", 1, "src")]


@pytest.mark.parametrize("text,want", [
    ('{"threshold": 0.4, "features": ["text"], "model_version": "v"}', (0.4, ["text"], "v")), ("{broken", (None, None, None)),
    ("[1]", (None, None, None)), ('{"threshold": "x", "features": 3}', (None, None, None)),
])
def test_metadata(spark, tmp_path, text, want):
    (tmp_path / "m.json").write_text(text)
    row = rd.read_metadata(spark, str(tmp_path / "m.json")).first()
    assert (row.threshold, row.features, row.model_version) == want


def test_human_reverts_swap_and_inner_join(spark):
    changes = spark.createDataFrame(
        [("fr", "edit", "T", "u", "rvv", "2024-04-30T00:00:00Z", [], 2, 1), ("fr", "edit", "U", "u", "rvv", "2024-04-29T00:00:00Z", [], 4, 3),
         ("fr", "edit", "V", "u", "rvv", "2023-04-29T00:00:00Z", [], 6, 5), ("fr", "edit", "W", "u", "ok", "2024-04-30T00:00:00Z", [], 8, 7)],
        "lang string, type string, title string, user string, comment string, timestamp string, tags array<string>, revid long, old_revid long")
    payloads = spark.createDataFrame(
        [(1, 2, '<td class="diff-deletedline">bad &eacute;</td><td class="diff-addedline">good</td>'), (5, 6, ""), (7, 8, "")],
        "old_revid long, revid long, compare_html string")
    out = rd.human_reverts(changes, payloads, 30, 100, 50, RUN)
    assert rows(out, "title", "added_text", "removed_text", "label") == [("T", "bad é", "good", 1)]
    recent = rd.recent_changes(changes, payloads, 2, RUN)
    assert rows(recent, "title", "label") == [("T", 1), ("W", 0)]


def test_union_order_and_switches(spark, tmp_path):
    (tmp_path / "c.jsonl").write_text('{"title":"x"}\n')
    (tmp_path / "b.json").write_text('{"1":{"title":"y"}}')
    out = rd.collect_training_samples(spark, {"corpus": str(tmp_path / "c.jsonl"), "bot_db_en": str(tmp_path / "b.json")}, RUN)
    assert rows(out, "source_rank", "lang", "title") == [(0, "fr", "x"), (1, "en", "y")]
    with pytest.raises(ValueError):
        rd.union_ranked([None])
    assert config.CollectConfig().recent_changes_cap is None and config.CollectConfig().revert_scan == (30, None, None)
    assert config.CollectConfig(recent_changes_max=7).recent_changes_cap == 7
    assert config.CollectConfig(recent_changes_hard_cap=5, human_revert_max_diffs=1).recent_changes_cap == 100
    assert config.HarvestConfig().scan_cap is None and config.HarvestConfig(hard_cap=5).scan_cap == 1000


def test_languages_that_are_null_or_empty_come_back(spark, tmp_path):
    from editsieve.operators.joins import drop_known_keys
    from editsieve.schemas import SHARD

    def shard(lang, key):
        return tuple({"lang": lang, "dedup_key": key}.get(f.name) for f in SHARD.fields)

    table = spark.createDataFrame([shard("fr", "a"), shard(None, "b"), shard("", "c")], SHARD)
    sinks.write_shards(table, str(tmp_path / "s"), "1")
    sinks.append_dedup_keys(table, str(tmp_path / "k"), "1")
    want = rows(table, "lang", "dedup_key")
    assert rows(sinks.read_shard_table(spark, str(tmp_path / "s")), "lang", "dedup_key") == want
    index = sinks.read_dedup_keys(spark, str(tmp_path / "k"))
    assert rows(index, "lang", "dedup_key") == want
    assert drop_known_keys(table.select("lang", "dedup_key"), index).count() == 0


def test_shards_with_another_label_type(spark, tmp_path):
    base = "'fr' AS lang, 't' AS title, 'u' AS user, '' AS comment, '' AS added_text, '' AS removed_text"
    for i, label in enumerate(["1L", "CAST(1.0 AS DOUBLE)", "CAST(1 AS INT)", "CAST(0.0 AS FLOAT)", "CAST(NULL AS DOUBLE)"]):
        spark.sql(f"SELECT {base}, {label} AS label, 's{i}' AS source, '' AS timestamp").write.mode("append").parquet(str(tmp_path))
    (tmp_path / "broken.parquet").write_bytes(b"not parquet at all")
    assert rows(rd.parse_shards(rd.read_shards(spark, str(tmp_path)), RUN), "source", "label") == [
        ("s0", 1), ("s1", 1), ("s2", 1), ("s3", 0), ("s4", 0)]
    assert [f.rsplit("/", 1)[-1] for f in rd.skipped_shards(spark, str(tmp_path))] == ["broken.parquet"]


def test_a_map_too_large_to_parse_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(rd, "VARIANT_BYTES", 10)
    broken = spark.createDataFrame([('{"1": {"title": "never closed"',)], "value string")
    with pytest.raises(Exception, match="100 MB"):
        rd.parse_bot_db(broken, "fr", RUN).collect()


def test_empty_run_keeps_the_schema_and_the_cursor(spark, tmp_path):
    from editsieve.schemas import SHARD

    path, state = str(tmp_path / "shards"), str(tmp_path / "state")
    sinks.write_shards(spark.createDataFrame([], SHARD), path, "1")
    assert sinks.read_shard_table(spark, path).count() == 0
    sinks.append_cursor_state(spark.createDataFrame([("fr", "2024", 1), ("en", "2024", 1)], "lang string, last_timestamp string, last_revid long"), state, "1")
    sinks.append_cursor_state(spark.createDataFrame([("fr", "2025", 2)], "lang string, last_timestamp string, last_revid long"), state, "2")
    assert rows(sinks.read_cursor_state(spark, state), "lang", "last_timestamp") == [("en", "2024"), ("fr", "2025")]
    assert rows(sinks.read_cursor_state(spark, state, before="2"), "lang", "last_timestamp") == [("en", "2024"), ("fr", "2024")]
