"""Tables are read once, text is cut before joins, and only what is asked for is extracted; the rows stay the same."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from editsieve.operators import joins
from editsieve.operators.scale import settle
from editsieve.plans import model as md
from editsieve.schemas import NUMERIC_FEATURES
from editsieve.sources import readers as rd
from editsieve.workload import fixtures as fx

from .conftest import rows

CHANGE = "lang string, type string, title string, user string, comment string, timestamp string, tags array<string>, revid long, old_revid long"
PAYLOAD = "old_revid long, revid long, compare_html string"


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _tables(spark, home):
    text = "Ω" + "abc def " * 30
    docs = [(i, text + str(i), "fr" if i % 2 else None, f"s{i % 3}") for i in range(40)]
    docs += [(3, text, "en", "again"), (5, None, "en", None), (6, "", "en", "x"), (None, "t", "en", "x"), (90, "no event", "en", "x")]
    kinds = ["view", "click", "signup", "purchase", "error", None]
    events = [(i, i * 37, kinds[i % 6], dt.datetime(2024, 1, 1 + i % 28)) for i in range(41)] + [(9, None, "purchase", None), (None, 1, "view", None)]
    labels = [(i, i % 2, int(i % 5 == 0)) for i in range(0, 40, 2)] + [(4, 1, 0), (8, None, None), (None, 1, 1)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").write.parquet(f"{home}/documents.parquet")
    spark.createDataFrame(events, "event_id long, user_id long, event_type string, ts timestamp_ntz").write.parquet(f"{home}/events.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{home}/labels.parquet")


def test_edits_read_the_documents_once_and_equal_the_sql(spark, tmp_path):
    home = str(tmp_path)
    _tables(spark, home)
    sql = f"WITH base AS ({fx._BASE}) {fx._TWICE}"
    for name in ("documents", "events", "labels"):
        spark.read.parquet(f"{home}/{name}.parquet").createOrReplaceTempView(f"{name}")
    try:
        want = fx._finish(spark.sql(sql))
        got = fx.edits(spark, home)
        assert got.schema.simpleString() == want.schema.simpleString()
        assert rows(got) == rows(want) and got.count() > 40
    finally:
        for name in ("documents", "events", "labels"):
            spark.catalog.dropTempView(name)
    assert _plan(got).count("Union") == 0
    # Titles alone carry no text through the join.
    top = _plan(got.select("title")).split("Join")[0]
    assert "added_text" not in top and "text#" not in top


def test_time_window_is_not_pushed_into_the_scans(spark, monkeypatch):
    data = [("fr", "edit", f"T{i}", "u", "Rv x", f"2024-01-{20 + i:02d}T00:00:00Z", [], i + 1, i + 100) for i in range(10)]
    changes = spark.createDataFrame(data, CHANGE)
    payloads = spark.createDataFrame([(i + 100, i + 1, f'<td class="diff-deletedline">bad{i}</td>') for i in range(10)], PAYLOAD)
    seen, window = [], rd.sel.within_days

    def spied(df, *args):
        seen.append(_plan(df))
        return window(df, *args)

    monkeypatch.setattr(rd.sel, "within_days", spied)
    out = rd.human_reverts(changes, payloads, 5, 100, 3, "2024-01-31T00:00:00Z")
    assert rows(out, "title", "added_text") == [("T7", "bad7"), ("T8", "bad8"), ("T9", "bad9")]
    assert len(seen) == 1 and "Aggregate" not in seen[0] and "LogicalRDD" not in seen[0]


def test_few_ids_narrow_the_payloads_before_extraction(spark, monkeypatch):
    cols = "lang string, title string, user string, timestamp string, revid long, old_revid long"
    changes = settle(spark.createDataFrame([("fr", "a", "u", "t", 5, 4), ("fr", "b", "u", "t", 7, 6), ("fr", "c", "u", "t", None, 4)], cols), "changes")
    html = '<td class="diff-addedline">%s</td>'
    pay = [(4, 5, html % "two"), (4, 5, html % "one"), (8, 9, html % "other"), (None, 5, html % "null")]
    payloads = settle(spark.createDataFrame(pay, PAYLOAD), "payloads")
    got = joins.attach_diffs(changes, payloads)
    assert "LeftSemi" in _plan(got)
    want = [("a", "one", ""), ("b", "", ""), ("c", "", "")]
    assert rows(got, "title", "added_text", "removed_text") == want
    monkeypatch.setattr(joins, "FEW_IDS", 1)
    many = joins.attach_diffs(changes, payloads)
    assert "LeftSemi" not in _plan(many) and rows(many, "title", "added_text", "removed_text") == want


def test_features_carry_no_names_of_their_entries(spark):
    texts = spark.createDataFrame([("le chat noir",), ("le chat",), ("",)], "text string")
    table = texts.select("text", *(F.lit(float(i)).alias(c) for i, c in enumerate(NUMERIC_FEATURES)))
    cfg = md.TrainConfig(word_vocabulary=50, char_vocabulary=50)
    model = md.feature_stages(table, cfg)
    out = model.transform(md.gram_columns(table))
    assert out.schema["features"].metadata == {}
    before = md.PipelineModel([*model.stages[:-1], md.assembler()]).transform(md.gram_columns(table))
    assert "attrs" in str(before.schema["features"].metadata)
    assert rows(out, "text", "features") == rows(before, "text", "features")
