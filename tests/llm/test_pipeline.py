"""The stages of the pipeline on a small table, each against what it must do to its own input."""

from __future__ import annotations

import random

import corpus_pipeline
import pytest

from tests.llm.conftest import odd_rows
from tests.llm.test_scores import prose


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(12)
    passage = prose(rng, 90)
    rows = []
    for i in range(240):
        text = prose(rng, 150, ["scumbag", "worthless", "moronic"] if i % 6 == 0 else ())
        if i % 10 == 1:
            text += " " + passage
        rows.append((i, text, rng.choice(["en", "de"]), rng.choice(["a", "a", "b"]), len(text)))
    rows += [(300 + i, rows[2][1], "en", "b", 1) for i in range(5)]
    rows += [(400 + i if r[0] is not None else None, r[1], "en", "a", 0) for i, r in enumerate(odd_rows())]
    home = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{home}/documents.parquet")
    labels = [(i, 1, int(i % 6 == 0)) for i in range(240) if i % 3 != 1]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{home}/labels.parquet")
    return str(home), passage


def test_stages(spark, folder):
    home, passage = folder
    docs = spark.read.parquet(f"{home}/documents.parquet")
    columns, tables = docs.columns, []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, home)
        docs.write.parquet(f"{home}/stage{i}")
        docs = spark.read.parquet(f"{home}/stage{i}")
        tables.append(docs)
        assert i == 4 or docs.columns == columns
    clean, single, cut, mixed, packed = tables
    ids = {r.doc_id for r in clean.collect()}
    assert sum(i in ids for i in range(0, 240, 6)) <= 6 and sum(i in ids for i in range(240) if i % 6) >= 195
    ids = {r.doc_id for r in single.collect()}
    assert 2 in ids and not ids & set(range(300, 305))
    assert single.where(f"text LIKE '%{passage}%'").count() > 1 and cut.where(f"text LIKE '%{passage}%'").count() == 0
    assert cut.count() == single.count() and mixed.count() < cut.count()
    assert {r.doc_id for r in packed.select("doc_id").collect()} == {r.doc_id for r in mixed.select("doc_id").collect()}
    rows = corpus_pipeline.run(spark, home)
    assert rows.columns == packed.columns and rows.count() == packed.count()


def test_entry_lists_all_queries():
    from __spark_entry__ import queries

    names = set(queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
