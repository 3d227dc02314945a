"""Stages that carry the input columns take names with blanks, colons and other signs."""

from __future__ import annotations

from editsieve.llm.repeats import remove_passages
from editsieve.llm.toxicity import reject_toxic
from tests.llm.conftest import odd_rows


def test_stages_keep_odd_column_names(spark, table):
    docs = table(odd_rows()).selectExpr("*", "'v' AS `my col:x`", "1 AS `a.b`", "2 AS `weird (name)`")
    labels = spark.createDataFrame([(5, 1, 0), (8, 0, 1)], "doc_id long, quality int, toxic int")
    kept = reject_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.count() <= docs.count()
    cut = remove_passages(docs)
    assert cut.columns == docs.columns and cut.count() == docs.count()
    assert {r["my col:x"] for r in cut.collect()} == {"v"}
