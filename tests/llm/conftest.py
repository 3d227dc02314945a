from __future__ import annotations

import pytest

from tests.conftest import spark  # noqa: F401  one session for all tests

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def table(spark):  # noqa: F811
    """A documents table from (doc_id, text[, lang[, source]]) tuples, with columns of names the operators use themselves."""

    def make(rows, schema=DOCS):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s0", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, schema)
        return df.selectExpr("*", "1L AS key", "'x' AS bucket", "2L AS k1", "3 AS part", "'y' AS row", "0.5D AS score", "7L AS n")

    return make


def odd_rows():
    """Nulls, empty and blank texts, ties, repeated rows, a long text, and characters of several bytes."""
    long = " ".join(f"wörd{i % 977} longish{i % 31}," for i in range(6000))
    base = "the quick brown fox jumps over the lazy dog and then it sleeps again under the old oak tree near a river "
    return [
        (5, base * 3, "en", "a"), (5, base * 3, "en", "a"), (2, base * 3 + "one more word", None, None), (None, "only null id text here", "de", "b"),
        (7, None, "fr", "a"), (8, "", "fr", "b"), (9, " \t\n ", None, "b"), (10, long, "de", "c"), (5, "same id, other text é中文 | <b>", "en", "c"),
        (11, "  two  blanks\n \n and lines \n", "en", "a"), (-3, "A B C", "en", "a"), (12, "a a a a a a a", "en", "a"), (13, "x<|endoftext|>y", "en", "a"),
    ]
