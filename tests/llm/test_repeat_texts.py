"""The remaining text of op9_repeats next to its digest."""

from __future__ import annotations

import hashlib
import random

from editsieve.llm.queries import op9_repeats


def test_query_gives_the_remaining_text(spark, tmp_path):
    rng = random.Random(17)
    shared = " ".join(f"s{rng.randrange(10**6)}" for _ in range(90))
    rows = [(i, " ".join(f"u{rng.randrange(10**9)}" for _ in range(60)) + (f" {shared} " if i < 3 else "")) for i in range(8)]
    rows += [(20, None), (21, "short é")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in op9_repeats(spark, str(tmp_path)).collect()}
    assert set(got) == {r[0] for r in rows}
    for i, text in rows:
        r = got[i]
        assert hashlib.sha256(r.text.encode()).hexdigest() == r.kept_sha256
        assert len(r.text.encode()) == r.n_bytes - r.n_removed
        assert (shared in r.text, r.n_spans) == (False, 1) if i < 3 else r.text == (text or "")
