"""op11: vector codes against a plain version of the whole procedure."""

from __future__ import annotations

import hashlib
import math

import numpy as np

from editsieve.llm import vector_codes as vc



def order(r):
    return (r[0] is None, r[0] or 0, r[1:])


def plain(rows, parts=vc.PARTS, entries=vc.ENTRIES, rounds=vc.ROUNDS):
    """Direct distances, no value dictionaries: {vec_id: (code, error, label_error)}, digest."""
    kept = [(i, lab, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v, lab in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] if r[0] is not None else 0, r[2]))
    if not kept:
        return {}, None
    dim = len(kept[0][2])
    kept = [r for r in kept if len(r[2]) == dim]
    w = dim // parts
    books = [[list(r[2][p * w:(p + 1) * w]) for r in kept[:entries]] for p in range(parts)]

    def nearest(v, p):
        d = [sum((a - b) ** 2 for a, b in zip(v[p * w:(p + 1) * w], e)) for e in books[p]]
        k = min(range(len(d)), key=lambda i: (d[i], i))
        return k, d[k]

    for _ in range(rounds):
        sums = {}
        for _, _, v in kept:
            for p in range(parts):
                k, _ = nearest(v, p)
                s = sums.setdefault((p, k), [[0] * w, 0])
                s[0] = [a + b for a, b in zip(s[0], v[p * w:(p + 1) * w])]
                s[1] += 1
        for (p, k), (tot, n) in sums.items():
            books[p][k] = [t // n for t in tot]
    out, per_label = [], {}
    for i, lab, v in kept:
        got = [nearest(v, p) for p in range(parts)]
        err = sum(d for _, d in got)
        out.append((i, lab, "".join(f"{k:02x}" for k, _ in got), err))
        per_label[lab] = per_label.get(lab, 0) + err
    digest = hashlib.sha256(",".join(str(x) for p in books for e in p for x in e).encode()).hexdigest()
    return sorted(((i, c, e, per_label[lab]) for i, lab, c, e in out), key=order), digest


def run(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr(
        "*", "'clash' AS code", "1.5D AS error", "2L AS part", "3 AS entry", "'x' AS v")
    got = vc.compress_vectors(spark, df).collect()
    return sorted(((r.vec_id, r.code, r.error, r.label_error) for r in got), key=order), {r.codebooks_sha256 for r in got}


def test_matches_plain_version(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(x) for x in rng.normal(0, 0.3, 32)], int(i % 3) if i % 5 else None) for i in rng.permutation(150)]
    rows += [rows[4], rows[7]]  # repeated rows
    rows += [(1000, None, 1), (1001, [1.0] * 31 + [float("nan")], 1), (1002, [float("inf")] * 32, 2), (1003, [None] * 32, 0)]
    rows += [(1004, [0.1] * 16, 1), (None, [0.25] * 32, None)]
    want, digest = plain(rows)
    got, digests = run(spark, rows)
    assert len(got) == 153
    assert [r for r in got if r[0] is not None] == [r for r in want if r[0] is not None]
    assert digests == {digest}


def test_few_vectors_and_ties(spark):
    rows = [(3, [0.5] * 16, 1), (1, [0.5] * 16, 1), (2, [-0.01] * 16, None)]
    want, digest = plain(rows)
    got, digests = run(spark, rows)
    assert got == want and digests == {digest}
    assert [c for _, c, _, _ in got] == ["00" * 16, "01" * 16, "00" * 16]  # vector 3 equals entries 0 and 2: the lower wins


def test_empty_and_nothing_kept(spark):
    assert run(spark, [])[0] == []
    assert run(spark, [(1, None, 1), (2, [float("nan")] * 16, 1)])[0] == []
