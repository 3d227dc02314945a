"""Stage 2 of the pipeline against all pairs of plain fingerprints."""

from __future__ import annotations

import random

import corpus_pipeline
import xxhash

from editsieve.llm.simhash import NEAR, near_links
from tests.llm.test_duplicates import LOWER, WORD, plain_components


def plain_near_fingerprint(text):
    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return 0
    if len(w) < 16:
        return xxhash.xxh64_intdigest(" ".join(w).encode(), 42)
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 2]).encode(), 42) for i in range(len(w) - 1)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_stage_drops_what_lies_in_the_hamming_ball(spark, table):
    """One of each component of fingerprints within 7 bits; most edits of one word in forty are among them."""
    rng = random.Random(4)
    rows = []
    for i in range(60):
        words = [f"w{rng.randrange(30000)}" for _ in range(rng.randint(150, 300))]
        edited = list(words)
        for at in rng.sample(range(len(words)), len(words) // 40):
            edited[at] = f"x{rng.randrange(30000)}"
        rows += [(i, " ".join(words)), (1000 + i, " ".join(edited))]
    # Short texts, whose fingerprints have few ones, stay apart from each other and from blank ones.
    rows += [(2000 + i, f"a{i} b{i} c{i}") for i in range(300)] + [(3000, None), (3001, " \n"), (3002, "A0 b0  c0")]
    docs = table(rows)
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    group = dict(zip((r[0] for r in rows), plain_components([plain_near_fingerprint(r[1]) for r in rows], NEAR["radius"])))
    got = [r.doc_id for r in kept.collect()]
    assert sorted(got) == sorted(min(i for i in group if group[i] == g) for g in set(group.values()))
    assert set(range(60)) <= set(got) and sum(1000 + i not in got for i in range(60)) >= 30
    assert {2000 + i for i in range(300)} <= set(got) and 3000 in got and not {3001, 3002} & set(got)


def test_links_of_a_scattered_family(spark):
    """A family that fills one value and surrounds it is connected without the square of its members."""
    rng = random.Random(8)
    centre, points = rng.getrandbits(64), set()
    while len(points) < 600:
        points.add(centre ^ sum({1 << rng.randrange(64) for _ in range(rng.randint(0, 3))}))
    points = sorted(points)
    fps = spark.createDataFrame([(p - 2**64 if p >= 2**63 else p,) for p in points], "fp long")
    links = [(r.a % 2**64, r.b % 2**64) for r in near_links(fps, 7, 4, crowded=64).collect()]
    parent = {p: p for p in points}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        assert (a ^ b).bit_count() <= 7
        parent[find(a)] = find(b)
    assert len({find(p) for p in points}) == 1
    assert len(links) < 100 * len(points)
