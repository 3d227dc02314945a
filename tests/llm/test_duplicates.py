"""SimHash components, scaled sketches and byte repeats against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import pytest
import xxhash

from editsieve.llm.components import components
from editsieve.llm.repeats import AnchorFinder, context_spans, kept_bytes, merged, prefix_intervals, remove_passages, remove_repeats, repeat_report
from editsieve.llm.simhash import ball, jaccard, keep_one, keep_one_similar, near_links, segment_plan, simhash_components
from editsieve.llm.sketch import containment, edited_pairs, similarity, with_next, with_sketch
from pyspark.sql import functions as F
from tests.llm.conftest import odd_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_fingerprint(text):
    w = WORD.findall((text or "").translate(LOWER))
    shingles = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(points, radius):
    parent = list(range(len(points)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(points)):
        for j in range(i):
            if (points[i] ^ points[j]).bit_count() <= radius:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(points))]


def test_segments_cover_the_radius():
    for radius in range(9):
        for segments in (1, 2, 3, 4, 5):
            plan = segment_plan(radius, segments)
            assert sum(w for _, w, _ in plan) == 64 and sum(s + 1 for *_, s in plan) > radius
    assert len(ball(21, 1)) == 22 and len(set(ball(10, 2))) == 1 + 10 + 45


def test_components_of_documents(spark, table):
    rows = odd_rows()
    got = simhash_components(spark, table(rows)).collect()
    fps = [plain_fingerprint(r[1]) for r in rows]
    groups = defaultdict(list)
    for r, g in zip(rows, plain_components(fps, 4)):
        groups[g].append(r[0])
    want = []
    for r, fp, g in zip(rows, fps, plain_components(fps, 4)):
        ids = [i for i in groups[g] if i is not None]
        want.append((r[0], f"{fp:016x}", min(ids) if ids else None))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert simhash_components(spark, table(rows).where("doc_id > 1000")).collect() == []


@pytest.mark.parametrize("crowded", [256, 3])
def test_links_connect_what_they_must(spark, crowded):
    """Families of near fingerprints, with and without the path for crowded values."""
    rng = random.Random(5)
    points = set()
    for _ in range(6):
        seed = rng.getrandbits(64)
        for _ in range(40):
            points.add(seed ^ sum(1 << rng.randrange(64) for _ in range(rng.randint(0, 4))) & (2**64 - 1))
    points |= {rng.getrandbits(64) for _ in range(60)} | {0, 2**64 - 1}
    points = sorted(points)
    signed = [p - 2**64 if p >= 2**63 else p for p in points]
    fps = spark.createDataFrame([(s,) for s in signed], "fp long")
    links = near_links(fps, 4, 3, crowded=crowded, block=16).collect()
    as_set = {(r.a % 2**64, r.b % 2**64) for r in links}
    assert all((a ^ b).bit_count() <= 4 for a, b in as_set)
    parent = {p: p for p in points}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in as_set:
        parent[find(a)] = find(b)
    want = plain_components(points, 4)
    assert len({(find(p), w) for p, w in zip(points, want)}) == len(set(want)) == len({find(p) for p in points})


def test_components_of_a_chain(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_keep_one(spark, table):
    rows = odd_rows()
    docs = table(rows)
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    fps = {r[:2]: g for r, g in zip(rows, plain_components([plain_fingerprint(r[1]) for r in rows], 4))}
    got = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(got) == len(set(fps.values())) == len({fps[g] for g in got})
    assert (5, rows[0][1]) not in got and (2, rows[2][1]) in got  # the smallest id of the group
    assert keep_one(docs.where("doc_id > 1000")).collect() == []


def plain_jaccard(a, b):
    x, y = ({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (a.split(), b.split()))
    return len(x & y) / len(x | y)


@pytest.mark.parametrize("family", [32, 1])
def test_keep_one_similar_by_band(spark, table, family):
    """Recall of planted edits per band of similarity; nothing below 0.8 goes."""
    rng = random.Random(21)
    rows, similarity_of = [], {}
    for i in range(240):
        words = [f"w{rng.randrange(30000)}" for _ in range(rng.randint(120, 400))]
        edited = list(words)
        for _ in range(rng.randint(1, max(2, len(words) // 30))):
            edited[rng.randrange(len(edited))] = f"x{rng.randrange(30000)}"
        rows += [(i, " ".join(words)), (1000 + i, " ".join(edited))]
        similarity_of[1000 + i] = plain_jaccard(rows[-2][1], rows[-1][1])
        assert abs(jaccard(rows[-2][1].encode(), rows[-1][1].encode()) - similarity_of[1000 + i]) < 1e-12
    kept = {r.doc_id for r in keep_one_similar(table(rows), family=family).collect()}
    assert kept >= set(range(240))
    assert all(i in kept for i, s in similarity_of.items() if s < 0.8)
    plain = {r.doc_id for r in keep_one(table(rows), 4).collect()}
    for low, high in ((0.8, 0.85), (0.85, 0.9), (0.9, 0.95), (0.95, 1.01)):
        band = [i for i, s in similarity_of.items() if low <= s < high]
        recall, before = (1 - sum(i in k for i in band) / len(band) for k in (kept, plain))
        print(f"family {family}: {low}-{high}: {len(band)} pairs, recall {recall:.3f}, with 4 of 64 bits {before:.3f}")
        assert len(band) >= 10 and recall >= 0.95


def test_keep_one_similar_odd_rows(spark, table):
    rows = odd_rows()
    kept = keep_one_similar(table(rows))
    assert kept.columns == table(rows).columns
    got = [(r.doc_id, r.text) for r in kept.collect()]
    assert (2, rows[2][1]) in got and (5, rows[0][1]) not in got and sum(not (t or "").strip() for _, t in got) == 1
    assert keep_one_similar(table(rows).where("doc_id > 1000")).collect() == []


def test_next_and_edited(spark, table):
    rows = odd_rows()
    ordered = sorted({r[:2] for r in rows if r[0] is not None}, key=lambda r: (r[0], r[1] or ""))
    unique = {r[0]: r[1] or "" for r in ordered}
    docs = table(list(unique.items()))
    got = {r.doc_id: r for r in edited_pairs(spark, docs).collect()}
    ids = sorted(unique)
    for i, d in enumerate(ids):
        text, after = unique[d], unique[ids[(i + 1) % len(ids)]]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        assert got[d].n_chars == len(text)
        assert got[d].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= got[d].near_edited <= 1 and 0 <= got[d].near_next <= 1
        if edited == text:
            assert got[d].fingerprint == got[d].edited_fingerprint and got[d].near_edited == 1
    assert got[7].fingerprint == "" and got[9].fingerprint == ""
    everything = edited_pairs(spark, table(rows)).collect()
    assert len(everything) == len(rows)
    assert edited_pairs(spark, table(rows).where("doc_id > 1000")).collect() == []


def test_next_over_ranges(spark):
    rows = spark.createDataFrame([(i * 3, i % 2, f"t{i}") for i in range(100)], "doc_id long, tie long, text string")
    got = {r.doc_id: r.next_text for r in with_next(rows, ["text"], rows_per_bucket=7).collect()}
    assert got == {i * 3: f"t{(i + 1) % 100}" for i in range(100)}


def test_estimates(spark):
    words = [f"w{i}" for i in range(4000)]
    rows = [(1, " ".join(words), " ".join(words[:1000])), (2, " ".join(words), " ".join(words[2000:] + [f"v{i}" for i in range(2000)]))]
    df = spark.createDataFrame(rows, "id long, x string, y string")
    df = with_sketch(with_sketch(df, "x", "a"), "y", "b")
    a, b = F.col("a"), F.col("b")
    got = df.select("id", similarity(a, b).alias("j"), containment(b, a).alias("c")).orderBy("id").collect()
    assert abs(got[0].j - 0.25) < 0.06 and got[0].c == 1.0
    assert abs(got[1].j - 1 / 3) < 0.08 and abs(got[1].c - 0.5) < 0.1


def plain_repeats(texts, window):
    places = defaultdict(list)
    for d, t in enumerate(texts):
        for p in range(len(t) - window + 1):
            places[t[p : p + window]].append((d, p))
    spans = defaultdict(list)
    for found in places.values():
        if len(found) > 1:
            for d, p in found:
                spans[d].append({"lo": p, "hi": p + window})
    return [merged(spans[d]) for d in range(len(texts))]


def stitched(seed):
    rng = random.Random(seed)
    letters = b"ab" if seed % 3 == 0 else b"abcdefgh"
    base = [bytes(rng.choice(letters) for _ in range(rng.randint(10, 200))) for _ in range(4)]
    texts = [b"a" * 90, b"ab" * 60] if seed % 5 == 0 else []
    for _ in range(rng.randint(2, 10)):
        t = b""
        for _ in range(rng.randint(0, 4)):
            part = rng.choice(base)
            a = rng.randint(0, len(part))
            t += part[a : rng.randint(a, len(part))] + bytes(rng.choice(letters) for _ in range(rng.choice([0, 0, 9, 30])))
        texts.append(t)
    return texts


@pytest.mark.parametrize("window,core", [(20, 5), (40, 10), (13, 4)])
def test_interval_tree_finds_all_repeats(window, core):
    for seed in range(60):
        texts = stitched(seed)
        finder, contexts = AnchorFinder(window, core), defaultdict(list)
        for d, t in enumerate(texts):
            for p, g in zip(*(x.tolist() for x in finder.find(t))):
                lo, hi = max(0, p - window + core), min(len(t), p + window)
                contexts[g, t[lo:p], t[p:hi]].append((d, p, lo, hi))
        spans = defaultdict(list)
        for places in contexts.values():
            for d, _, lo, hi in places if len(places) > 1 else []:
                if hi - lo >= window:
                    spans[d].append({"lo": lo, "hi": hi})
        keys = sorted(contexts)
        names = {g: i for i, g in enumerate(dict.fromkeys(k[0] for k in keys))}
        left, right = context_spans([names[k[0]] for k in keys], [k[1] for k in keys], [k[2] for k in keys], window, core)
        for k, a, b in zip(keys, left.tolist(), right.tolist()):
            if b:
                d, p, _, _ = contexts[k][0]
                spans[d].append({"lo": p - a, "hi": p + b})
        assert [merged(spans[d]) for d in range(len(texts))] == plain_repeats(texts, window), seed


def test_intervals_list_all_occurrences():
    common = [3, 5, 5, 1, -1, 2]  # sorted suffixes 0..6
    got = [(depth, sorted(map(sorted, parts))) for depth, parts in prefix_intervals(common, 1)]
    assert got == [(5, [[1], [2], [3]]), (3, [[0], [1, 2, 3]]), (1, [[0, 1, 2, 3], [4]]), (2, [[5], [6]])]


def test_anchors_of_long_texts(monkeypatch):
    import editsieve.llm.repeats as repeats

    rng = random.Random(1)
    text = bytes(rng.choice(b"abcd") for _ in range(5000))
    whole = AnchorFinder(50, 10).find(text)
    monkeypatch.setattr(repeats, "SEGMENT", 256)
    parts = AnchorFinder(50, 10).find(text)
    assert all((a == b).all() for a, b in zip(whole, parts))


@pytest.mark.parametrize("limits", [{}, {"crowded": 2, "block": 2}])
def test_repeats_of_documents(spark, table, limits, monkeypatch):
    import editsieve.llm.repeats as repeats

    if limits:
        plain_spans = repeats.repeat_spans
        monkeypatch.setattr(repeats, "repeat_spans", lambda d, w, c: plain_spans(d, w, c, **limits))
    texts = [t.decode() for s in range(12) for t in stitched(s * 5 + 1)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(900, None), (901, ""), (902, "é" * 30), (903, "é" * 30), (1, texts[1]), (None, texts[0])]
    data = [(r[1] or "").encode() for r in rows]
    got = {}
    for r in repeat_report(spark, table(rows), 20, 5).collect():
        got.setdefault(r.doc_id, set()).add(tuple(r)[1:])
    want = {}
    for (d, *_), t, runs in zip(rows, data, plain_repeats(data, 20)):
        kept = hashlib.sha256(kept_bytes(t, runs)).hexdigest()
        want.setdefault(d, set()).add((len(t), sum(b - a for a, b in runs), len(runs), kept))
    assert got == want
    cut = remove_repeats(table(rows), 20, 5)
    assert cut.columns == table(rows).columns
    by_id = {r.doc_id: r for r in cut.collect()}
    for (d, text, *_), t, runs in zip(rows, data, plain_repeats(data, 20)):
        kept = kept_bytes(t, runs).decode("utf-8", "ignore")
        assert by_id[d].text == kept and by_id[d].n_chars == len(kept) and by_id[d].bucket == "x"
    assert repeat_report(spark, table(rows).where("doc_id > 1000"), 20, 5).collect() == []


def test_passages_of_51_words(spark, table):
    """51 words shared by two texts go whatever their length in bytes, 50 stay, and 400 bytes go without blanks too."""
    rng = random.Random(31)

    def fresh(n):
        return [f"u{rng.randrange(10**9)}" for _ in range(n)]

    short, just, few = (["".join(rng.choice("abcdef") for _ in range(rng.randint(1, 3))) for _ in range(n)] for n in (51, 60, 50))
    whole = "".join(chr(0x4E00 + rng.randrange(9000)) for _ in range(200))
    rows, want = [], {}
    for i, (passage, goes) in enumerate([(short, True), (just, True), (few, False), ([whole], True)]):
        for j in range(3):
            before, after = fresh(rng.randint(60, 90)), fresh(rng.randint(60, 90))
            blanks = ["  " if j == 1 and len(passage) > 1 else " ", "\n" if j == 2 and i < 2 else " "]
            rows.append((10 * i + j, f"{' '.join(before)} {blanks[j > 0].join(passage) if i < 2 else ' '.join(passage)} {' '.join(after)}"))
            want[10 * i + j] = before + ([] if goes else passage) + after
    assert all(len(" ".join(p)) < 400 for p in (short, just, few)) and len(whole.encode()) >= 400
    got = remove_passages(table(rows))
    assert got.columns == table(rows).columns
    texts = {r.doc_id: r.text for r in got.collect()}
    assert all(texts[i].split() == want[i] for i in want if i < 30)
    assert all(set(whole).isdisjoint(texts[i]) and set(want[i][1:59]) <= set(texts[i].split()) for i in want if i >= 30)
    plain = {r.doc_id: r.text.split() for r in remove_repeats(table(rows)).collect()}
    assert plain[0] != want[0] and whole not in " ".join(plain[30])
    assert remove_passages(table(rows).where("doc_id > 1000")).collect() == []
