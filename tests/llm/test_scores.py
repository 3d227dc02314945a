"""Toxicity, language model, quality rules and mixing against plain versions and held-out rows."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from editsieve.llm import mixing
from editsieve.llm.fertility import bands, entropy, quality_rules, repeated_lines, repeated_words
from editsieve.llm.maxent_lm import CLASSES, ClassModel, context_rows, expected_counts, language_model_scores, observed_counts, token_key
from editsieve.llm.toxicity import fit_logistic, reject_toxic, toxicity
from tests.llm.conftest import odd_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.01"


def prose(rng, n, extra=()):
    parts = ["the", "of", "and", "stone", "river", "quietly", "walking", "morning", "evening", "garden", "table", "window", "letter"]
    words = [rng.choice(parts) + rng.choice(["", "", "s", "ed", "ing"]) for _ in range(n)]
    for w in extra:
        words.insert(rng.randrange(len(words) + 1), w)
    return " ".join(words)


def test_toxicity_learns_from_labels(spark, table):
    rng = random.Random(3)
    bad = ["scumbag", "worthless", "moronic"]
    rows, marks = [], []
    for i in range(400):
        toxic = i % 4 == 0
        rows.append((i, prose(rng, 80, rng.sample(bad, 2) if toxic else ())))
        if i % 2 == 0 or i % 3 == 0:
            marks.append((i, 1, int(toxic)))
    rows += [(None, "a moronic text"), (1000, None), (1001, ""), (rows[0][0], rows[0][1])]
    labels = spark.createDataFrame([*marks, (None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    docs = table(rows)
    got = toxicity(spark, docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert {r.doc_id: r.held_out for r in got if r.doc_id is not None} == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i, *_ in rows if i is not None}
    right = [r.predicted == (r.doc_id % 4 == 0) for r in got if r.doc_id is not None and r.doc_id < 400]
    assert sum(right) > 0.95 * len(right)
    # Held-out labels do not matter.
    flipped = spark.createDataFrame([(i, q, t if zlib.crc32(str(i).encode()) % 5 else 1 - t) for i, q, t in marks], labels.schema)
    assert sorted(map(tuple, toxicity(spark, docs, flipped).collect()), key=repr) == sorted(map(tuple, got), key=repr)
    kept = reject_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted == 0 for r in got)
    none = toxicity(spark, docs, labels.where("toxic = 0")).collect()
    assert {r.score for r in none} == {0.0}
    assert toxicity(spark, docs.where("doc_id > 5000"), labels).collect() == []


def test_toxicity_held_out(spark):
    from __spark_entry__ import queries

    rows = queries()["op1_toxicity"](spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").toPandas()
    clean, toxic = rows[rows.toxic == 0], rows[rows.toxic == 1]
    assert clean.predicted.mean() < 0.06
    assert toxic.score.mean() > 4 * clean.score.mean()


def test_logistic():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 2))
    y = (x[:, 0] - 0.5 * x[:, 1] + rng.normal(size=500) * 0.3 > 0).astype(float)
    w = fit_logistic(x, y)
    assert ((x @ w[:-1] + w[-1] > 0) == (y > 0)).mean() > 0.9


def lm_plain(rows):
    words = [[w for w in (r[1] or "").encode().lower().split()] + [b"\n"] for r in rows]
    held = [zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 7 == 2 for r in rows]
    counts = Counter(w for ws, h in zip(words, held) if not h for w in ws)
    total, distinct = sum(counts.values()), len(counts)
    return [
        (r[0], h, len(ws), sum(counts[w] > 0 for w in ws), total, sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in ws))
        for r, ws, h in zip(rows, words, held)
    ], counts


def test_language_model(spark, table, monkeypatch):
    import editsieve.llm.maxent_lm as lm

    monkeypatch.setattr(lm, "HEAD", 20)  # most words go through the join
    rng = random.Random(4)
    rows = [*odd_rows(), *((100 + i, prose(rng, rng.randint(0, 60))) for i in range(60)), (800, "unheard Words here 中")]
    got = sorted(language_model_scores(spark, table(rows)).collect(), key=repr)
    want, _ = lm_plain(rows)
    for g, w in zip(got, sorted(want, key=lambda x: repr(_like(got[0], x)))):
        assert tuple(g)[:5] == w[:5] and abs(g.base_score - w[5]) < 1e-6 * max(1, abs(w[5]))
        assert g.score <= 0
    assert language_model_scores(spark, table(rows).where("doc_id > 5000")).collect() == []


def _like(row, values):
    from pyspark.sql import Row

    return Row(**dict(zip(row.__fields__, (*values, 0.0))))


def test_class_model_sums_to_one_and_learns():
    rng = random.Random(6)
    words = [prose(rng, 400).encode().split() + [b"\n"] for _ in range(5)]
    keys = np.array([token_key(w) for ws in words for w in ws], dtype=np.uint64)
    starts = np.cumsum([0] + [len(w) for w in words[:-1]])
    rows, cls = context_rows(keys, starts)
    observed = observed_counts(rows, cls)
    assert observed[:4096].sum() == len(keys)
    model = ClassModel.from_counts(observed)
    before = model.log10(rows, cls).sum()
    for _ in range(3):
        p = model.probabilities(rows)
        assert np.allclose(p.sum(axis=1), 1, atol=1e-5)
        expected = expected_counts(rows, p)
        slow = np.zeros_like(expected)
        for r in rows:
            np.add.at(slow, r, p)
        assert np.allclose(expected, slow, atol=1e-3)
        model = model.stepped(observed, expected)
    assert model.log10(rows, cls).sum() > before
    # A document's context does not reach into the one before.
    alone, _ = context_rows(keys[starts[1] : starts[2]], np.array([0]))
    assert (alone == rows[:, starts[1] : starts[2]]).all() and CLASSES == 16


def test_language_model_beats_the_base_on_held_out(spark):
    from __spark_entry__ import queries

    p = queries()["op2_language_model"](spark, SF).toPandas()
    h = p[p.held_out]
    assert h.score.sum() > h.base_score.sum()


def plain_repeated(words):
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    many = Counter(grams)
    return len({i + k for i, g in enumerate(grams) if many[g] > 1 for k in range(3)})


def test_base_counts():
    rng = random.Random(8)
    for _ in range(300):
        words = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(0, 14))]
        assert repeated_words(words) == plain_repeated(words)
    assert repeated_lines(b"x\n\n \nx\nx \n\n \nx") == 2
    assert entropy(np.array([1, 1, 2, 2])) == 1.0 and entropy(np.array([3, 3])) == 0.0


def test_quality_rules(spark, table):
    rng = random.Random(9)
    rows = [*odd_rows(), *((100 + i, prose(rng, 120)) for i in range(60))]
    rows += [(900, " ".join("".join(rng.choice("ƀƁƂƃƄƅƆƇƈ") for _ in range(9)) for _ in range(120)))]
    got = quality_rules(spark, table(rows)).collect()
    assert len(got) == len(rows)
    by_counts = Counter()
    for r in rows:
        text = r[1] or ""
        w = WORD.findall(text)
        seen, again = set(), 0
        for line in text.split("\n"):
            if WORD.search(line):
                again += line in seen
                seen.add(line)
        rep = plain_repeated(w)
        by_counts[r[0], len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), again, rep, len(w) < 50 or 100 * rep > 50 * len(w)] += 1
    assert Counter(tuple(r)[:7] for r in got) == by_counts
    kept = {r.doc_id: r.kept for r in got}
    assert all(kept[100 + i] for i in range(60)) and not kept[900] and not kept[7]
    assert quality_rules(spark, table(rows).where("doc_id > 5000")).collect() == []


def test_mixture_rakes_to_the_targets(spark, table):
    rng = random.Random(10)
    rows = [(i, prose(rng, rng.choice([20, 200, 700])), rng.choice(["en", "de", None]), rng.choice(["a"] * 6 + ["b", "c"])) for i in range(400)]
    docs = table([*rows, *odd_rows()])
    got = mixing.mixed(docs).toPandas()
    assert len(got) == docs.count() and got.probability.between(0, 1).all()
    cells = got[got.n_tokens > 0].groupby(["source", "lang", "topic"]).agg(t=("n_tokens", "sum"), w=("weight", "first"), p=("probability", "first")).reset_index()
    goal = cells.groupby("topic").t.sum() ** mixing.FLATTEN["topic"]
    share = cells.t / cells.t.sum()
    assert np.allclose((share * cells.w).groupby(cells.topic).sum(), goal / goal.sum(), atol=1e-9)
    for margin, near in (("source", 0.02), ("lang", 0.02)):
        goal = cells.groupby(margin).t.sum() ** mixing.FLATTEN[margin]
        assert np.allclose((share * cells.w).groupby(cells[margin]).sum(), goal / goal.sum(), atol=near)
    assert abs((share * cells.p).sum() - mixing.BUDGET) < 1e-9
    kept = mixing.sample_mixture(docs)
    assert kept.columns == docs.columns and kept.count() == int(got.selected.sum())
    assert mixing.mixed(docs, budget=1.0).where("n_tokens > 0 AND NOT selected").count() == 0
    assert mixing.mixed(docs.where("doc_id > 5000")).collect() == []


def sample_shares(got, margin, rows):
    sums = got[rows].groupby(margin).n_tokens.sum()
    return sums / sums.sum()


def test_sample_has_the_target_shares(spark, table):
    """A rare topic and a rare source, all of whose documents are wanted: the others make room within the budget."""
    rng = random.Random(14)
    rows = []
    for i in range(1500):
        n = rng.choice([60, 60, 200, 200, 200, 700])
        text = prose(rng, n, [str(rng.randrange(10**9)) for _ in range(n // 6)] if i % 40 == 0 else ())
        rows.append((i, text, "es" if i % 9 == 0 else "en", "rare" if i % 13 == 0 else "b" if i % 4 == 0 else "a"))
    docs = table(rows)
    got, before = mixing.mixed(docs, within=True).toPandas(), mixing.mixed(docs).toPandas()
    worst = {"after": 0.0, "before": 0.0}
    for margin in mixing.MARGINS:
        goal = got.groupby(margin).n_tokens.sum() ** mixing.FLATTEN[margin]
        goal = goal / goal.sum()
        for name, table_of in (("after", got), ("before", before)):
            sums = (table_of.n_tokens * table_of.probability).groupby(table_of[margin]).sum()
            worst[name] = max(worst[name], (sums / sums.sum() / goal - 1).abs().max())
        assert (sample_shares(got, margin, got.selected) - goal).abs().max() < 0.03
    print("largest relative miss of a target:", worst)
    assert worst["after"] <= 0.011 < worst["before"]
    assert got.probability.between(0, 1).all() and 0.1 < (got.n_tokens * got.probability).sum() / got.n_tokens.sum() <= mixing.BUDGET + 1e-9
    kept = mixing.sample_to_targets(docs)
    assert kept.columns == docs.columns and kept.count() == got.selected.sum()
    asked = mixing.mixed(docs, within=True, shares={"lang": {"en": 1, "es": 1, "absent": 5}}).toPandas()
    sums = (asked.n_tokens * asked.probability).groupby(asked.lang).sum()
    assert abs(sums["es"] / sums.sum() - 0.5) < 0.01
    assert mixing.mixed(docs.where("doc_id > 5000"), within=True).collect() == []


def test_mixture_sql(spark):
    from __spark_entry__ import oracle_sql, queries

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.sql(oracle_sql()["op10_mixture"]).df().sort_values("doc_id").reset_index(drop=True)
    got = queries()["op10_mixture"](spark, SF).toPandas().sort_values("doc_id").reset_index(drop=True)
    assert all((got[c] == want[c]).all() for c in want.columns) and sorted(got.columns) == sorted(want.columns)


@pytest.mark.parametrize("topic", ["sports", None])
def test_mixture_takes_a_given_topic(spark, table, topic):
    docs = table([(i, "some words here") for i in range(5)]).selectExpr("*", f"{repr(topic) if topic else 'NULL'} AS topic")
    assert {r.topic for r in mixing.mixed(docs).collect()} == {topic or "(none)"}
