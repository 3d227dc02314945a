"""Scalar rules on hand-made cases."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from editsieve.functions import features as fx
from editsieve.functions import text as tx
from editsieve.functions import tokens as tk

RUN = "2024-05-01T00:00:00Z"


def one(spark, values, expr, schema="v string"):
    df = spark.createDataFrame([(v,) for v in values], schema).coalesce(1)
    return [r[0] for r in df.select(expr(F.col("v"))).collect()]


def test_to_iso(spark):
    values = ["", None, " 2024-01-01T00:00:00 ", "2024-01-01T00:00:00Z", "2024-01-01T00:00:00+02:00", "2024-01-01T00:00:00-05:00"]
    assert one(spark, values, lambda c: tx.to_iso(c, RUN)) == [
        RUN, RUN, "2024-01-01T00:00:00Z", "2024-01-01T00:00:00Z", "2024-01-01T00:00:00+02:00", "2024-01-01T00:00:00-05:00Z",
    ]


def test_parse_ts(spark):
    base = 1704067200
    cases = {
        "2024-01-01T00:00:00Z": base, "2024-01-01T00:00:00": base, "2024-01-01 00:00": base, "2024-01-01": base,
        "2024-01-01T00:00:00+02:00": base - 7200, "2024-01-01T00:00:00-0500": base + 18000, "": None, "2024": None,
        "20240101T000000Z": base, "2024-01-01T01": base + 3600, "2024-01-01T00+01:00": base - 3600,
        "2024-01": None, "T10:00": None, "bad": None, "2024-13-01T00:00:00Z": None, "2024-01-01T00:00:00-05:00Z": None,
    }
    got = one(spark, list(cases), lambda c: F.unix_seconds(tx.parse_ts(c)))
    assert dict(zip(cases, got)) == cases


@pytest.mark.parametrize("comment,tags,want", [
    ("Rv vandalisme", [], True), ("rv", [], False), ("RVV", [], True), ("x", ["MW-Undo"], True), ("x", ["mw-reverted"], True),
    (None, None, False), ("ANNULATION de", ["mobile edit"], True), ("ok", [None], False),
])
def test_revert_rule(spark, comment, tags, want):
    df = spark.createDataFrame([(comment, tags)], "comment string, tags array<string>")
    assert df.select(tx.is_revert(F.col("comment"), F.col("tags"))).first()[0] is want


def test_character_runs(spark):
    values = ["aaaa", "aaaaa", "aaaaaa", "aa\naaa", "", "\n\n\n\n\n\n", "éééééé"]
    assert one(spark, values, fx.repeat_char_flag) == [0, 1, 1, 0, 0, 0, 1]
    assert one(spark, values, lambda c: fx.context_matches(c)[4]) == [False, False, True, False, False, False, True]


def test_ratios(spark):
    values = ["", "!!!", "éÉ", "٣٤a", "a b", "ab12", "ſK"]
    assert one(spark, values, fx.symbol_ratio) == pytest.approx([0, 1, 1, 2 / 3, 0, 0, 0])
    assert one(spark, values, fx.digit_ratio) == pytest.approx([0, 0, 0, 1, 0, 0.5, 0])
    assert one(spark, ["ABab", None, "ÉÀé×"], fx.upper_ratio) == pytest.approx([0.5, 0, 2 / 3])


def test_users(spark):
    values = ["1.2.3.4", "999.999.999.999", "1.2.3", " 1.2.3.4 ", "::1", None]
    assert one(spark, values, fx.is_ip_user) == [1, 1, 0, 1, 0, 0]


def test_titles_hints_and_lengths(spark):
    assert one(spark, ["Donald TRUMP", "Sport", None, "Israël"], fx.title_sensitive) == [1, 0, 0, 0]
    assert one(spark, ["undo", "RV", "merci", None], fx.comment_revert_hint) == [1, 1, 0, 0]
    df = spark.createDataFrame([("😀é", None), ("abc", "a")], "a string, r string")
    assert [r[0] for r in df.select(fx.delta_len(F.col("a"), F.col("r"))).collect()] == [2, 2]


def test_normalize_folds_every_kind_of_white_space(spark):
    assert one(spark, ["  A  B\x1c\nC ", None], tx.normalize) == ["a b c", None]


DIFF = (
    '<tr><td class="diff-deletedline">old\n&lt;i&gt;x</td></tr><TD CLASS="diff-addedline" a="1"><b>new</b> &amp;\nline</TD>'
    '<td class="diff-addedline">&nbsp;two&lt;b&gt;three</td><td class="other">no</td>'
)


def test_diff_modes(spark):
    def texts(mode, html):
        df = spark.createDataFrame([(html,)], "h string")
        return tuple(df.select(*tx.diff_texts(F.col("h"), mode)).first())

    assert texts("collapsed", DIFF) == ("new &amp; line two&lt;b&gt;three", "old &lt;i&gt;x")
    added, removed = texts("unescaped", DIFF)
    assert (added, removed) == ("new  &\nline  two three", "old\n x")
    assert texts("whole", "<p>a</p>&nbsp;b ") == ("a  b", "")
    assert texts("raw", "z" * 5000) == ("z" * 5000, "")
    assert texts("raw:4000", "z" * 5000) == ("z" * 4000, "")
    assert texts("raw:4000", None) == ("", "")
    assert texts("collapsed", "<p>none</p>") == ("", "")


def test_payload_prefers_star_over_body(spark):
    maps = [{"*": "a", "body": "b"}, {"*": "", "body": "b"}, {"body": "b"}, {}, None]
    assert one(spark, maps, tx.payload_html, "v map<string,string>") == ["a", "b", "b", "", ""]


def test_context_patterns(spark):
    text = ["see WWW.x", "LOL!", "xddd", "alolb", "un hoax.", "nul", "id 123456.", "id 12345", "ABCDEFGH", "abcdefgh", " \n !? ", "faux_x"]
    got = [[i for i, hit in enumerate(r, 1) if hit] for r in spark.createDataFrame([(t,) for t in text], "v string")
           .coalesce(1).select(*fx.context_matches(F.col("v"))).collect()]
    assert got == [[1], [2], [2], [], [3], [4], [6], [], [7], [], [8], []]


def test_hash_sampling_bounds(spark):
    df = spark.createDataFrame([("00000000ff",), ("ffffffff00",), ("80000000aa",)], "k string")
    pick = lambda rate: df.where(fx.hash_kept(F.col("k"), rate)).count()
    assert (pick(0), pick(1), pick(0.4), pick(0.6)) == (0, 3, 1, 2)


def test_row_hash_tells_columns_apart(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc"), ("a", None), ("a", "-")], "x string, y string")
    assert df.select(fx.row_hash(["x", "y"])).distinct().count() == 4


@pytest.mark.parametrize("k", [1, 3, 50])
def test_top_tokens_match_counting(spark, k):
    from collections import Counter

    texts = ["the cat the dog cat the bird", "", "aa bb", "été l'eau été x-y-z _a_ l'eau", "dog dog cat cat emu"]
    df = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    got = [r.tokens for r in tk.top_tokens(df, "text", k).collect()]
    want = [[t for t, _ in Counter(re.findall(r"[a-z0-9à-öø-ÿ_'-]{3,40}", t)).most_common(k)] for t in texts]
    assert got == want


def test_grams(spark):
    df = spark.createDataFrame([("Le chat, a b",), ("",)], "text string").coalesce(1)
    words = [r[0] for r in df.select(tk.word_grams(tk.word_list(F.col("text")))).collect()]
    assert words == [["le", "chat", "le chat"], []]
    chars = [r[0] for r in spark.createDataFrame([("a bcd",)], "text string").select(tk.char_grams(tk.padded_words(F.col("text")))).collect()]
    assert chars == [[" a ", " bc", "bcd", "cd ", " bcd", "bcd ", " bcd "]]
