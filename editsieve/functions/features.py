"""Per-edit feature expressions.

All of them are built-in column expressions, so a full feature set is one
projection inside whole-stage codegen. Characters are counted as the length lost
when the class is removed, which avoids building an array of matches per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import WHITESPACE, collapse, contains_any, has_revert_tag, has_revert_word, is_revert
from .text import normalize, null_to_empty, strip

# --- fixed values: topic words, hint words, patterns ---------------------------
SENSITIVE_TITLE_TOKENS = (
    "obama", "macron", "trump", "hitler", "israel", "palestine", "gaza", "ukraine", "russie",
    "poutine", "religion", "sexe", "porn",
)
REVERT_HINT_WORDS = ("revert", "annulation", "rollback", "undo", "rv", "rvv", "restauration")
URL = rf"""(?i)https?://[^{WHITESPACE}<>"']+|www\.[^{WHITESPACE}<>"']+"""
ALNUM = "A-Za-zÀ-ÖØ-öø-ÿ0-9"
UPPER = "A-ZÀ-ÖØ-Þ"
# U+017F, U+212A, U+0130 and U+0131 fold to ASCII letters, so they are not symbols.
NOT_SYMBOL = rf"[A-Za-z0-9\u017f\u212a\u0130\u0131{WHITESPACE}]"
IP_USER = r"\A\p{Nd}{1,3}(?:\.\p{Nd}{1,3}){3}\z"
REPEATED_CHAR = r"([^\n])\1{4,}"
_B, _E = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"
CONTEXT_PATTERNS = (
    r"(?i)https?://|www\.",
    rf"(?i){_B}(?:test|lol|mdr|ptdr|xd+|haha+){_E}",
    rf"(?i){_B}(?:fake|faux|hoax|spam){_E}",
    rf"(?i){_B}(?:idiot|stupide|nul|debile|imbecile){_E}",
    r"([^\n])\1{5,}",
    rf"{_B}\p{{Nd}}{{6,}}{_E}",
    r"[A-Z]{8,}",
    r"\A[^\p{L}\p{N}]+\z",
)
# --------------------------------------------------------------------------------


def count_chars(c: Column, char_class: str) -> Column:
    return F.length(c) - F.length(F.regexp_replace(c, f"{char_class}+", ""))


def _ratio(part: Column, whole: Column) -> Column:
    return F.least(F.coalesce(F.try_divide(part.cast("double"), whole), F.lit(0.0)), F.lit(1.0))


def flag(condition: Column) -> Column:
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def raw_blob(title: Column, comment: Column, added: Column, removed: Column) -> Column:
    return F.concat_ws(" \n ", *(null_to_empty(c) for c in (title, comment, added, removed)))


def text_blob(title: Column, comment: Column, added: Column, removed: Column) -> Column:
    return normalize(raw_blob(title, comment, added, removed))


def url_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(URL))


def symbol_ratio(text: Column) -> Column:
    # What is left without the other characters: a class made of ranges is matched several times
    # faster than its negation.
    return _ratio(F.length(F.regexp_replace(text, f"{NOT_SYMBOL}+", "")), F.length(text))


def delta_len(added: Column, removed: Column) -> Column:
    return F.abs(F.length(null_to_empty(added)) - F.length(null_to_empty(removed)))


def title_sensitive(title: Column) -> Column:
    return flag(contains_any(normalize(null_to_empty(title)), SENSITIVE_TITLE_TOKENS))


def is_ip_user(user: Column) -> Column:
    return flag(strip(null_to_empty(user)).rlike(IP_USER))


def digit_ratio(text: Column) -> Column:
    return _ratio(count_chars(text, r"\p{Nd}"), count_chars(text, f"[{ALNUM}]"))


def upper_ratio(added: Column) -> Column:
    a = null_to_empty(added)
    return _ratio(count_chars(a, f"[{UPPER}]"), count_chars(a, f"[{ALNUM}]"))


def repeat_char_flag(text: Column) -> Column:
    return flag(text.rlike(REPEATED_CHAR))


def comment_revert_hint(comment: Column) -> Column:
    return flag(contains_any(normalize(null_to_empty(comment)), REVERT_HINT_WORDS))


# --- context score of a candidate row ---------------------------------------------

def context_matches(blob: Column) -> list[Column]:
    return [blob.rlike(p) for p in CONTEXT_PATTERNS]


def context_score(blob: Column, comment: Column, tags: Column) -> Column:
    """Integer score: revert evidence, one step per matched pattern, a bonus for plain edits."""
    tagged = has_revert_tag(tags)
    score = F.when(tagged, 6).otherwise(0) + F.when(is_revert(comment, tags), 4).otherwise(0)
    score = score + F.when(has_revert_word(comment), 2).otherwise(0)
    for hit in context_matches(blob):
        score = score + F.when(hit, 2).otherwise(0)
    plain = ~tagged & ~F.lower(null_to_empty(comment)).contains("revert")
    return (score + F.when(plain, 1).otherwise(0)).cast("int")


# --- identity and sampling of a candidate row ---------------------------------------

# Characters of (time, user, other text fields) that enter a short key.
SHORT_KEY = (40, 80, 600)


def key_part(c: Column, max_len: int | None = None) -> Column:
    whole = collapse(F.lower(strip(null_to_empty(c))))
    return whole if max_len is None else F.substring(whole, 1, max_len)


def dedup_key(row: dict[str, Column], lengths: tuple[int | None, int | None, int | None] = (None, None, None)) -> Column:
    """SHA-1 of the row's identity. Whole fields enter it, or their first characters (``SHORT_KEY``)."""
    time, user, text = lengths
    parts = [
        null_to_empty(row["lang"]),
        F.coalesce(row["revid"], F.lit(0)).cast("string"),
        F.coalesce(row["old_revid"], F.lit(0)).cast("string"),
        key_part(row["timestamp"], time),
        key_part(row["title"], text),
        key_part(row["user"], user),
        key_part(row["comment"], text),
        key_part(row["added_text"], text),
        key_part(row["removed_text"], text),
    ]
    return F.sha1(F.concat_ws("||", *parts).cast("binary"))


def hash_fraction(key: Column) -> Column:
    """First 32 bits of a hex key as a fraction of their maximum."""
    return F.conv(F.substring(key, 1, 8), 16, 10).cast("double") / F.lit(float(0xFFFFFFFF))


def hash_kept(key: Column, rate: float) -> Column:
    if rate <= 0:
        return F.lit(False)
    if rate >= 1:
        return F.lit(True)
    return hash_fraction(key) < F.lit(float(rate))


def row_hash(columns: list[str], seed: int = 42) -> Column:
    """Seeded SHA-1 over whole column values: a repeatable random order of rows.

    Each value is written as ``<length>:<value>`` (null as ``-``), so different rows
    cannot produce the same input to the hash.
    """
    parts = []
    for name in columns:
        v = F.col(name).cast("string")
        parts.append(F.coalesce(F.concat(F.length(v).cast("string"), F.lit(":"), v), F.lit("-")))
    return F.sha1(F.concat_ws("|", *parts, F.lit(str(seed))).cast("binary"))
