"""Text, timestamp and HTML clean-up as JVM-side column expressions.

Character classes are spelled out so that Java's regex engine sees the same
Unicode sets as the definitions these rules come from (Unicode white space and
digits, "word" = letters, numbers and underscore).
"""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values: white space set, revert vocabulary ------------------------
WHITESPACE = r"\s\x0b\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
REVERT_TAGS = ("mw-rollback", "mw-undo", "mw-manual-revert", "mw-reverted")
REVERT_WORDS = ("revert", "annulation", "rv ", "rvv", "rollback", "restauration")
# -----------------------------------------------------------------------------

_ISO = (
    r"\A\d{4}-\d{2}-\d{2}"
    r"(?:[T ]\d{2}:\d{2}(?::\d{2}(?:[.,]\d{1,9})?)?(?:Z|[+-]\d{2}:?\d{2})?)?\z"
)


def null_to_empty(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def strip(c: Column) -> Column:
    return F.regexp_replace(c, rf"\A[{WHITESPACE}]+|[{WHITESPACE}]+\z", "")


def collapse(c: Column) -> Column:
    return F.regexp_replace(c, rf"[{WHITESPACE}]+", " ")


def normalize(c: Column) -> Column:
    """Lower-case, collapse white space, trim. Diacritics stay."""
    return F.trim(collapse(F.lower(c)))


def contains_any(c: Column, words) -> Column:
    # One search over all words, so that ``c`` is evaluated once.
    return c.rlike("|".join(words))


# --- timestamps ----------------------------------------------------------------

def to_iso(c: Column, run_ts: str) -> Column:
    """Complete an ISO string: empty -> the run's own time, no zone -> ``Z``.

    A zone is recognised by a trailing ``Z`` or a ``+`` after the date only, so a
    negative offset also gets a ``Z`` and will not parse later.
    """
    t = strip(null_to_empty(c))
    return (
        F.when(t == "", F.lit(run_ts))
        .when(t.endswith("Z") | (F.instr(F.substring(t, 11, 1_000_000), "+") > 0), t)
        .otherwise(F.concat(t, F.lit("Z")))
    )


def parse_ts(c: Column) -> Column:
    """ISO string -> instant; a string without zone is UTC; anything else is null."""
    raw = strip(null_to_empty(c))
    # The basic form without separators, and a time of hours only.
    raw = F.regexp_replace(raw, r"\A(\d{4})(\d{2})(\d{2})[T ](\d{2})(\d{2})(\d{2})(?=Z|[+-]|\z)", "$1-$2-$3T$4:$5:$6")
    raw = F.regexp_replace(raw, r"\A(\d{4}-\d{2}-\d{2}[T ]\d{2})(?=Z|[+-]|\z)", "$1:00")
    # Spark's cast wants seconds.
    t = F.regexp_replace(raw, r"\A(\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2})(?=Z|[+-]|\z)", "$1:00")
    zoned = (
        F.when(F.length(t) == 10, F.concat(t, F.lit("T00:00:00Z")))
        .when(t.rlike(r"(?:Z|[+-]\d{2}:?\d{2})\z"), t)
        .otherwise(F.concat(t, F.lit("Z")))
    )
    zoned = F.regexp_replace(F.regexp_replace(zoned, ",", "."), r"([+-]\d{2})(\d{2})\z", "$1:$2")
    return F.when(t.rlike(_ISO), zoned.try_cast("timestamp"))


# --- revert rule ---------------------------------------------------------------

def lower_tags(tags: Column) -> Column:
    return F.transform(F.coalesce(tags, F.array().cast("array<string>")), F.lower)


def has_revert_tag(tags: Column) -> Column:
    return F.arrays_overlap(F.filter(lower_tags(tags), lambda t: t.isNotNull()), F.array(*map(F.lit, REVERT_TAGS)))


def matching_revert_tags(tags: Column) -> Column:
    return F.array_intersect(lower_tags(tags), F.array(*map(F.lit, REVERT_TAGS)))


def has_revert_word(comment: Column) -> Column:
    return contains_any(F.lower(null_to_empty(comment)), REVERT_WORDS)


def is_revert(comment: Column, tags: Column) -> Column:
    return has_revert_word(comment) | has_revert_tag(tags)


# --- HTML ------------------------------------------------------------------------

def _untag(c: Column) -> Column:
    return F.replace(F.regexp_replace(null_to_empty(c), "<[^>]+>", " "), F.lit("&nbsp;"), F.lit(" "))


def strip_html(c: Column) -> Column:
    return strip(_untag(c))


def strip_html_collapse(c: Column) -> Column:
    return strip(collapse(_untag(c)))


def _cells(c: Column, css: str) -> Column:
    pattern = rf'(?is)<td class="{css}"[^>]*>(.*?)</td>'
    return F.array_join(F.regexp_extract_all(null_to_empty(c), F.lit(pattern), F.lit(1)), " ")


def added_cells(c: Column) -> Column:
    return _cells(c, "diff-addedline")


def deleted_cells(c: Column) -> Column:
    return _cells(c, "diff-deletedline")


@F.pandas_udf(T.StringType())
def _unescape(s: pd.Series) -> pd.Series:
    return s.map(lambda v: html.unescape(v) if isinstance(v, str) and "&" in v else v)


def unescape_html(c: Column) -> Column:
    """Decode every HTML entity. Spark has no built-in for the full entity table."""
    return _unescape(c)


def payload_html(compare: Column) -> Column:
    """Diff HTML out of a compare payload: the ``*`` entry, else ``body``."""
    return F.coalesce(F.nullif(compare["*"], F.lit("")), F.nullif(compare["body"], F.lit("")), F.lit(""))


def diff_texts(html_col: Column, mode: str) -> tuple[Column, Column]:
    """(added, removed) text of a diff under one of four extraction modes; ``raw:n`` keeps n characters."""
    if mode == "unescaped":
        return strip_html(unescape_html(added_cells(html_col))), strip_html(unescape_html(deleted_cells(html_col)))
    if mode == "collapsed":
        return strip_html_collapse(added_cells(html_col)), strip_html_collapse(deleted_cells(html_col))
    if mode == "whole":
        return strip_html(html_col), F.lit("")
    if mode == "raw":
        return null_to_empty(html_col), F.lit("")
    if mode.startswith("raw:"):
        return F.substring(null_to_empty(html_col), 1, int(mode.removeprefix("raw:"))), F.lit("")
    raise ValueError(f"unknown diff mode: {mode}")
