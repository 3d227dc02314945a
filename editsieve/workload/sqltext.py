"""SQL fragments for the check side, in the dialect of DuckDB (RE2 regular expressions)."""

from __future__ import annotations

WS = r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
ALNUM = "A-Za-zÀ-ÖØ-öø-ÿ0-9"
SYMBOL = rf"[^A-Za-z0-9\x{{17f}}\x{{212a}}\x{{130}}\x{{131}}{WS}]"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def safe(x: str) -> str:
    return f"coalesce({x}, '')"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '\\A[{WS}]+|[{WS}]+\\z', '', 'g')"


def collapse(x: str) -> str:
    return f"regexp_replace({x}, '[{WS}]+', ' ', 'g')"


def norm(x: str) -> str:
    return f"trim({collapse(f'lower({x})')})"


def count(x: str, pattern: str) -> str:
    return f"len(regexp_extract_all({x}, {q(pattern)}))"


def any_of(x: str, words) -> str:
    return "(" + " OR ".join(f"contains({x}, {q(w)})" for w in words) + ")"


def flag(cond: str) -> str:
    return f"CAST(CASE WHEN {cond} THEN 1 ELSE 0 END AS INTEGER)"


def ratio(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} > 0 THEN least(CAST({part} AS DOUBLE) / {whole}, 1.0) ELSE 0.0 END"


BLOB = "concat(coalesce(title,''), chr(32)||chr(10)||chr(32), coalesce(comment,''), chr(32)||chr(10)||chr(32), " \
       "coalesce(added_text,''), chr(32)||chr(10)||chr(32), coalesce(removed_text,''))"
TEXT = norm(BLOB)
# --- fixed values: the same word lists as the rules they check ------------------
SENSITIVE = ("obama", "macron", "trump", "hitler", "israel", "palestine", "gaza", "ukraine", "russie",
             "poutine", "religion", "sexe", "porn")
HINTS = ("revert", "annulation", "rollback", "undo", "rv", "rvv", "restauration")
WORDS = ("revert", "annulation", "rv ", "rvv", "rollback", "restauration")
TAGS = "['mw-rollback', 'mw-undo', 'mw-manual-revert', 'mw-reverted']"
# ----------------------------------------------------------------------------------
TAGGED = f"list_has_any(list_transform(tags, lambda t: lower(t)), {TAGS})"
WORDED = any_of(f"lower({safe('comment')})", WORDS)
IS_REVERT = f"({WORDED} OR {TAGGED})"


def repeat_run(chars: str, length: int) -> str:
    """Any character but a newline ``length`` times in a row. RE2 has no back-reference, so
    ``chars`` (the text as a list of characters) is compared with itself at smaller offsets."""
    same = " AND ".join(f"{chars}[i] = {chars}[i - {k}]" for k in range(1, length))
    return f"(len(list_filter(range({length}, len({chars}) + 1), lambda i: {chars}[i] <> chr(10) AND {same})) > 0)"


FEATURE_SQL = {
    "url_count": f"CAST({count('text', f'(?i)https?://[^{WS}<>' + chr(34) + chr(39) + f']+|www[.][^{WS}<>' + chr(34) + chr(39) + ']+')} AS BIGINT)",
    "symbol_ratio": f"round({ratio(count('text', SYMBOL), 'length(text)')}, 9)",
    "title_sensitive": flag(any_of(norm(safe("title")), SENSITIVE)),
    "delta_len": f"CAST(abs(length({safe('added_text')}) - length({safe('removed_text')})) AS BIGINT)",
    "is_ip_user": flag(f"regexp_matches({strip(safe(chr(34) + 'user' + chr(34)))}, '^\\p{{Nd}}{{1,3}}(?:\\.\\p{{Nd}}{{1,3}}){{3}}$')"),
    "digit_ratio": f"round({ratio(count('text', chr(92) + 'p{Nd}'), count('text', f'[{ALNUM}]'))}, 9)",
    "upper_ratio": f"round({ratio(count(safe('added_text'), '[A-ZÀ-ÖØ-Þ]'), count(safe('added_text'), f'[{ALNUM}]'))}, 9)",
    "comment_revert_hint": flag(any_of(norm(safe("comment")), HINTS)),
}

# --- predicates, HTML, keys ------------------------------------------------------------
RUN_TS = "2024-01-31T00:00:00Z"
TS_SEC = "date_trunc('second', ts)"


def row_hash(columns, seed: int = 42) -> str:
    parts = ", ".join(
        f"CASE WHEN {c} IS NULL THEN '-' ELSE concat(length(CAST({c} AS VARCHAR)), ':', CAST({c} AS VARCHAR)) END"
        for c in columns
    )
    return f"sha1(concat_ws('|', {parts}, '{seed}'))"


def untag(x: str) -> str:
    return f"replace(regexp_replace({safe(x)}, '<[^>]+>', ' ', 'g'), '&nbsp;', ' ')"


def strip_html(x: str) -> str:
    return strip(untag(x))


def strip_html_collapse(x: str) -> str:
    return strip(collapse(untag(x)))


def cells(x: str, css: str) -> str:
    return f"""array_to_string(regexp_extract_all({x}, '(?is)<td class="{css}"[^>]*>(.*?)</td>', 1), ' ')"""


def unescape(x: str) -> str:
    """The XML entities and the no-break space, ``&amp;`` last so that nothing is decoded twice."""
    for entity, text in (("&lt;", "'<'"), ("&gt;", "'>'"), ("&quot;", "'\"'"), ("&#39;", "chr(39)"),
                         ("&nbsp;", "chr(160)"), ("&amp;", "'&'")):
        x = f"replace({x}, '{entity}', {text})"
    return x


def key_part(x: str, n: int | None = None) -> str:
    whole = collapse(f"lower({strip(safe(x))})")
    return whole if n is None else f"substr({whole}, 1, {n})"


def dedup_key(
    user: str = '"user"', ts: str = '"timestamp"', added: str = "added_text", removed: str = "removed_text", short: bool = False
) -> str:
    t, u, n = (40, 80, 600) if short else (None, None, None)
    return (
        f"sha1(concat({safe('lang')}, '||', CAST(coalesce(revid, 0) AS VARCHAR), '||', "
        f"CAST(coalesce(old_revid, 0) AS VARCHAR), '||', {key_part(ts, t)}, '||', {key_part('title', n)}, '||', "
        f"{key_part(user, u)}, '||', {key_part('comment', n)}, '||', {key_part(added, n)}, '||', {key_part(removed, n)}))"
    )


def hash_fraction(key: str) -> str:
    return f"(CAST(('0x' || substr({key}, 1, 8)) AS BIGINT) / 4294967295.0::DOUBLE)"


_B, _E = r"(^|[^\p{L}\p{N}_])", r"($|[^\p{L}\p{N}_])"
# --- fixed values: the context patterns without back-references --------------------------
CONTEXT = (
    r"(?i)https?://|www\.",
    rf"(?i){_B}(test|lol|mdr|ptdr|xd+|haha+){_E}",
    rf"(?i){_B}(fake|faux|hoax|spam){_E}",
    rf"(?i){_B}(idiot|stupide|nul|debile|imbecile){_E}",
    None,
    rf"{_B}\p{{Nd}}{{6,}}{_E}",
    r"[A-Z]{8,}",
    r"\A[^\p{L}\p{N}]+\z",
)
# -------------------------------------------------------------------------------------------


def context_hits(blob: str, chars: str) -> list[str]:
    """One boolean per pattern; the character run compares the list of characters."""
    return [repeat_run(chars, 6) if p is None else f"regexp_matches({blob}, {q(p)})" for p in CONTEXT]


def context_score(blob: str, chars: str) -> str:
    hits = " + ".join(f"CASE WHEN {h} THEN 2 ELSE 0 END" for h in context_hits(blob, chars))
    return (
        f"CAST(CASE WHEN {TAGGED} THEN 6 ELSE 0 END + CASE WHEN {IS_REVERT} THEN 4 ELSE 0 END "
        f"+ CASE WHEN {WORDED} THEN 2 ELSE 0 END + {hits} "
        f"+ CASE WHEN NOT {TAGGED} AND NOT contains(lower({safe('comment')}), 'revert') THEN 1 ELSE 0 END AS INTEGER)"
    )
